"""Chat formatting: a finite-state machine over roles, and a declarative template that makes segments with loss flags.

Method: the machine's states are the roles last seen, and a start; a template names, for each state, the roles that may follow,
and the states in which a conversation may end. It reads every role, in any order: one that may not follow is marked and still
moves the machine, so all that comes after is judged from there. As the state after a turn is that turn's role, the state before
it is one value carried along the sorted turns, which a prefix scan does for conversations of any length.

Each turn becomes three segments: what opens it, its text, what closes it; ``loss`` is true for texts of the roles that the
template names, never for marks. Control strings in texts are escaped, by one backslash more after each ``<`` that backslashes
and a ``|`` follow (``<|`` becomes ``<\\|``, ``<\\|`` becomes ``<\\\\|``), which leaves no control string in a text and is undone
by taking one away. Roles stand in a line of their own; in them ``%``, ``<`` and line ends are written as ``%25``, ``%3C``, ``%0A``.

``read_back`` is the inverse. It knows only the formatted text and the flags: it puts a conversation's segments together again
and parses the text by its marks, as a stream of which a turn is held at a time. Its digests of whole conversations can't be
computed from parts, so a conversation goes through one task there, but never into one row.

Edges: turns are ordered by ``turn`` (null first), role and text. A null text or role is empty, and an empty role may follow
nothing. Rows without ``conv_id`` are one conversation without an id. Repeated rows are turns of their own. Texts are whole, of
any length. An empty table has no segments. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.operators.scans import scan


START = ""


@dataclass(frozen=True)
class Template:
    """Marks around a turn (``{role}`` is filled in), roles that learn, and the machine."""

    opening: str = "<|im_start|>{role}\n"
    closing: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user", "tool"), "tool": ("assistant",)})
    ends: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        head, _, tail = self.opening.partition("{role}")
        if not (head.startswith("<|") and tail == "\n" and self.closing.startswith("<|")):
            raise ValueError("marks must begin with '<|', which is what texts are escaped for, and a role must end its line")


CHATML = Template()


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    for raw, written in (("%", "%25"), ("<", "%3C"), ("\n", "%0A")):
        role = F.replace(role, F.lit(raw), F.lit(written))
    return role


def _plain_role(written: str) -> str:
    return written.replace("%0A", "\n").replace("%3C", "<").replace("%25", "%")


def _plain_text(written: str) -> str:
    import re

    return re.sub(r"<\\(\\*)\|", r"<\1|", written)


def judged(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """``(conv_id, n, role, text, state, legal)``: the turns with their places, the state each one meets, and whether it may follow."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    known = [r for rs in template.follows.values() for r in rs]
    code = F.when(F.col("role").isin(known), F.col("role")).otherwise(F.lit("?"))  # any other role is one state, which nothing may follow
    # two scans of one order: places with the row itself, states without it
    placed = scan(rows, ["conv_id"], ["turn", "role", "text"], {"_before": ("sum", F.lit(1).cast("bigint")), "_state": ("last", code)}, before=True)
    state = F.coalesce("_state", F.lit(START))
    legal = F.lit(False)
    for at, nexts in template.follows.items():
        legal = legal | ((state == at) & F.col("role").isin(list(nexts)))
    return placed.select("conv_id", (F.col("_before") + 1).alias("n"), "role", "text", state.alias("state"), legal.alias("legal"))


def segments(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """``(conv_id, n, part, text, loss, legal)``: a conversation is its segments' texts by ``n`` and ``part``, one after the other."""
    head, _, tail = template.opening.partition("{role}")
    part = lambda i, text, loss: F.struct(F.lit(i).alias("part"), text.alias("text"), loss.alias("loss"))
    no = F.lit(False)
    parts = F.array(
        part(0, F.concat(F.lit(head), escaped_role(F.col("role")), F.lit(tail)), no),
        part(1, escaped(F.col("text")), F.col("role").isin(list(template.learned))),
        part(2, F.lit(template.closing), no),
    )
    return judged(conversations, template).select("conv_id", "n", F.explode(parts).alias("s"), "legal").select("conv_id", "n", "s.*", "legal")


def verdicts(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """For each conversation of :func:`judged` turns: ``n_turns``, whether all may follow, the first that may not, and whether it may end."""
    last = F.max_by("role", "n")
    return turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.every("legal").alias("valid"), F.min(F.when(~F.col("legal"), F.col("n"))).alias("first_illegal"), last.isin(list(template.ends)).alias("complete"))


def _reader(head: str, closing: str):
    """Parses a sorted stream of segments into a row for each conversation."""

    class Reading:
        def __init__(self, conv_id):
            self.conv_id, self.held = conv_id, ""
            self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
            self.n_turns = self.loss_chars = self.chars = 0

        def take(self, text: str, loss: bool) -> None:
            self.chars += len(text)
            if loss:
                plain = _plain_text(text)
                self.loss_chars += len(plain)
                self.loss.update(plain.encode())
            # a mark begins with "<|", which texts can't hold, and may be parted between segments
            seen = max(0, len(self.held) - len(closing))
            self.held += text
            while (end := self.held.find(closing, seen)) >= 0:
                turn, self.held, seen = self.held[:end], self.held[end + len(closing) :], 0
                role, line, body = turn.removeprefix(head).partition("\n")
                if not (turn.startswith(head) and line):
                    raise ValueError(f"conversation {self.conv_id} has text between turns")
                self.n_turns += 1
                for x in (_plain_role(role), "\n", _plain_text(body), "\n"):
                    self.turns.update(x.encode())

        def done(self) -> tuple:
            if self.held:
                raise ValueError(f"conversation {self.conv_id} ends within a turn")
            return self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars

    return Reading


READ = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def read_back(formatted: DataFrame, template: Template = CHATML) -> DataFrame:
    """``READ``: what the formatted conversations say, by their text and loss flags alone."""
    head, closing = template.opening.partition("{role}")[0], template.closing
    names = [c.split()[0] for c in READ.split(", ")]
    kinds = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in names])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = _reader(head, closing)
        now, rows = None, []
        for batch in batches:
            for conv, text, loss in zip(*(batch[c].to_pylist() for c in ("conv_id", "text", "loss"))):
                if now is None or conv != now.conv_id:
                    if now:
                        rows.append(now.done())
                    now = make(conv)
                now.take(text, loss)
            if len(rows) >= 4096:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], kinds)
                rows = []
        if now:
            rows.append(now.done())
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], kinds)

    spark = formatted.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20)
    ordered = formatted.select("conv_id", "n", "part", "text", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "n", "part")
    return ordered.select("conv_id", "text", "loss").mapInArrow(read, READ)
