"""Personal data: fixed patterns, and identifiers found by bootstrapping their contexts.

The patterns' entities are seeds. A lexical pattern is the pair of words around an
identifier-like token, the two words before it or the two after it (letters-only words
lower-cased; other neighbours by their shape; a word or token longer than ``LONGEST`` characters
by its digest, whole). Identifier-like is a run of five characters or more without white space
that holds a digit, an at sign (or what is written for one) or a name parted by dots. Patterns
and tokens make a bipartite graph. Its scores alternate: a pattern's confidence in a kind is the
smoothed share of its tokens' scores, counted over distinct tokens so that copies of a text
weigh once; a token that is no seed scores the confidence of its best pattern, less doubt for
each that disagrees. High-confidence patterns with enough distinct seeds mark the other tokens
in their place as unseen identifiers of that kind. The graph lives in Spark tables; no part of
it is collected.

Defined results: null text has no spans; very long texts are read whole; empty table, empty
result; matches that fail a rule are dropped and not tried again; tokens that overlap a
pattern's span aren't added; a token that patterns of equal confidence mark gets the kind that
comes last in :data:`KINDS`; repeated rows each get a row, null or repeated ids too; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_blocks, stored

KINDS = ["email", "ip", "card", "phone"]
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# a match of these three can only begin where a run of digits begins, and takes whole runs
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"\S+")
_LIKE = re.compile(r"[0-9]|@|\(at\)|\[at\]|[^\W\d_]\.[^\W\d_]")
#: Characters of a token or a neighbour that stand for themselves; longer ones are told apart by a digest.
LONGEST = 64
_EDGE = "\"'()[]{}<>,;:.!?#$%&*|"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, rank of kind, end)`` of the fixed patterns, in order."""
    out = []
    at, least = text.find("@"), 0
    while at >= 0:
        start = at
        while start > least and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            least = m.end()
        at = text.find("@", max(at + 1, least))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text) if "+" in text else ():
            if 9 <= sum(c.isascii() and c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def shape(word: str) -> str:
    return word.lower() if word.isalpha() else re.sub(r"(.)\1+", r"\1+", re.sub(r"[0-9]", "0", re.sub(r"[^\W\d_]", "a", word)))


def _short(x: str) -> str:
    return x if len(x) <= LONGEST else "#" + hashlib.sha256(x.encode()).hexdigest()


class _Words:
    """A text's runs without white space, found once."""

    def __init__(self, text: str):
        self.text, self.spans = text, [m.span() for m in _WORD.finditer(text)]
        self.begins, self.ends = [a for a, _ in self.spans], [b for _, b in self.spans]

    def around(self, start: int, end: int) -> list[str]:
        """The patterns of a place: a word on either side, two words before it, two after it; what is left of a word beside it counts as one."""
        i, k = bisect.bisect_left(self.begins, start), bisect.bisect_right(self.ends, end)
        before = [self.text[self.begins[j] : min(self.ends[j], start)] for j in (i - 2, i - 1) if j >= 0]
        after = [self.text[max(self.begins[j], end) : self.ends[j]] for j in (k, k + 1) if j < len(self.ends)]
        a, b = (_short(shape(w.strip(_EDGE))) for w in ["^", "^", *before][-2:])
        c, d = (_short(shape(w.strip(_EDGE))) for w in [*after, "$", "$"][:2])
        return [f"{b} _ {c}", f"{a} {b} _", f"_ {c} {d}"]


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Seeds (kind >= 0) and other identifier-like tokens (kind -1), with their patterns."""
    if not base and not _LIKE.search(text):
        return []
    found = _Words(text)
    out = [{"kind": kind, "start": s, "end": e, "patterns": found.around(s, e), "token": _short(text[s:e])} for s, kind, e in base]
    i = 0
    for begin, stop in found.spans:
        if stop - begin < 5:
            continue
        raw = text[begin:stop]
        if not _LIKE.search(raw):
            continue
        start = begin + len(raw) - len(raw.lstrip(_EDGE))
        end = stop - (len(raw) - len(raw.rstrip(_EDGE)))
        if end - start < 5:
            continue
        while i < len(base) and base[i][2] <= start:
            i += 1
        if any(s < end and start < e for s, _, e in itertools.takewhile(lambda b: b[0] < end, itertools.islice(base, i, None))):
            continue
        out.append({"kind": -1, "start": start, "end": end, "patterns": found.around(start, end), "token": _short(text[start:end])})
    return out


_READ = "doc_id bigint, row string, base array<struct<start:int,kind:int,end:int>>, found array<struct<kind:int,start:int,end:int,patterns:array<string>,token:string>>"


def bootstrap(found: DataFrame, rounds: int, confidence: float, support: int, prior: float = 2.0) -> DataFrame:
    """High-confidence ``(pattern, kind)`` of occurrence rows ``(kind, pattern, token)``.

    ``support`` is the least number of distinct seeds; ``prior`` counts as so many tokens of no kind.
    """
    edges = stored(found.groupBy("pattern", "token").agg(F.max("kind").alias("kind")), "graph")
    seeded = edges.where("kind >= 0").groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    totals = edges.groupBy("pattern").agg(F.count("*").alias("tokens"))
    scores = edges.where("kind >= 0").select("token", "kind", F.lit(1.0).alias("score")).distinct()
    held = None
    for _ in range(rounds):
        sums = edges.select("pattern", "token").join(scores, "token").groupBy("pattern", F.col("kind")).agg(F.sum("score").alias("mass"))
        held = sums.join(totals, "pattern").select("pattern", "kind", (F.col("mass") / (F.col("tokens") + prior)).alias("confidence"))
        best = edges.where("kind < 0").select("pattern", "token").join(held, "pattern")
        unseen = best.groupBy("token", F.col("kind")).agg((F.max("confidence") * F.avg("confidence")).alias("score")).where("score >= 0.05")
        scores = stored(edges.where("kind >= 0").select("token", "kind", F.lit(1.0).alias("score")).distinct().unionByName(unseen), "scores")
    ranked = held.join(seeded, ["pattern", "kind"]).where((F.col("confidence") >= confidence) & (F.col("seeds") >= support))
    return ranked.groupBy("pattern").agg(F.max_by("kind", F.struct("confidence", F.col("kind"))).alias("found_kind"), F.max("confidence").alias("confidence"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, confidence: float = 0.7, support: int = 8) -> DataFrame:
    """``(doc_id, base, added)``: arrays of (start, kind, end); kinds are places in :data:`KINDS`."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def read(block: pa.Table) -> pa.Table:
        bases, found = [], []
        for text in block["text"].to_pylist():
            base = base_spans(text or "")
            bases.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
            found.append(candidates(text or "", base))
        stem = uuid.uuid4().hex
        span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
        token = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("patterns", pa.list_(pa.string())), ("token", pa.string())]))
        return pa.table({"doc_id": block["doc_id"], "row": pa.array([f"{stem}{i}" for i in range(len(block))]), "base": pa.array(bases, span), "found": pa.array(found, token)})

    texts = stored(map_blocks(rows, read, _READ), "pii")
    found = texts.select("row", F.explode("found").alias("f")).select("row", "f.*")
    placed = found.select("row", "kind", "start", "end", "token", F.explode("patterns").alias("pattern"))
    patterns = bootstrap(placed, rounds, confidence, support)
    places = placed.where("kind < 0").join(patterns, "pattern").groupBy("row", "start", "end").agg(F.max_by("found_kind", F.struct("confidence", "found_kind")).alias("kind"))
    added = places.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("added"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return texts.select("doc_id", "row", "base").join(added, "row", "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))


def told(spans, names: list[str]):
    """``kind:start:end`` of all spans, comma-joined."""
    name = lambda k: F.element_at(F.array(*[F.lit(n) for n in names]), k + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _is(kind: int):
    return lambda s: s["kind"] == kind


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns; added spans have kinds ``ctx_email`` and so on."""
    names = KINDS + [f"ctx_{k}" for k in KINDS]
    lifted = F.transform("added", lambda s: F.struct(s["start"].alias("start"), (s["kind"] + len(KINDS)).alias("kind"), s["end"].alias("end")))
    count = [F.size(F.filter("base", _is(i))).cast("bigint").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *count, F.sha2(told("base", names), 256).alias("base_sha256"), told(F.array_sort(F.concat("base", lifted)), names).alias("spans"))
