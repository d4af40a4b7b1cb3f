"""Secrets in texts: fixed patterns, and character Markov models of random strings and identifiers.

DataFrame functions only. Offsets (code points) come from the lengths of the pieces that a
pattern's matches leave between them. A run of token characters is a candidate of the
method; it is a secret if its characters follow one another as in random strings rather
than as in ordinary identifiers: the log-likelihood ratio of two first-order Markov models
must outweigh the prior odds. The models are trained from labelled samples: strings made
from digests (random), and words of a bounded sample of texts, bare and joined as
identifiers are (ordinary). Their tables have the square of the alphabet's size.

Runs of ``shortest`` characters or more, as many as an assigned value needs, are scored; how long a
run must be to outweigh the prior odds is left to its ratio.

Defined results: null text counts as empty (no spans); very long texts, texts of very many
matches and very long runs are read whole, in time about proportional to their length; empty
table, empty result; matches that fail a length rule are dropped and not tried again; a candidate
that overlaps a pattern's span is not added; spans that start together are listed by kind;
repeated rows each get a row, null or repeated ids too. Input columns stay; ones that are named
as the two result columns are replaced by them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
RUN = "[A-Za-z0-9+/_=-]"
#: Kinds in the order in which spans that start together are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = [("assign", ASSIGN), ("access", "AKIA[A-Z0-9]{12,}"), ("hex", "[0-9a-f]{32,}")]
METHOD = "markov"
_EMPTY = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(steps: Column, keep, most: bool = False) -> Column:
    """``keep(at, step)`` of each step (a struct with ``n``), ``at`` being the sum (``most``: the greatest) of all earlier ``n``, from 0.

    Steps are taken in groups of about their number's cube root: an accumulated array is copied whenever it grows, so that
    one accumulator over all steps would cost their square.
    """
    add = F.greatest if most else (lambda a, b: a + b)

    def scan(xs: Column, first: Column, out: Column, make) -> Column:
        start = F.struct(first.alias("at"), out.alias("out"))
        return F.aggregate(xs, start, lambda acc, x: F.struct(add(acc["at"], x["n"]).alias("at"), F.array_append(acc["out"], make(acc["at"], x)).alias("out")), lambda acc: acc["out"])

    def grouped(size: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / size).cast("int"))
        return F.transform(starts, lambda i: F.slice(steps, i * size + 1, size))

    def whole(groups: Column) -> Column:
        sums = F.transform(groups, lambda g: F.struct(F.aggregate(g, F.lit(0), lambda acc, x: add(acc, x["n"])).alias("n")))
        heads = scan(sums, F.lit(0), F.array().cast("array<int>"), lambda at, _: at)
        return F.flatten(F.zip_with(groups, heads, lambda g, at: scan(g, at, F.array().cast(_EMPTY), keep)))

    size = F.greatest(F.lit(16), F.ceil(F.cbrt(F.size(steps)))).cast("int")
    return F.when(F.size(steps) > 0, _let(size, lambda n: _let(grouped(n), whole))).otherwise(F.array().cast(_EMPTY))


def _present(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["start"].isNotNull())


def _matches(text: Column, pattern: str, kind: str, rank: int, keep=None, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as structs; ``keep`` judges the text of ``group``."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    told = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    good = (lambda v: F.coalesce(keep(v), F.lit(False))) if keep is not None else lambda v: F.lit(True)
    # a step is the piece before a match and the match; what is left between matches has no other use
    between = F.split(text, pattern, -1)
    gaps = F.transform(between, lambda x: F.length(x))
    sized = F.zip_with(found, told, lambda m, v: F.struct(F.length(m).alias("own"), good(v).alias("good")))
    steps = F.zip_with(F.slice(gaps, 1, F.size(gaps) - 1), sized, lambda g, m: F.struct((g + m["own"]).alias("n"), m["own"].alias("own"), m["good"].alias("good")))

    def span(at: Column, step: Column) -> Column:
        end = at + step["n"]
        return F.struct(F.when(step["good"], end - step["own"]).alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"))

    spans = _present(_let(steps, lambda x: _running(x, span)))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_EMPTY))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = 500, sample_random: int = 3000, sample_words: int = 2000) -> list[float]:
    """Log-likelihood ratios (random over ordinary) of all pairs of characters, row by row.

    Reads a bounded sample: about ``sample_docs`` texts, picked by a hash of id and text, of which each gives ``sample_words``
    words at most, evenly spread over the whole text.
    """
    spark = docs.sparkSession
    n = docs.count()
    grain = 1 << 30
    picked = docs.where(F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(grain)) < int(grain * min(1.0, sample_docs / max(n, 1)))).select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    every = F.filter(F.split("text", r"[^A-Za-z]+"), lambda w: F.length(w) >= 3)
    spread = lambda ws: F.filter(F.transform(ws, lambda w, i: F.when(F.floor((i + 1) * n_of(ws) / F.size(ws)) > F.floor(i * n_of(ws) / F.size(ws)), F.struct(w.alias("w"), F.coalesce(F.get(ws, i + 1), F.lit("id")).alias("v")))), lambda z: z.isNotNull())
    n_of = lambda ws: F.least(F.size(ws), F.lit(sample_words))
    named = picked.select(F.explode(_let(every, spread)).alias("z")).select("z.w", "z.v")
    joined = named.select(F.explode(F.array("w", F.concat_ws("_", "w", "v"), F.concat_ws("-", "w", "v"), F.concat("w", F.initcap("v")), F.upper(F.concat_ws("_", "w", "v")))).alias("s"), F.lit(0).alias("random"))
    bits = F.unhex(F.sha2(F.col("id").cast("string"), 256))
    made = spark.range(sample_random).select(F.explode(F.array(F.lower(F.hex(bits)), F.base64(bits), F.translate(F.base64(bits), "+/", "-_"), F.upper(F.regexp_replace(F.base64(bits), "[^A-Za-z0-9]", "")))).alias("s"), F.lit(1).alias("random"))
    pairs = joined.unionByName(made).where("length(s) > 1").select("random", F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substr("s", i, F.lit(2)))).alias("pair"))
    counts = {(r["random"], r["pair"]): r["n"] for r in pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}
    size = len(ALPHABET)
    out = []
    for a in ALPHABET:
        rows = [[counts.get((k, a + b), 0) + 0.5 for b in ALPHABET] for k in (0, 1)]
        total = [sum(r) for r in rows]
        out += [math.log(rows[1][j] / total[1]) - math.log(rows[0][j] / total[0]) for j in range(size)]
    return out


def ratio(token: Column, model: list[float]) -> Column:
    """Sum of the log-likelihood ratios of a token's character pairs; one pass over the token, however long."""
    table, size = F.lit([float(x) for x in model]), len(ALPHABET)
    places = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))

    def total(p: Column) -> Column:
        pairs = F.zip_with(F.slice(p, F.lit(1), F.size(p) - 1), F.slice(p, F.lit(2), F.size(p) - 1), lambda a, b: (a - 1) * size + b)
        return F.aggregate(pairs, F.lit(0.0), lambda acc, i: acc + F.element_at(table, i))

    return F.when(F.length(token) > 1, _let(places, total)).otherwise(F.lit(0.0))


def find_secrets(docs: DataFrame, model: list[float], id_col: str = "doc_id", text_col: str = "text", shortest: int = 8, prior: float = 1e-4) -> DataFrame:
    """All rows and columns of ``docs``, and ``secret_base`` and ``secret_spans``: arrays of (start, rank, kind, end)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.concat(*[_matches(text, p, kind, i, (lambda v: F.length(v) >= 8) if kind == "assign" else None, 2 if kind == "assign" else 0) for i, (kind, p) in enumerate(PATTERNS)])
    candidates = _matches(text, f"{RUN}{{{shortest},}}", METHOD, len(PATTERNS), lambda v: v.rlike("[A-Za-z]") & (ratio(v, model) > -math.log(prior)))
    staged = docs.withColumn("secret_base", F.array_sort(base)).withColumn("secret_more", candidates)
    return staged.withColumn("secret_spans", F.when(F.size("secret_more") > 0, _let(F.array_sort(F.concat("secret_base", "secret_more")), _apart)).otherwise(F.col("secret_base"))).drop("secret_more")


def _apart(spans: Column) -> Column:
    """Sorted spans without the method's that overlap a pattern's: one that reaches into it from before, or one that begins in it."""
    own = lambda s: s["rank"] < len(PATTERNS)
    following = F.concat(F.slice(spans, F.lit(2), F.size(spans)), F.array(F.lit(None).cast(_EMPTY[6:-1])))
    steps = F.zip_with(spans, following, lambda s, f: F.struct(F.when(own(s), s["end"]).otherwise(0).alias("n"), s.alias("s"), F.when(own(f), f["start"]).alias("next")))

    def keep(at: Column, x: Column) -> Column:
        free = (at <= x["s"]["start"]) & F.coalesce(x["next"] >= x["s"]["end"], F.lit(True))
        return F.struct(F.when(own(x["s"]) | free, x["s"]["start"]).alias("start"), x["s"]["rank"].alias("rank"), x["s"]["kind"].alias("kind"), x["s"]["end"].alias("end"))

    return _present(_let(steps, lambda xs: _running(xs, keep, most=True)))


def told(spans: Column | str) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column | str, mark: str = "[SECRET]") -> Column:
    """The text with each span, or run of overlapping spans, replaced by ``mark``.

    Pieces are cut from a form of four bytes for each code point, where a place is found without reading what is before it;
    each piece gets a byte-order mark of its own, which decoding drops.
    """
    spans = F.col(spans) if isinstance(spans, str) else spans
    steps = F.transform(spans, lambda s: F.struct(s["end"].alias("n"), s.alias("s")))
    left = lambda at, x: F.struct(F.when(x["s"]["start"] >= at, at).alias("start"), x["s"]["rank"].alias("rank"), x["s"]["kind"].alias("kind"), x["s"]["start"].alias("end"))
    tail = F.struct(F.array_max(F.transform(spans, lambda s: s["end"])).alias("start"), F.lit(0).alias("rank"), F.lit("").alias("kind"), F.length(text).alias("end"))
    pieces = F.array_append(_present(_let(steps, lambda xs: _running(xs, left, most=True))), tail)

    def cut(wide: Column) -> Column:
        piece = lambda s: F.decode(F.concat(F.unhex(F.lit("0000FEFF")), F.substr(wide, s["start"] * 4 + 1, (s["end"] - s["start"]) * 4)), "UTF-32")
        return F.array_join(F.transform(pieces, piece), mark)

    return F.when(F.size(spans) > 0, _let(F.encode(text, "UTF-32"), cut)).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of :func:`find_secrets`."""
    count = lambda kind: F.size(F.filter("secret_base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(told("secret_base"), 256).alias("base_sha256"), told("secret_spans").alias("spans"))
