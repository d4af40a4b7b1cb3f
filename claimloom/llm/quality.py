"""Quality classifier from weak labels.

Overlapping heuristic labellers (and the human labels where a document has them) vote on
each document or abstain. Expectation-maximisation estimates each labeller's accuracies and
the share of the classes from the counts of vote patterns over all documents; it yields a
posterior for each pattern. A bounded sample of documents with posterior labels then
trains hashed linear scorers, which judge every document: one of word shapes for quality,
one of words for toxicity.

The driver sees the counts of vote patterns (3 to the power of the labellers at most) and
the sample: about ``sample`` distinct rows a class and target, picked by a hash of id and text,
of ``SHAPES`` numbers or the distinct words' hashes each.

The quality labellers are one-sided by their nature: each knows one sort of junk and abstains on
all else, so they meet one another on texts that are junk in several ways, and meet the human
labels everywhere. Which share of junk and which accuracies to start from are parameters
(``prior``, ``trust``).

Defined results: null, empty or blank text is rejected with quality 0; several labels of a
document count by majority (even: none); without labels the heuristics alone decide; very long
texts are judged whole; equal texts get equal scores; an empty table gives an empty result;
repeated rows each get a row, null or repeated ids too (a null id has no label); other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import math
import operator
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import map_blocks, stored

SHAPES = 1024
#: Words of usual shapes that come along with each text when it is scored.
SMOOTHING = 8.0
#: English insults, a labeller of its own.
INSULTS = frozenset("idiot idiots moron morons stupid imbecile loser losers scum clown clowns trash worthless pathetic disgusting dumb fool jerk bastard bitch".split())
_WORD = re.compile(r"[^\W\d_]+")
_SYMBOLS = b"#%&$*@^~<>{}[]=_\\+"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
#: Sorts of bytes in word shapes: capitals, other letters, digits; white space is one sort, all else is itself.
_SORTS = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else 32 if b in b" \t\n\v\f\r" else b for b in range(256))
QUALITY = ["symbols", "capitals", "bars", "repeats", "variety", "shouts", "ordinary", "human"]
TOXIC = ["insults", "insult_share", "human"]
_VOTES = "doc_id bigint, tid bigint, quality array<int>, toxic array<int>"


PRIOR = {"quality": 0.8, "toxic": 0.08}
TRUST = {"quality": [*[0.9] * (len(QUALITY) - 1), 0.97], "toxic": [0.9, 0.9, 0.99]}


def votes(text: str) -> tuple[list[int], list[int]]:
    """Heuristic votes without the human one: quality (0 bad, 1 good), toxicity (1 toxic), -1 abstains.

    Each sort of junk has a labeller that votes 0 or abstains; one labeller votes 1 where none of them has cause.
    """
    ws = text.split()
    n = len(ws)
    if not n:
        return [0] * (len(QUALITY) - 1), [-1] * (len(TOXIC) - 1)

    def bad(x: float, limit: float, usual: float) -> int:
        return 0 if x > limit else 1 if x <= usual else -1

    raw, count, lowered = text.encode(), text.count, text.lower()
    of = lambda kind: len(raw) - len(raw.translate(None, kind))
    symbols, upper = of(_SYMBOLS) / n, of(_UPPER)
    letters = upper + of(_LOWER)
    repeats = sum(map(operator.eq, ws, ws[1:])) / n
    variety = len(set(ws)) / n
    ends = sum(w[-1] in ".,;:?" for w in ws) / n
    insults = sum(w in INSULTS for w in _WORD.findall(lowered)) if any(map(lowered.__contains__, INSULTS)) else 0
    marks = [
        bad(symbols, 0.25, 0.05),
        bad(upper / max(letters, 1), 0.4, 0.2) if letters else 0,
        bad(count("|") / n, 0.15, 0.02),
        bad(repeats, 0.3, 0.05),
        bad(1 - variety, 0.92, 0.8) if n >= 40 else 1,
        bad(count("!") / n, 0.25, 0.05),
    ]
    ordinary = 1 if all(m == 1 for m in marks) and (n < 20 or 0.01 < ends < 0.6) else -1
    return [0 if m == 0 else -1 for m in marks] + [ordinary], [1 if insults else -1, 1 if insults / n > 0.002 else -1]


def estimate(patterns: dict[tuple[int, ...], int], prior: float, trust: list[float], rounds: int = 60, weight: float = 30.0) -> dict[tuple[int, ...], float]:
    """Posterior of class 1 for each vote pattern.

    A labeller that votes is right with its own accuracy, independently of the others given the class; that it abstains
    tells nothing. ``trust`` has the accuracies to start from, each worth ``weight`` votes, and ``prior`` class 1's share.
    Accuracies stay above a half, so that classes can't change names.
    """
    if not patterns:
        return {}
    v = np.array(list(patterns))
    n = np.array(list(patterns.values()), float)
    first = np.array(trust, float)
    accuracy, share = first.copy(), prior
    sign = np.where(v == 1, 1, np.where(v == 0, -1, 0))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(sign @ np.log(accuracy / (1 - accuracy)) + np.log(share / (1 - share)), -500, 500)))
        right = ((v == 1) * p[:, None] + (v == 0) * (1 - p)[:, None]).T @ n
        told = (v >= 0).T @ n
        accuracy = np.clip((right + weight * first) / (told + weight), 0.55, 0.995)
        share = float(np.clip((n @ p + 20 * prior) / (n.sum() + 20), 0.005, 0.995))
    return {tuple(int(x) for x in k): float(q) for k, q in zip(v, p)}


def shapes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words with runs of one sort of character made one, as :func:`words.split` gives words."""
    sorts = words.translated(texts, _SORTS)
    offsets = np.frombuffer(sorts.buffers()[1], np.int32)[: len(sorts) + 1]
    data = np.frombuffer(sorts.buffers()[2], np.uint8)[: offsets[-1]]
    keep = np.ones(len(data), bool)
    keep[1:] = data[1:] != data[:-1]
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    bounds = np.concatenate([[0], np.cumsum(keep)]).astype(np.int32)[offsets]
    return words.split(pa.StringArray.from_buffers(len(sorts), pa.py_buffer(bounds.tobytes()), pa.py_buffer(data[keep].tobytes())), bytes(range(256)))


def shape_counts(texts: pa.Array) -> np.ndarray:
    """Counts of hashed word shapes for each text; the last columns hold its distinct and its repeated words."""
    starts, codes, uniques = words.split(texts, bytes(range(256)))
    _, shaped, forms = shapes(texts)
    places = np.fromiter((xxhash.xxh32_intdigest(w) % (SHAPES - 2) for w in forms.to_pylist()), np.int64, len(forms))
    n = len(starts) - 1
    doc = np.repeat(np.arange(n), np.diff(starts))
    x = np.bincount(doc * SHAPES + places[shaped], minlength=n * SHAPES).reshape(n, SHAPES).astype(np.float32)
    if len(codes):
        again = np.concatenate([[False], (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])])
        x[:, -1] = np.bincount(doc[again], minlength=n)
        x[:, -2] = np.bincount(np.unique(doc * len(uniques) + codes) // len(uniques), minlength=n)
    return x


def shares(counts: np.ndarray, mean: np.ndarray | float = 0.0, weight: float = 0.0) -> np.ndarray:
    """Counts over the number of words, as if ``weight`` words of the usual shares ``mean`` came along: a few words don't decide."""
    n = counts[:, : SHAPES - 2].sum(1, keepdims=True)
    return (counts + np.float32(weight) * mean) / np.maximum(n + weight, 1)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(documents, hashes)``: each text's distinct words (letters and digits, lower-cased), hashed."""
    starts, codes, uniques = words.split(pc.utf8_lower(pc.fill_null(texts, "")), words.ALNUM)
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    pairs = np.unique(doc * len(uniques) + codes)
    return pairs // len(uniques), words.hashes(uniques)[pairs % len(uniques)]


def train_linear(x: np.ndarray, y: np.ndarray, rounds: int = 250, rate: float = 4.0, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, both classes weighing the same."""
    if not len(x):
        return np.zeros(SHAPES), 0.0
    x = x.astype(np.float64)
    weight = np.where(y >= 0.5, 0.5 / max((y >= 0.5).sum(), 1), 0.5 / max((y < 0.5).sum(), 1))
    w, b, mw, mb = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0
    for _ in range(rounds):
        g = weight * (1 / (1 + np.exp(-np.clip(x @ w + b, -50, 50))) - y)
        mw, mb = 0.9 * mw + x.T @ g + decay * w, 0.9 * mb + g.sum()
        w, b = w - rate * mw, b - rate * mb
    return w, float(b)


def train_words(toxic: list[np.ndarray], clean: list[np.ndarray], share: float = PRIOR["toxic"], least: int = 4, surprise: float = 6.0, strictness: float = 2.0) -> tuple[dict[int, float], float]:
    """Log-odds weights of hashed words that toxic texts have far more often than clean ones would let expect, and a threshold.

    The threshold on a text's sum is the one that costs least on the sample, where a clean text lost costs
    ``strictness`` times as much as a toxic one kept, at the toxic texts' expected ``share``.
    """
    gather = lambda side: dict(zip(*(x.tolist() for x in np.unique(np.concatenate(side), return_counts=True)))) if side else {}
    t, c = gather(toxic), gather(clean)
    weights = {}
    for h, n in t.items():
        expected = len(toxic) * (c.get(h, 0) + 0.5) / (len(clean) + 1)
        if n >= least and (n - expected) / math.sqrt(expected + 0.5) >= surprise:
            weights[h] = math.log(n / expected)
    score = lambda side: np.sort([sum(weights.get(h, 0.0) for h in x.tolist()) for x in side])
    a, b = score(toxic), score(clean)
    best = (math.inf, 1.0)
    for limit in sorted({x for x in a.tolist() if x > 0}):
        missed, lost = np.searchsorted(a, limit) / max(len(a), 1), 1 - np.searchsorted(b, limit) / max(len(b), 1)
        best = min(best, (share * missed + strictness * (1 - share) * lost, limit))
    return weights, best[1] - 1e-9


def _majority(labels: DataFrame, column: str):
    mean = F.avg(F.col(column).cast("int"))
    return F.when(mean > 0.5, 1).when(mean < 0.5, 0).otherwise(-1).alias(column)


@dataclass
class Model:
    """A linear scorer of word shapes, the usual shares of shapes, and the toxic words' weights with their threshold."""

    weights: np.ndarray
    bias: float
    usual: np.ndarray
    known: np.ndarray
    odds: np.ndarray
    limit: float


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 2500, prior: dict | None = None, trust: dict | None = None) -> DataFrame:
    """``(doc_id, quality_score, toxic_score, toxic, keep)`` of every row; kept are texts of quality that aren't toxic."""
    return judge(docs, fit(docs, labels, id_col, text_col, sample, prior, trust), id_col, text_col)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 2500, prior: dict | None = None, trust: dict | None = None) -> Model:
    """The scorers learned from all documents' votes and a bounded sample of their texts."""
    rows = _texts(docs, id_col, text_col)
    prior, trust = prior or PRIOR, trust or TRUST

    def vote(block: pa.Table) -> pa.Table:
        found = [votes(t) for t in block["text"].to_pylist()]
        kind = pa.list_(pa.int32())
        return pa.table({"doc_id": block["doc_id"], "tid": block["tid"], "quality": pa.array([q for q, _ in found], kind), "toxic": pa.array([t for _, t in found], kind)})

    human = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(_majority(labels, "quality").alias("human_quality"), _majority(labels, "toxic").alias("human_toxic"))
    told = rows.withColumn("tid", F.xxhash64("doc_id", "text"))
    voted = map_blocks(told, vote, _VOTES).join(human, "doc_id", "left")
    add = lambda votes_col, human_col: F.concat(votes_col, F.array(F.coalesce(human_col, F.lit(-1)).cast("int")))
    voted = stored(voted.select("tid", add("quality", F.col("human_quality")).alias("quality"), add("toxic", F.col("human_toxic")).alias("toxic")), "votes")
    posteriors = {}
    for target in ("quality", "toxic"):
        patterns = {tuple(r[target]): r["n"] for r in voted.groupBy(target).agg(F.count("*").alias("n")).collect()}
        posteriors[target] = estimate(patterns, prior[target], trust[target])

    # a bounded sample of each target's classes, by a hash of id and text, among documents whose class is clear
    grain = 1 << 30
    chosen = None
    for target, of in posteriors.items():
        sure = {p: int(q >= 0.5) for p, q in of.items() if q >= 0.8 or q <= 0.2}
        if target == "toxic" and any(p[-1] == 0 for p in sure):  # that nothing voted is weaker than a human's vote
            sure = {p: k for p, k in sure.items() if k or p[-1] == 0}
        spread = spark_literal_map(sure)
        klass = F.element_at(spread, F.concat_ws(",", F.transform(target, lambda x: x.cast("string"))))
        of_class = voted.select("tid", F.lit(target).alias("target"), klass.alias("klass")).where("klass is not null")
        for k, n in {r["klass"]: r["n"] for r in of_class.groupBy("klass").agg(F.count("*").alias("n")).collect()}.items():
            part = of_class.where((F.col("klass") == k) & (F.pmod(F.xxhash64("tid", "target"), F.lit(grain)) < int(grain * min(1.0, sample / n))))
            chosen = part if chosen is None else chosen.unionByName(part)
    weights, bias, lexicon, limit, usual = np.zeros(SHAPES), 5.0, {}, 1.0, np.zeros(SHAPES, np.float32)
    if chosen is not None:
        picked = told.join(F.broadcast(chosen.distinct()), "tid").groupBy("target", "klass", "tid").agg(F.first("text").alias("text"))

        def features(block: pa.Table) -> pa.Table:
            texts = block["text"].combine_chunks() if isinstance(block["text"], pa.ChunkedArray) else block["text"]
            doc, hashes = word_hashes(texts)
            edges = np.searchsorted(doc, np.arange(len(texts) + 1))
            parts = []
            for at in range(0, len(texts), 512):
                parts += list(shares(shape_counts(texts.slice(at, 512))))
            blobs = [s.tobytes() if t == "quality" else hashes[a:b].tobytes() for t, s, a, b in zip(block["target"].to_pylist(), parts, edges, edges[1:])]
            return pa.table({"target": block["target"], "klass": block["klass"], "x": pa.array(blobs, pa.binary())})

        got = sorted({(r["target"], r["klass"], bytes(r["x"])) for r in map_blocks(picked, features, "target string, klass int, x binary", limit=4 << 20).toLocalIterator()})
        x = [np.frombuffer(b, np.float32) for t, _, b in got if t == "quality"]
        if x:
            x, y = np.stack(x), np.array([k for t, k, _ in got if t == "quality"], float)
            weights, bias = train_linear(x, y)
            usual = x[y == 1].mean(0) if (y == 1).any() else usual
        of = lambda k: [np.frombuffer(b, np.uint64) for t, c, b in got if t == "toxic" and c == k]
        lexicon, limit = train_words(of(1), of(0), prior["toxic"])
    known = np.array(sorted(lexicon), np.uint64)
    return Model(weights.astype(np.float32), bias, usual, known, np.array([lexicon[h] for h in known.tolist()]), limit)


def judge(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`classify`'s rows by a model."""
    rows = _texts(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(block: pa.Table) -> pa.Table:
        m = sent.value
        w, b, usual, known, odds, limit = m.weights, m.bias, m.usual, m.known, m.odds, m.limit
        texts = block["text"].combine_chunks() if isinstance(block["text"], pa.ChunkedArray) else block["text"]
        quality: list[float] = []
        for at in range(0, len(texts), 512):
            x = shape_counts(texts.slice(at, 512))
            quality += np.where(x.any(1), 1 / (1 + np.exp(-np.clip(shares(x, usual, SMOOTHING) @ w + b, -50, 50))), 0.0).tolist()
        total = np.zeros(len(texts))
        if len(known):
            doc, hashes = word_hashes(texts)
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = known[at] == hashes
            total = np.bincount(doc[hit], weights=odds[at[hit]], minlength=len(texts))
        toxic = 1 / (1 + np.exp(-np.clip(total - limit, -50, 50)))
        keep = (np.array(quality) >= 0.5) & (total < limit)
        return pa.table({"doc_id": block["doc_id"], "quality_score": pa.array(quality, pa.float64()), "toxic_score": pa.array(toxic), "toxic": pa.array(total >= limit), "keep": pa.array(keep)})

    return map_blocks(rows, score, "doc_id bigint, quality_score double, toxic_score double, toxic boolean, keep boolean", limit=4 << 20)


def spark_literal_map(values: dict[tuple[int, ...], int]):
    """A literal map from joined votes to a class."""
    pairs = [F.lit(x) for p, k in sorted(values.items()) for x in (",".join(map(str, p)), k)]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,int>")
