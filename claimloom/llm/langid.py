"""Language identification by nearest centroid over TF-IDF n-gram vectors.

Byte trigrams of the lower-cased letters are hashed to a fixed number of dimensions; a
vector is (1 + log tf) * idf, scaled to length one. Each language has several centroids
(spherical k-means), and a text takes the language of the centroid with the greatest
cosine. A text farther from it than nearly all of that language's own learning texts is
rejected: ``rejected`` is true and ``lang_open`` is ``und``.

Learning reads a bounded sample: about ``sample`` distinct rows in all, equally many for each of
the ``most_langs`` most frequent languages, picked by a hash of id and text (so neither copies nor
an id that repeats fill it). Prediction reads every whole text.

Defined results: null text, or text without a letter, is ``und`` with score 0 (rejected); so is
all text if nothing can be learned from; of centroids with equal cosines the first in the order of
languages counts; very long texts are read whole; empty table, empty result; repeated rows each
get a row, null or repeated ids too; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_blocks

DIMS_LOG2 = 12
DIMS = 1 << DIMS_LOG2
_ROWS = 256
#: ASCII that is no letter becomes a space.
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """Dense counts ``[text, dimension]`` of hashed byte trigrams within padded words."""
    spaced = pc.binary_join_element_wise(pa.scalar(" "), pc.utf8_lower(pc.fill_null(texts, "")), pa.scalar(" "), pa.scalar(""))
    offsets = np.frombuffer(spaced.buffers()[1], np.int32)[spaced.offset : spaced.offset + len(spaced) + 1].astype(np.int64)
    raw = spaced.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]].translate(_LETTERS)
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    n = len(spaced)
    one, two, three = b[:-2], b[1:-1], b[2:]
    doc = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))[1:-1]
    inside = (two != 32) | ((one != 32) & (three != 32))
    h = ((one << 16 | two << 8 | three) * np.uint32(2654435761)) >> np.uint32(32 - DIMS_LOG2)
    return np.bincount(doc[inside].astype(np.int64) * DIMS + h[inside], minlength=n * DIMS).reshape(n, DIMS)


def _weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0).astype(np.float32) * idf
    return x / np.maximum(np.sqrt((x**2).sum(1, keepdims=True)), 1e-12)


def _k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; it starts from the mean's nearest row and then the farthest ones."""
    k = min(k, len(x))
    picked = [int((x @ x.mean(0)).argmax())]
    while len(picked) < k:
        picked.append(int((x @ x[picked].T).max(1).argmin()))
    centres = x[picked]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(1)
        for j in range(k):
            if (own == j).any():
                centres[j] = x[own == j].mean(0)
        centres /= np.maximum(np.sqrt((centres**2).sum(1, keepdims=True)), 1e-12)
    return centres


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 2000, clusters: int = 3, most_langs: int = 500) -> dict:
    """Model from a bounded sample of ``labelled``; the driver holds ``sample`` vectors of 16 KB at most (about)."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_langs).collect()}
    if not sizes:
        return {"langs": []}
    each = max(1, sample // len(sizes))
    grain = 1 << 30
    limit = F.element_at(F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, int(grain * min(1.0, each / n)))]), F.col("lang"))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(grain)) < limit).dropDuplicates(["doc_id", "text", "lang"]).select("text", "lang")

    def vectors(block: pa.Table) -> pa.Table:
        out = []
        texts = block["text"].combine_chunks() if isinstance(block["text"], pa.ChunkedArray) else block["text"]
        for at in range(0, len(block), _ROWS):
            counts = trigram_counts(texts.slice(at, _ROWS))
            out += [c.astype(np.float32).tobytes() for c in counts]
        return pa.table({"lang": block["lang"], "counts": pa.array(out, pa.binary())})

    found = sorted((r["lang"], bytes(r["counts"])) for r in map_blocks(chosen, vectors, "lang string, counts binary").collect())
    if not found:
        return {"langs": []}
    langs = np.array([lang for lang, _ in found])
    counts = np.stack([np.frombuffer(c, np.float32) for _, c in found])
    idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))) + 1).astype(np.float32)
    x = _weigh(counts, idf)
    names, centres, reach = sorted(set(langs.tolist())), [], []
    of: list[int] = []
    for i, lang in enumerate(names):
        own = x[langs == lang]
        own = own[(own**2).sum(1) > 0]
        if len(own):
            c = _k_means(own, clusters)
            centres.append(c)
            of += [i] * len(c)
            distance = 1 - (own @ c.T).max(1)
            reach.append(float(min(1.0, np.quantile(distance, 0.995) + 0.1)))
        else:
            reach.append(0.0)
    return {"langs": names, "idf": idf, "centres": np.concatenate(centres) if centres else np.zeros((0, DIMS), np.float32), "of": np.array(of, int), "reach": np.array(reach)}


PREDICTED = "doc_id bigint, lang_pred string, score double, rejected boolean, lang_open string"


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``lang_pred`` is always a learned language where there is a letter; ``lang_open`` is ``und`` if it was rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def classify(block: pa.Table) -> pa.Table:
        m = sent.value
        texts = block["text"].combine_chunks() if isinstance(block["text"], pa.ChunkedArray) else block["text"]
        lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        langs, scores, rejected = [], [], []
        names = m["langs"]
        for at in range(0, len(texts), _ROWS):
            if not names or not len(m["centres"]):
                n = len(texts.slice(at, _ROWS))
                langs, scores, rejected = langs + ["und"] * n, scores + [0.0] * n, rejected + [True] * n
                continue
            cosine = _weigh(trigram_counts(texts.slice(at, _ROWS)), m["idf"]) @ m["centres"].T
            best = cosine.argmax(1)
            own = np.clip(cosine[np.arange(len(best)), best], 0, 1)
            for ok, i, s in zip(lettered[at : at + _ROWS], m["of"][best], own):
                langs.append(names[i] if ok else "und")
                scores.append(float(s) if ok else 0.0)
                rejected.append(bool(not ok or 1 - s > m["reach"][i]))
        return pa.table({"doc_id": block["doc_id"], "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64()), "rejected": pa.array(rejected, pa.bool_()), "lang_open": pa.array(["und" if r else x for x, r in zip(langs, rejected)], pa.string())})

    return map_blocks(rows, classify, PREDICTED, limit=4 << 20)
