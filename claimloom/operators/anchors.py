"""Quotes anchored in the texts that they are from, many at a time.

A text is normalised once, whatever the number of its quotes: character by character, with the places in the source that each
character comes from (a stored table). The quotes of a text are dealt to blocks of some two thousand; a block's quotes make one
automaton that reads the normalised text once and finds every place of every quote, overlapping ones too. A quote is anchored
if exactly one place has its prefix before it and its suffix after it.

Normal form: white space becomes one space, typographic quotes, dashes and the soft hyphen their plain forms, every other
character its compatibility composition; quotes and contexts are trimmed. Places are code points of the source, the end exclusive.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.text import TYPOGRAPHY
from claimloom.operators.relational import join_hot
from claimloom.sources.scratch import stored

#: Quotes to an automaton, about.
BLOCK = 2_000


def _plain(c: str) -> str:
    if c.isspace() or c == "﻿":
        return " "
    return TYPOGRAPHY[c] if c in TYPOGRAPHY else unicodedata.normalize("NFKC", c)


def normalised(text: str) -> tuple[str, np.ndarray, np.ndarray]:
    """The normal form, and where in ``text`` each of its characters starts and ends."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return "", np.zeros(0, np.int32), np.zeros(0, np.int32)
    known, which = np.unique(codes, return_inverse=True)
    forms = [_plain(chr(c)) for c in known]
    lengths = np.array([len(f) for f in forms])
    table = np.frombuffer("".join(forms).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    n = lengths[which]
    source = np.repeat(np.arange(len(codes)), n)
    within = np.arange(len(source)) - np.repeat(np.cumsum(n) - n, n)
    out = table[np.repeat(first[which], n) + within]
    space = out == 32
    again = space & np.concatenate([[False], space[:-1]])  # a run of spaces is one, from the first's start to the last's end
    kept = np.flatnonzero(~again)
    ends = source[np.concatenate([kept[1:], [len(out)]]) - 1] + 1 if len(kept) else source[:0]
    ends = np.where(space[kept], ends, source[kept] + 1)
    return out[kept].astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass"), source[kept].astype(np.int32), ends.astype(np.int32)


def _trimmed(text: str | None) -> str:
    return normalised(text or "")[0].strip(" ")


def normalised_texts(sources: DataFrame) -> DataFrame:
    """``(source, text, starts, ends)`` of sources (source, text); the places are arrays of 32-bit numbers, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, text in zip(batch["source"].to_pylist(), batch["text"].to_pylist()):
                form, starts, ends = normalised(text or "")
                yield pa.RecordBatch.from_pydict({"source": [source], "text": [form], "starts": [starts.tobytes()], "ends": [ends.tobytes()]}, pa.schema([("source", pa.string()), ("text", pa.string()), ("starts", pa.binary()), ("ends", pa.binary())]))

    return sources.select("source", "text").mapInArrow(run, "source string, text string, starts binary, ends binary")


def found_in(text: str, quotes: list[tuple[str, str, str]]) -> list[list[int]]:
    """Up to two places of each (quote, prefix, suffix) in a normalised text, all in normal form; one pass of the text."""
    import ahocorasick

    places: list[list[int]] = [[] for _ in quotes]
    waiting: dict[str, list[int]] = {}
    for i, (exact, _, _) in enumerate(quotes):
        if exact:
            waiting.setdefault(exact, []).append(i)
    if not waiting:
        return places
    automaton = ahocorasick.Automaton()
    for exact in waiting:
        automaton.add_word(exact, exact)
    automaton.make_automaton()
    for last, exact in automaton.iter(text):
        at, end = last - len(exact) + 1, last + 1
        for i in waiting[exact]:
            if len(places[i]) < 2:
                before, after = quotes[i][1:]
                near = text[max(0, at - len(before) - 1) : at].rstrip(" ")
                if near.endswith(before) and text[end : end + len(after) + 1].lstrip(" ").startswith(after):
                    places[i].append(at)
    return places


def anchored_quotes(quotes: DataFrame, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(ident, n, start, end)`` of quotes (source, ident, exact, prefix, suffix): the number of places found, up to two, and the one.

    ``ident`` tells quotes apart. Quotes of unknown sources have no row; an empty quote is found nowhere. Sources are distinct.
    """
    asked = quotes.join(sources.select("source"), "source", "left_semi").select("source", "ident", "exact", "prefix", "suffix")
    asked = stored(asked, "quotes")
    sizes = stored(asked.groupBy("source").agg(F.count("*").alias("size")), "quote-counts")
    texts = stored(normalised_texts(sources.join(sizes.select("source"), "source", "left_semi")), "normalised")
    dealt = join_hot(asked, sizes.select("source", "size", F.ceil(F.col("size") / block).cast("int").alias("blocks")), ["source"])
    parts = dealt.withColumn("block", F.pmod(F.xxhash64("ident"), F.col("blocks"))).groupBy("source", "block").agg(F.collect_list(F.struct("ident", "exact", "prefix", "suffix")).alias("quotes"))
    names = ("ident", "n", "start", "end")
    kinds = pa.schema([("ident", pa.string()), ("n", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text, starts, ends, held = (batch[c][row].as_py() for c in ("text", "starts", "ends", "quotes"))
                starts, ends = np.frombuffer(starts, np.int32), np.frombuffer(ends, np.int32)
                forms = [tuple(_trimmed(q[c]) for c in ("exact", "prefix", "suffix")) for q in held]
                rows = []
                for quote, (exact, _, _), at in zip(held, forms, found_in(text, forms)):
                    one = len(at) == 1
                    rows.append((quote["ident"], len(at), int(starts[at[0]]) if one else None, int(ends[at[0] + len(exact) - 1]) if one else None))
                yield pa.RecordBatch.from_pydict({n: [r[i] for r in rows] for i, n in enumerate(names)}, kinds)

    met = parts.join(texts, "source").select("text", "starts", "ends", "quotes")
    return met.mapInArrow(run, "ident string, n int, start int, end int")
