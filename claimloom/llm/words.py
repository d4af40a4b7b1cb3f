"""Vectorised splitting of a block of texts into words, with 64-bit word hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: A-Z to a-z, all else unchanged.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: ASCII letters (lower-cased), digits and everything beyond ASCII stay; the rest parts words.
ALNUM = bytes(LOWER[b] if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def translated(texts: pa.Array, mapping: bytes) -> pa.Array:
    """Map every byte of a string array; null becomes the empty text."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.offset:
        texts = pa.concat_arrays([texts])
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    body = data.to_pybytes().translate(mapping) if data is not None else b""
    return pa.Array.from_buffers(texts.type, len(texts), [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(body)])


def split(texts: pa.Array, mapping: bytes) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``(starts, codes, uniques)``: words of text i are ``uniques[codes[starts[i]:starts[i+1]]]``."""
    parts = pc.ascii_split_whitespace(translated(texts, mapping))
    flat = parts.flatten()
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = parts.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    uniques = coded.dictionary
    empty = pc.index(uniques, pa.scalar("", uniques.type)).as_py() if len(uniques) else -1
    if empty < 0:
        return offsets, codes, uniques
    keep = codes != empty
    starts = np.concatenate([[0], np.cumsum(keep)])[offsets]
    return starts, codes[keep], uniques


def hashes(uniques: pa.Array) -> np.ndarray:
    """64-bit hashes of words."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(word) for word in uniques.to_pylist()), np.uint64, len(uniques))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (the public splitmix64 constants)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h
