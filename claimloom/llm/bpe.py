"""Exact token ids for many texts at once, by remembering the ids of words.

The tokenizer drops white space and never joins across it, so a text's ids are the
ids of its pieces in order. A piece is split off at ASCII white space, and after an
ASCII letter that an ASCII non-letter follows, where the tokenizer's own splitting
has a boundary too. Texts holding ``<|`` may hold special strings and are given to
the library as they are. ``tests/llm`` compares this with the library's own results.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import LOWER, translated

#: Words whose ids a worker remembers; beyond it the memory starts anew.
MEMORY = 400_000
_CHUNK = 200
_SPECIAL = "<|endoftext|>"
_loaded: dict[str, "WordIds"] = {}


def load(path: str, most: int | None = None) -> "WordIds":
    """The encoder for a tokenizer file, once for each worker process; ``most`` words are remembered (``MEMORY`` without it)."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    _loaded[path].most = most
    return _loaded[path]


class WordIds:
    """Ids for the word-level BPE file; other tokenizer files take the library's plain path."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_word = spec["model"].get("end_of_word_suffix") == "</w>" and "Removed" in json.dumps(spec.get("pre_tokenizer"))
        size = self.library.get_vocab_size()
        self.closes = np.zeros(size, bool)
        for token, i in spec["model"]["vocab"].items():
            self.closes[i] = token.endswith("</w>")
        self.separator = self.library.token_to_id(_SPECIAL)
        self.dtype = np.uint16 if size <= 1 << 16 else np.uint32
        self.most: int | None = None
        self.forget()

    def forget(self, keep: list[str] = ()) -> None:
        """Start the memory anew, with the known ones of some words: a block's known words are the frequent ones."""
        kept = [(w, self.place[w]) for w in keep if self.place.get(w, -1) >= 0] if keep else []
        pieces = [self.ids[self.starts[p] : self.starts[p + 1]] for _, p in kept]
        self.place: dict[str, int] = {w: i for i, (w, _) in enumerate(kept)}
        self.starts = np.concatenate([[0], np.cumsum([len(x) for x in pieces], dtype=np.int64)]).astype(np.int64)
        self.ids = np.concatenate([*pieces, np.zeros(0, self.dtype)]).astype(self.dtype)

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Append the ids of new words to the memory."""
        letters = [w for w in words if w.isalpha()]
        others = [w for w in words if not w.isalpha()]
        for group, sep in ((letters, " "), (others, _SPECIAL)):
            chunks = [group[i : i + _CHUNK] for i in range(0, len(group), _CHUNK)]
            coded = self.plain([sep.join(c) for c in chunks])
            lengths, kept = [], []
            for chunk, ids in zip(chunks, coded):
                marks = np.flatnonzero(self.closes[ids] if sep == " " else ids == self.separator)
                ends = marks + 1 if sep == " " else np.append(marks, len(ids))
                if len(ends) != len(chunk):  # a word of several parts, or one with the separator in it
                    each = self.plain(chunk)
                    lengths += map(len, each)
                    kept += each
                    continue
                lengths += (np.diff(ends, prepend=0) if sep == " " else np.diff(ends, prepend=-1) - 1).tolist()
                kept.append(ids if sep == " " else np.delete(ids, marks))
            if group:
                base = len(self.starts) - 1
                self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths, dtype=np.int64)])
                self.ids = np.concatenate([self.ids, *kept])
                self.place.update(zip(group, range(base, base + len(group))))

    def _coded(self, texts: pa.Array):
        """Word memory places of a block's pieces: (starts of texts, places)."""
        lowered = translated(texts, LOWER)
        parted = pc.replace_substring_regex(lowered, r"([a-z])([\x21-\x60\x7B-\x7E])", r"\1 \2")
        pieces = pc.ascii_split_whitespace(parted)
        coded = pieces.flatten().dictionary_encode()
        uniques = coded.dictionary.to_pylist()
        if len(self.place) > (self.most or MEMORY):
            self.forget(uniques)
        self.place.setdefault("", -1)
        new = [w for w in uniques if w not in self.place]
        if new:
            self._learn(new)
        places = np.fromiter((self.place[w] for w in uniques), np.int64, len(uniques))[coded.indices.to_numpy(zero_copy_only=False)]
        offsets = pieces.offsets.to_numpy().astype(np.int64)
        keep = places >= 0
        return np.concatenate([[0], np.cumsum(keep)])[offsets - offsets[0]], places[keep]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(starts, ids)``: the ids of text i are ``ids[starts[i]:starts[i+1]]``; null counts as empty."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts, "")
        if not len(texts):
            return np.zeros(1, np.int64), np.zeros(0, self.dtype)
        odd = np.ones(len(texts), bool) if not self.by_word else pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        quick = texts.filter(pa.array(~odd)) if odd.any() else texts
        bounds, places = self._coded(quick) if len(quick) else (np.zeros(1, np.int64), np.zeros(0, np.int64))
        lengths = self.starts[places + 1] - self.starts[places]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        starts = ends[bounds]
        ids = self.ids[np.arange(ends[-1]) - np.repeat(ends[:-1] - self.starts[places], lengths)] if len(places) else np.zeros(0, self.dtype)
        if not odd.any():
            return starts, ids
        slow = iter(self.plain(texts.filter(pa.array(odd)).to_pylist()))
        fast = (ids[a:b] for a, b in zip(starts, starts[1:]))
        each = [next(slow) if o else next(fast) for o in odd]
        return np.concatenate([[0], np.cumsum([len(e) for e in each])]), np.concatenate(each)

    def counts(self, texts: pa.Array) -> np.ndarray:
        return np.diff(self.encode(texts)[0])
