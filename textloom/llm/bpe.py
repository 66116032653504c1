"""Byte-level BPE by batched numpy merge rounds (problem 8).

The symbols of many words lie in one flat array. In each round the rank of
every neighbouring pair is found by binary search over the sorted pair keys,
each word merges its lowest-ranked pair, and words without a mergeable pair
leave the array. Words that were met before come from a per-worker cache, so
the rounds run only over new distinct words.

Defined results: null and empty text give an empty list; any other text, also
white space only, gives its ids without special tokens.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Split pattern that the rank files are published with (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Distinct words that a worker remembers before it starts its cache anew.
CACHE_WORDS = 400_000
BIG = np.iinfo(np.int64).max


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Place of a vocabulary file of the installed public tokenizers."""
    folder = os.environ.get("TEXTLOOM_TOKENIZERS", "/opt/tokenizers")
    if os.path.isdir(folder):
        return os.path.join(folder, name)
    return os.path.join(os.path.dirname(importlib.util.find_spec("public_tokenizers").origin), name)


class BatchBpe:
    """Vocabulary tables and the merge rounds."""

    def __init__(self, path: str):
        import regex

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.split = regex.compile(PATTERN).findall
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        keys, merged = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    merged.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.merged = np.array(merged, dtype=np.int64)[order]
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.start = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.int32)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, flat, and the number of ids of each."""
        n = len(words)
        lens = np.fromiter(map(len, words), dtype=np.int64, count=n)
        sym = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(n), lens)
        done_sym, done_word = [], []
        while len(sym) > 1:
            key = sym[:-1] << 32 | sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.merged[at], BIG)
            rank = np.append(rank, BIG)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(word)]))
            idle = best == BIG
            hit = (rank == best) & ~idle
            # neighbouring hits overlap: in a run of hits, take every second one from its left end
            left = hit & ~np.r_[False, hit[:-1]]
            pos = np.arange(len(hit))
            run_start = np.maximum.accumulate(np.where(left, pos, 0))
            hit &= (pos - run_start) % 2 == 0
            sym = np.where(hit, rank, sym)
            keep = ~np.r_[False, hit[:-1]]
            if idle.any():
                done_sym.append(sym[idle])
                done_word.append(word[idle])
                keep &= ~idle
            sym, word = sym[keep], word[keep]
        done_sym.append(sym)
        done_word.append(word)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order].astype(np.int32), np.bincount(word, minlength=n).astype(np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and the number of ids of each text."""
        if len(self.known) > CACHE_WORDS:
            self._reset()
        words: list[str] = []
        per_text = np.zeros(len(texts), dtype=np.int64)
        for i, t in enumerate(texts):
            if t:
                w = self.split(t)
                per_text[i] = len(w)
                words += w
        new = list(set(words).difference(self.known))
        if new:
            flat, count = self.merge([w.encode("utf-8", "surrogatepass") for w in new])
            base = len(self.known)
            self.known.update(zip(new, range(base, base + len(new))))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.flat = np.concatenate([self.flat, flat])
        ix = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        n = self.count[ix]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(self.start[ix] - ends + n, n)] if total else np.zeros(0, np.int32)
        word_ends = np.r_[0, ends][np.cumsum(per_text)] if len(ends) else np.zeros(len(texts), np.int64)
        return ids, np.diff(np.r_[0, word_ends])


_loaded: dict[str, BatchBpe] = {}


def load(path: str) -> BatchBpe:
    """One vocabulary per worker process and path."""
    if path not in _loaded:
        _loaded[path] = BatchBpe(path)
    return _loaded[path]


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id_col, ids array<int>) of every row of ``docs``; a narrow map without shuffle."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                part = b.slice(k, 1000)
                ids, n = bpe.encode(part.column(1).to_pylist())
                offsets = pa.array(np.r_[0, np.cumsum(n)].astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, pa.array(ids))], ["key", "ids"])

    src = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("body"))
    kind = src.schema["key"].dataType.simpleString()
    return src.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", id_col)
