"""Evaluation texts inside corpus documents (problem 9).

Passages and questions are cut into windows of words, and so is every document.
A window's size is the smallest part that counts as a leak (``sizes=(12,)``), or
the size of the item itself, taken from the ladder SIZES (``sizes=SIZES``: whole
items, of which some words may have changed). Each window gets a 64-bit SimHash of
its pairs of neighbouring words (single words are too common to tell windows apart). Fingerprints are indexed by ``radius + 1`` blocks of bits: two within
``radius`` bits of each other agree in one block at least, so an equi join over
the blocks misses none of them. Candidates are verified by the exact weighted
similarity of their shingles of SHINGLE words: the share of the item window's
shingle weight that the document's window holds, a shingle weighing as much as
its words are rare among the items. Where words must be equal (``exact``), that is
asked of the verified windows last.

Scale: neither items nor documents come to the driver. The workers get one bit
for each value of each block, at most ``2**21`` bits a block and size whatever the
number of items, and hand out only the windows with a block that some item has;
these are joined with the item windows by size, block and value. Spark broadcasts
the item windows only if their table is small, and splits hot values otherwise.

Defined results: null or empty text, null ids, and passages or questions of fewer
words than the smallest window, give no rows. Items with equal passages are all
reported. Repeated document ids give each pair once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from . import bits
from .words import WordHashes, words

UNIT, RADIUS, SHINGLE, LEAST = 12, 2, 5, 0.8
#: Window sizes for whole items; an item takes the greatest that is not above its length.
SIZES = (12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512, 1024, 2048, 4096)
#: Bits of a block's value that the index of existing values tells apart.
VALUE_BITS = 21
#: Words whose windows are made at once.
CHUNK = 100_000


def simhash(hashes: np.ndarray, size: int) -> np.ndarray:
    """SimHash of each window of ``size`` words (two or more) by its pairs of neighbouring words; window i starts at word i."""
    if len(hashes) < size:
        return np.zeros(0, dtype=np.uint64)
    pairs = shingles(hashes[None, :], 2)[0]
    # sums wrap around, their differences of at most ``size`` do not
    small = np.int8 if size <= 127 else np.int16
    each = np.unpackbits(pairs.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    run = np.zeros((len(pairs) + 1, 64), dtype=small)
    np.cumsum(each.view(np.int8), axis=0, dtype=small, out=run[1:])
    ones = run[size - 1:] - run[:len(pairs) - size + 2]
    return np.packbits(ones > (size - 1) // 2, axis=1).view("<u8").ravel().astype(np.uint64)


def values(prints: np.ndarray, radius: int) -> np.ndarray:
    """(radius + 1, n) values of the fingerprints' blocks."""
    cuts = np.linspace(0, 64, radius + 2).astype(int)
    return np.stack([((prints >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)).astype(np.int64) for lo, hi in zip(cuts, cuts[1:])])


def _bits(value: np.ndarray, size_no: int, radius: int) -> np.ndarray:
    """Places of block values in the index; of wide blocks the low bits count."""
    block = (np.arange(radius + 1) + size_no * (radius + 1))[:, None]
    return (block << VALUE_BITS) + (value & (1 << VALUE_BITS) - 1)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(hashes, size)


def shingles(rows: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """(n, size - width + 1) hashes of the shingles of windows (n, size); a window below ``width`` words is one shingle."""
    width = min(width, rows.shape[1])
    out = np.zeros((rows.shape[0], rows.shape[1] - width + 1), dtype=np.uint64)
    for k in range(width):
        out = (out ^ rows[:, k:rows.shape[1] - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def similarity(doc: np.ndarray, item: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Share of the weight of each item window's shingles that stand in the document's window; all (n, size)."""
    a, b = shingles(doc), shingles(item)
    width = item.shape[1] - b.shape[1] + 1
    w = windows(weight.ravel(), width).reshape(-1, width)  # of all neighbours, then of those inside a row
    w = w.sum(axis=1)[(np.arange(len(item))[:, None] * item.shape[1] + np.arange(b.shape[1])).ravel()].reshape(b.shape)
    held = np.stack([(a == b[:, k:k + 1]).any(axis=1) for k in range(b.shape[1])], axis=1)
    return (w * held).sum(axis=1) / w.sum(axis=1)


def item_windows(items: DataFrame, item_col: str, text_cols: Sequence[str], sizes: Sequence[int], radius: int, whole: bool) -> DataFrame:
    """(size, block, value, bit, fp, item, seq, weights): every window of every item under each of its blocks."""
    spark = items.sparkSession
    texts = items.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("item"), F.explode(F.array(*[F.col(c).cast("string") for c in text_cols])).alias("body")).where("body is not null")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            h = [hashes.array(words(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.view(np.int64) for x in h], pa.list_(pa.int64()))], ["item", "ws"])

    split_texts = texts.mapInArrow(split, "item long, ws array<long>").where(F.size("ws") >= min(sizes)).withColumn("no", F.monotonically_increasing_id())
    parts = materialise(split_texts, "items")
    n = parts.count()
    rare = parts.select(F.explode(F.array_distinct("ws")).alias("w")).groupBy("w").agg(F.log1p(F.lit(float(n)) / F.count("*")).alias("weight"))
    placed = parts.select("no", F.posexplode("ws").alias("at", "w")).join(rare, "w").groupBy("no").agg(F.sort_array(F.collect_list(F.struct("at", "weight"))).alias("x"))
    weighed = parts.join(placed.select("no", F.col("x.weight").alias("weights")), "no").select("item", "ws", "weights")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, ws, weights in zip(*(c.to_pylist() for c in b.columns)):
                h, wt = np.array(ws, dtype=np.int64).view(np.uint64), np.array(weights, dtype=np.float32)
                fit = [s for s in sizes if s <= len(h)]
                for size in fit[-1:] if whole else fit:
                    fp = simhash(h, size)
                    v = values(fp, radius)
                    m, blocks = len(fp), radius + 1
                    seq, w = [x.tobytes() for x in windows(h, size)], [x.tobytes() for x in windows(wt, size)]
                    cols = (np.full(m * blocks, size, np.int32), np.repeat(np.arange(blocks, dtype=np.int32), m), v.ravel(), _bits(v, sizes.index(size), radius).ravel(), np.tile(fp.view(np.int64), blocks), np.full(m * blocks, item))
                    yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(seq * blocks, pa.binary()), pa.array(w * blocks, pa.binary())], ["size", "block", "value", "bit", "fp", "item", "seq", "weights"])

    return materialise(weighed.mapInArrow(cut, "size int, block int, value long, bit long, fp long, item long, seq binary, weights binary"), "windows")


def document_windows(docs: DataFrame, id_col: str, text_col: str, sizes: Sequence[int], radius: int, index) -> DataFrame:
    """(size, block, value, key, doc_fp, doc_seq): the windows that agree with some item window in a block."""
    src = docs.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("key"), F.col(text_col).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        each = np.split(index.value, len(sizes))  # sizes that no item has hold no window
        live = [(no, size) for no, size in enumerate(sizes) if each[no].any()]
        for b in batches:
            for k in range(0, b.num_rows, 250):
                part = b.slice(k, 250)
                ws = [words(t) for t in part.column(1).to_pylist()]
                of = np.repeat(np.arange(len(ws)), np.fromiter(map(len, ws), np.int64, len(ws)))
                every = hashes.array([w for x in ws for w in x])
                for no, size in live:
                    for at in range(0, len(every) - size + 1, CHUNK):
                        yield from emit(part.column(0), every[at:at + CHUNK + size - 1], of[at:at + CHUNK + size - 1], no, size)

    def emit(keys: pa.Array, h: np.ndarray, of: np.ndarray, no: int, size: int) -> Iterator[pa.RecordBatch]:
        fp = simhash(h, size)
        v = values(fp, radius)
        inside = of[:len(fp)] == of[size - 1:]
        block, at = np.nonzero(bits.has(index.value, _bits(v, no, radius)) & inside)
        if len(at):
            seq = windows(h, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), size, np.int32)), pa.array(block.astype(np.int32)), pa.array(v[block, at]), keys.take(pa.array(of[at])), pa.array(fp[at].view(np.int64)), pa.array([seq[i].tobytes() for i in at], pa.binary())],
                ["size", "block", "value", "key", "doc_fp", "doc_seq"])

    return src.mapInArrow(run, f"size int, block int, value long, key {src.schema['key'].dataType.simpleString()}, doc_fp long, doc_seq binary")


def leaking_windows(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_texts: Sequence[str] = ("passage", "question"),
                    sizes: Sequence[int] = (UNIT,), radius: int = RADIUS, least: float = LEAST, exact: bool = False) -> DataFrame:
    """(key, item, similarity) of every document window and item window within the radius and at least ``least`` alike; equal ones alone if ``exact``."""
    sizes = tuple(sizes)
    found = item_windows(items, item_col, item_texts, sizes, radius, len(sizes) > 1)
    index = docs.sparkSession.sparkContext.broadcast(bits.index(found, F.col("bit"), len(sizes) * (radius + 1) << VALUE_BITS))
    mine = document_windows(docs, id_col, text_col, sizes, radius, index)
    near = mine.join(found.drop("bit"), ["size", "block", "value"]).where(F.bit_count(F.col("doc_fp").bitwiseXOR(F.col("fp"))) <= radius)
    kind = mine.schema["key"].dataType.simpleString()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part = b.slice(k, 500)
                sizes_here = part.column(0).to_numpy()
                for size in np.unique(sizes_here):
                    mask = pa.array(sizes_here == size)
                    rows = part.filter(mask)
                    a, i, w = (np.frombuffer(b"".join(rows.column(c).to_pylist()), dtype=t).reshape(-1, size) for c, t in ((3, np.uint64), (4, np.uint64), (5, np.float32)))
                    alike = similarity(a, i, w)
                    keep = pa.array(alike >= least)
                    yield pa.RecordBatch.from_arrays([rows.column(1).filter(keep), rows.column(2).filter(keep), pa.array(alike.astype(np.float64)).filter(keep), rows.column(6).filter(keep)], ["key", "item", "similarity", "same"])

    near = near.select("size", "key", "item", "doc_seq", "seq", "weights", (F.col("doc_seq") == F.col("seq")).alias("same"))
    alike = near.mapInArrow(verify, f"key {kind}, item long, similarity double, same boolean")
    return (alike.where("same") if exact else alike).drop("same")


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", unit: int = UNIT, **options) -> DataFrame:
    """(id_col, item_col) for each document that holds ``unit`` consecutive words of an item."""
    pairs = leaking_windows(docs, items, id_col, item_col=item_col, sizes=(unit,), exact=True, **options)
    return pairs.select(F.col("key").alias(id_col), F.col("item").alias(item_col)).distinct()


def find_near(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", sizes: Sequence[int] = SIZES, **options) -> DataFrame:
    """(id_col, item_col, similarity): documents that hold an item as a whole, perhaps with changed words, and the greatest similarity."""
    pairs = leaking_windows(docs, items, id_col, item_col=item_col, sizes=sizes, **options)
    return pairs.groupBy(F.col("key").alias(id_col), F.col("item").alias(item_col)).agg(F.max("similarity").alias("similarity"))
