"""Near-duplicate lists by min-max hashing (problem 1).

The shingles of a record are the distinct sequences of three neighbouring words
inside one of its strings. ``PERMS`` permutations give both their minimum and
their maximum, so ``2 * PERMS`` signature slots cost ``PERMS`` hash evaluations.
A band joins ``ROWS`` slots of different permutations; records that agree in a
band are candidates. Candidates are thinned by the 120-bit sketch of their
slots and verified by the exact Jaccard similarity of their shingles.

With similarity J a pair is missed with probability (1 - J**3)**40: 0.5 % at
J = 0.5, 0.07 % at 0.55, 0.002 % at 0.6 (and less than 0.02 % by the sketch).

Scale: records with equal shingle sets are one class from the start (their
64-bit set hash is the identity that bands, candidates and verification use),
so a hot text adds one entry per band, not all pairs, and is collapsed in each
task before the shuffle. Bands are joined by an equi join whose shuffle the engine
asks for itself, so that AQE splits a hot band's partition. Only 16 bytes per band
entry are shuffled. The candidate classes are written to the shared folder before
they are verified, which frees the shuffle files of the first part, and deleted
once they are thinned. A bitmap of fixed size tells the workers which classes have
candidates; no other class's shingles are shuffled.

Defined results: null or empty lists, null strings and strings of fewer than
three words have no shingles; records without shingles have no pairs. Repeated
ids are one record per distinct content.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialise, release, remove, shared_dir, written
from . import bits
from .words import WordHashes

GRAM, PERMS, ROWS, THRESHOLD = 3, 60, 3, 0.5
BANDS = 2 * PERMS // ROWS
#: Equal bits, of 120, under which no pair at J >= 0.5 is expected (3.9 deviations below the mean of 90).
SKETCH_LEAST = 71
_CUT = "\x1f"
_tokens = re.compile(r"[^\W_]+|\x1f").findall
_M = np.uint64(0xFFFFFFFFFFFF)
_rng = np.random.default_rng(20240229)
_MUL = _rng.integers(1, 1 << 63, PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, PERMS, dtype=np.uint64)
_BAND_MUL = _rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BIT_MUL = _rng.integers(1, 1 << 63, 2 * PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(lists: list, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 48-bit shingle hashes of each list, sorted, and the list number of each."""
    texts: list[str] = []
    owner = []
    for i, facts in enumerate(lists):
        for f in facts if facts is not None else ():
            if f:
                texts.append(f)
                owner.append(i)
    tokens = _tokens(_CUT.join(t.replace(_CUT, " ") if _CUT in t else t for t in texts).lower())
    if len(tokens) < GRAM:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = hashes.array(tokens)
    cut = h == np.uint64(hashes[_CUT])
    part = np.cumsum(cut)
    g = h[:-2] * np.uint64(0x9E3779B97F4A7C15)
    g ^= g >> np.uint64(29)
    g = (g + h[1:-1]) * np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(31)
    g = (g + h[2:]) * np.uint64(0x94D049BB133111EB)
    inside = (part[:-2] == part[2:]) & ~cut[:-2]
    key = np.unique(np.array(owner, dtype=np.uint64)[part[:-2][inside]] << np.uint64(48) | g[inside] >> np.uint64(16))
    return key & _M, (key >> np.uint64(48)).astype(np.int64)


def signatures(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(2 * PERMS, sets) slots: the minima of all permutations, then their maxima."""
    out = np.empty((2 * PERMS, len(first)), dtype=np.uint64)
    for p in range(PERMS):
        v = (shingles * _MUL[p] + _ADD[p]) >> np.uint64(32)
        out[p] = np.minimum.reduceat(v, first)
        out[PERMS + p] = np.maximum.reduceat(v, first)
    return out


def _set_hash(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    x = shingles * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(29)
    return np.add.reduceat(x, first).view(np.int64)


def _bands(slots: np.ndarray) -> np.ndarray:
    """(BANDS, sets) keys of 32 bits."""
    out = np.empty((BANDS, slots.shape[1]), dtype=np.int64)
    for b in range(BANDS):
        mixed = np.zeros(slots.shape[1], dtype=np.uint64)
        for r in range(ROWS):
            mixed = (mixed ^ slots[ROWS * b + r]) * _BAND_MUL[r]
            mixed ^= mixed >> np.uint64(31)
        out[b] = (mixed >> np.uint64(32)).astype(np.int64)
    return out


def _sketch(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = (slots * _BIT_MUL[:, None] >> np.uint64(63)).astype(np.int64)
    half = np.left_shift(np.int64(1), np.arange(PERMS, dtype=np.int64))[:, None]
    return (bits[:PERMS] * half).sum(axis=0), (bits[PERMS:] * half).sum(axis=0)


def _scan(df: DataFrame, id_col: str, list_col: str, emit, schema: str, bare=None, wanted=None) -> DataFrame:
    some = F.col(id_col).isNotNull() if bare else F.col(list_col).isNotNull() & F.col(id_col).isNotNull()
    src = df.where(some).select(F.col(id_col).cast("long").alias("id"), F.col(list_col).cast("array<string>").alias("items"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        if wanted is not None:
            seen = _Wanted(wanted.value)
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                part = b.slice(k, 1000)
                shingles, own = shingle_sets(part.column(1).to_pylist(), hashes)
                if len(own):
                    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                    ids = part.column(0).to_numpy(zero_copy_only=False)[own[first]]
                    yield from emit(ids, shingles, first, seen)
                if bare and len(rest := np.setdiff1d(np.arange(part.num_rows), own)):
                    yield from bare(part.column(0).to_numpy(zero_copy_only=False)[rest])

    return src.mapInArrow(run, schema)


#: Bits of the bitmap of the classes that have candidates: 8 MB.
BITS = 1 << 26


class _Wanted(set):
    """Classes met before; those without their bit in a bitmap count as met."""

    def __init__(self, bitmap: np.ndarray):
        super().__init__()
        self.bitmap = bitmap

    def left(self, fp: np.ndarray) -> np.ndarray:
        return np.flatnonzero(bits.has(self.bitmap, fp & (BITS - 1)))


def _unseen(fp: np.ndarray, seen: set) -> np.ndarray:
    """Places of set hashes that this task has not emitted yet; it forgets beyond 2 million."""
    if len(seen) > 2_000_000:
        seen.clear()
    out = []
    at = seen.left(fp) if isinstance(seen, _Wanted) else np.arange(len(fp))
    for i, f in zip(at.tolist(), fp[at].tolist()):
        if f not in seen:
            seen.add(f)
            out.append(i)
    return np.array(out, dtype=np.int64)


def _emit_signatures(ids, shingles, first, seen):
    slots = signatures(shingles, first)
    s1, s2 = _sketch(slots)
    keys = np.ascontiguousarray(_bands(slots).T.astype("<u4"))
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(_set_hash(shingles, first)), pa.array(s1), pa.array(s2), pa.array([k.tobytes() for k in keys], pa.binary())],
        ["id", "fp", "s1", "s2", "bands"])


def _emit_bare(ids):
    none = [pa.nulls(len(ids), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
    yield pa.RecordBatch.from_arrays([pa.array(ids), *none], ["id", "fp", "s1", "s2", "bands"])


def _band_rows(signed: DataFrame) -> DataFrame:
    """(key, fp) for every band of every class; classes met before in a task are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        high = np.arange(BANDS, dtype=np.int64) << 32
        for b in batches:
            for k in range(0, b.num_rows, 2000):
                fp = b.column(0).slice(k, 2000).to_numpy(zero_copy_only=False)
                new = _unseen(fp, seen)
                if len(new):
                    low = np.frombuffer(b"".join(b.column(1).slice(k, 2000).take(pa.array(new)).to_pylist()), dtype="<u4").reshape(-1, BANDS)
                    yield pa.RecordBatch.from_arrays([pa.array((low.astype(np.int64) | high).ravel()), pa.array(np.repeat(fp[new], BANDS))], ["key", "fp"])

    return signed.select("fp", "bands").mapInArrow(run, "key long, fp long")


def _emit_sets(ids, shingles, first, seen):
    fp = _set_hash(shingles, first)
    raw = shingles.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    ends = np.r_[first[1:], len(shingles)]
    new = _unseen(fp, seen)
    yield pa.RecordBatch.from_arrays([pa.array(fp[new]), pa.array([raw[first[i]:ends[i]].tobytes() for i in new], pa.binary())], ["fp", "grams"])


def _grams(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of all sets in one array, each with the number of its set in the high bits, and the sizes of the sets."""
    sizes = np.fromiter((len(r) // 6 for r in raw), np.int64, len(raw))
    a = np.zeros((sizes.sum(), 8), dtype=np.uint8)
    a[:, :6] = np.frombuffer(b"".join(raw), dtype=np.uint8).reshape(-1, 6)
    return a.view("<u8").ravel() | np.repeat(np.arange(len(raw), dtype=np.uint64) << np.uint64(48), sizes), sizes


def jaccards(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Similarity of each pair of sets; at most 65,536 pairs."""
    (x, nx), (y, ny) = _grams(a), _grams(b)
    both = np.bincount((np.intersect1d(x, y, assume_unique=True) >> np.uint64(48)).astype(np.int64), minlength=len(a))
    return both / (nx + ny - both)


@F.pandas_udf(T.DoubleType())
def _similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    step = 2000
    parts = [jaccards(a.iloc[k:k + step].tolist(), b.iloc[k:k + step].tolist()) for k in range(0, len(a), step)]
    return pd.Series(np.concatenate(parts) if parts else [], dtype="float64")


def signed_records(df: DataFrame, id_col: str = "set_id", list_col: str = "facts", bare: bool = False) -> DataFrame:
    """(id, fp, s1, s2, bands) of every record with shingles, as a table in the shared folder; with ``bare`` of the others too, all null but the id."""
    rows = _scan(df, id_col, list_col, _emit_signatures, "id long, fp long, s1 long, s2 long, bands binary", _emit_bare if bare else None)
    return materialise(rows, "signatures")


def _candidates(signed: DataFrame, folder: str) -> DataFrame:
    bands = _band_rows(signed)
    a, b = bands.select("key", F.col("fp").alias("fp_a")), bands.select("key", F.col("fp").alias("fp_b"))
    return written(a.join(b, "key").where("fp_a < fp_b").select("fp_a", "fp_b").distinct(), folder)


def _thinned(signed: DataFrame, pairs: DataFrame) -> DataFrame:
    sketch = signed.select("fp", "s1", "s2").dropDuplicates(["fp"])
    sa = sketch.select(F.col("fp").alias("fp_a"), F.col("s1").alias("a1"), F.col("s2").alias("a2"))
    sb = sketch.select(F.col("fp").alias("fp_b"), F.col("s1").alias("b1"), F.col("s2").alias("b2"))
    unlike = F.bit_count(F.col("a1").bitwiseXOR(F.col("b1"))) + F.bit_count(F.col("a2").bitwiseXOR(F.col("b2")))
    return materialise(pairs.join(sa, "fp_a").join(sb, "fp_b").where(2 * PERMS - unlike >= SKETCH_LEAST).select("fp_a", "fp_b"), "thinned")


def similar_classes(df: DataFrame, signed: DataFrame, id_col: str = "set_id", list_col: str = "facts", threshold: float = THRESHOLD) -> DataFrame:
    """(fp_a, fp_b, similarity) for all pairs of different classes at ``threshold`` (0.5 or more)."""
    spark = df.sparkSession
    folder = shared_dir(spark, "candidates")
    pairs = _candidates(signed, folder)
    release(spark)
    thin = _thinned(signed, pairs)
    remove(spark, folder)
    release(spark)
    # the shingles of classes without candidates stay where they are
    ends = thin.select(F.explode(F.array("fp_a", "fp_b")).alias("fp"))
    wanted = spark.sparkContext.broadcast(bits.index(ends, F.col("fp").bitwiseAND(BITS - 1), BITS))
    sets = _scan(df, id_col, list_col, _emit_sets, "fp long, grams binary", wanted=wanted).dropDuplicates(["fp"])
    full = thin.join(sets.select(F.col("fp").alias("fp_a"), F.col("grams").alias("ga")), "fp_a").join(
        sets.select(F.col("fp").alias("fp_b"), F.col("grams").alias("gb")), "fp_b")
    return full.select("fp_a", "fp_b", _similarity("ga", "gb").alias("similarity")).where(F.col("similarity") >= threshold)


def class_table(df: DataFrame, id_col: str = "set_id", list_col: str = "facts") -> DataFrame:
    """(id_col, class_id, links): every record of ``df`` with its class and the links of that class to other classes.

    A class is named by its smallest id. A record without shingles has a null class and 0 links.
    """
    records = signed_records(df, id_col, list_col, bare=True)
    signed = records.where("fp is not null")
    links = similar_classes(df, signed, id_col, list_col)
    both = links.select(F.explode(F.array("fp_a", "fp_b")).alias("fp")).groupBy("fp").agg(F.count("*").alias("links"))
    named = signed.groupBy("fp").agg(F.min("id").alias("class_id")).join(both, "fp", "left").select("fp", "class_id", F.coalesce("links", F.lit(0)).alias("links"))
    classes = signed.select("id", "fp").join(named, "fp").select("id", "class_id", "links")
    none = records.where("fp is null").select("id", F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("links"))
    return classes.unionByName(none).select(F.col("id").alias(id_col), "class_id", "links")


def similar_pairs(df: DataFrame, id_col: str = "set_id", list_col: str = "facts", threshold: float = THRESHOLD) -> DataFrame:
    """(set_a, set_b): every pair of records at the threshold, equal ones included."""
    member = signed_records(df, id_col, list_col)
    links = similar_classes(df, member, id_col, list_col, threshold)
    ma, mb = member.select(F.col("fp").alias("fp_a"), F.col("id").alias("x")), member.select(F.col("fp").alias("fp_b"), F.col("id").alias("y"))
    far = links.join(ma, "fp_a").join(mb, "fp_b").select("x", "y")
    same = ma.join(mb, F.col("fp_a") == F.col("fp_b")).where("x < y").select("x", "y")
    return far.unionByName(same).select(F.least("x", "y").alias("set_a"), F.greatest("x", "y").alias("set_b")).distinct()
