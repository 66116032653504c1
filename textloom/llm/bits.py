"""Bitmaps of fixed size over hashed values, put together by the engine and looked up by the workers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

_BYTES = 4096  # of one bucket of the engine's bitmap functions


def index(rows: DataFrame, bit: Column, n_bits: int) -> np.ndarray:
    """The bits, from 0 to below ``n_bits``, that the rows have; n_bits / 8 bytes reach the driver at most, whatever the rows."""
    n = bit + 1  # the engine numbers bits, and their buckets, from 1
    found = rows.groupBy(F.bitmap_bucket_number(n).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bits")).collect()
    out = np.zeros(-(-n_bits // 8 // _BYTES) * _BYTES, dtype=np.uint8)
    for r in found:
        at = (r["at"] - 1) * _BYTES
        out[at:at + _BYTES] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def has(bitmap: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """For each number whether its bit is set."""
    return bitmap[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1
