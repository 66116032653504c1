"""Compressed bitmaps of document ids, in blocks of 65,536 ids.

A block holds the low 16 bits of the ids that share their high bits, either as a
sorted array of 2-byte numbers or as a bit set of 8 KB, whichever is smaller.
"""

from __future__ import annotations

import numpy as np

BLOCK_BITS = 16
MASK = (1 << BLOCK_BITS) - 1
_DENSE = 4096


def pack(low: np.ndarray) -> bytes:
    """A block from low bits in any order, repeats allowed."""
    if len(low) == 1:
        return b"a" + int(low[0]).to_bytes(2, "little")
    low = np.unique(np.asarray(low, dtype=np.int64)).astype("<u2")
    if len(low) <= _DENSE:
        return b"a" + low.tobytes()
    bits = np.zeros(1 << BLOCK_BITS, dtype=bool)
    bits[low] = True
    return b"b" + np.packbits(bits, bitorder="little").tobytes()


def unpack(block: bytes) -> np.ndarray:
    """The sorted low bits of a block."""
    if block[:1] == b"a":
        return np.frombuffer(block, dtype="<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(block, dtype=np.uint8, offset=1), bitorder="little"))


def union(blocks: list[bytes]) -> bytes:
    return pack(np.concatenate([unpack(b) for b in blocks]) if blocks else np.zeros(0))


def cardinality(block: bytes) -> int:
    return (len(block) - 1) // 2 if block[:1] == b"a" else int(np.unpackbits(np.frombuffer(block, dtype=np.uint8, offset=1)).sum())


def contains(block: bytes, low: np.ndarray) -> np.ndarray:
    """For each low value whether its bit is set."""
    if block[:1] == b"a":
        return np.isin(low, np.frombuffer(block, dtype="<u2", offset=1))
    bits = np.zeros(1 << BLOCK_BITS, dtype=bool)
    bits[unpack(block)] = True
    return bits[np.asarray(low, dtype=np.int64)]
