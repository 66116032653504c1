"""Words of a text: longest runs of letters and digits, in lower case."""

from __future__ import annotations

import re

import numpy as np
import xxhash

find_words = re.compile(r"[^\W_]+").findall


def words(text: str | None) -> list[str]:
    return find_words(text.lower()) if text else []


class WordHashes(dict):
    """word -> 64-bit hash, remembered; starts anew when it grows beyond ``limit``."""

    def __init__(self, limit: int = 1_000_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) > self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def array(self, ws: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), dtype=np.uint64, count=len(ws))
