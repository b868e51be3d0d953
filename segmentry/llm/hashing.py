"""Words and their hashes inside Arrow tasks.

Words are runs of bytes other than 0x20 and 0x09-0x0D, cut on the UTF-8 text. The functions travel to the
workers inside the pickled function that uses them.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The memory of word hashes is emptied when it holds so many; longer words are hashed each time.
WORDS_KEPT = 100_000
WORD_BYTES_KEPT = 64
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class WordHashes(dict):
    """A 64-bit hash for each word (bytes)."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= WORD_BYTES_KEPT:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """The words of a text; ``lower`` changes A-Z only. Null has none."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x`` (uint64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """A hash of every run of ``size`` words; ``which`` picks one of two independent functions."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    source = hashes if which == 0 else mixed(hashes + np.uint64(MULTIPLIERS[1]))
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = out * np.uint64(MULTIPLIERS[which]) + source[j : j + n]
    return mixed(out)


def row_hash(rows: DataFrame) -> Column:
    """A hash of all columns of a row but those that hold maps, which have no order."""
    return F.xxhash64(*(F.col(f"`{f.name}`") for f in rows.schema if "map<" not in f.dataType.simpleString()))


def strings(column: pa.Array | pa.ChunkedArray) -> list:
    return column.to_pylist()
