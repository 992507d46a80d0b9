"""Small helpers that the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries that a worker's word memory holds at most.
MEMORY = 400_000
#: Length up to which words are remembered.
LONG = 256


class WordMemory(dict):
    """Remembers ``make(word)`` for at most ``limit`` words; long words are made anew each time.

    When half of them are new, words that were not used meanwhile are forgotten.
    """

    def __init__(self, make, limit: int = MEMORY):
        super().__init__()
        self.make, self.limit, self.before = make, limit, {}

    def __missing__(self, word):
        value = self.before.get(word)
        if value is None:
            value = self.make(word)
        if len(word) <= LONG:
            if len(self) >= self.limit // 2:
                self.before = dict(self)
                self.clear()
            self[word] = value
        return value


def hash64(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little")


def word_hashes(memory: WordMemory, words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes, in order."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n])
    return h


def text_blocks(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch of about ``limit`` characters, with their texts (null: empty)."""
    ends = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        part = batch.slice(at, stop - at)
        yield part, [t or "" for t in part.column(column).to_pylist()]
        at = stop


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n``; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    return stem if stem not in taken else f"{stem}_{uuid.uuid4().hex[:8]}"


def parts_for(bytes_total: int, per_part: int, least: int = 1) -> int:
    return max(least, -(-int(bytes_total) // per_part))
