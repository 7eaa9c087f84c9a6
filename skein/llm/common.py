"""Helpers shared by the operators: table access, text blocks, word shingles.

Texts travel to Python as binary columns. ``bytes.lower`` changes A-Z only and
``bytes.split`` cuts at exactly 0x20 and 0x09-0x0D, which is the word rule of
every operator here; UTF-8 continuation bytes are never touched by either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.session import configure

# rows and bytes a Python worker receives at once; bounds its memory
ARROW_ROWS = "1000"
ARROW_BYTES = str(8 << 20)

_MASK = (1 << 64) - 1
_SHIFT1, _SHIFT2 = np.uint64(33), np.uint64(29)
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_GOLDEN = 0x9E3779B97F4A7C15


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators (idempotent)."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def split_remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod


def as_bytes(col: str, name: str = "text") -> Column:
    return F.col(col).cast("binary").alias(name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def blocks(batches: Iterator, max_bytes: int, text_at: int = -1) -> Iterator[list[list]]:
    """Regroup Arrow batches into lists of columns holding about ``max_bytes``
    of text (one longer text makes a block of its own)."""
    held, size = None, 0
    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        start = 0
        for i, text in enumerate(cols[text_at]):
            n = len(text) if text else 0
            if size and size + n > max_bytes:
                part = [c[start:i] for c in cols]
                yield [a + b for a, b in zip(held, part)] if held else part
                held, size, start = None, 0, i
            size += n + 1
        part = [c[start:] for c in cols]
        held = [a + b for a, b in zip(held, part)] if held else part
    if held and held[0]:
        yield held


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer (vectorised)."""
    x = (x ^ (x >> _SHIFT1)) * _MIX1
    x = (x ^ (x >> _SHIFT2)) * _MIX2
    return x ^ (x >> _SHIFT1)


def odd_constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    k = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_GOLDEN) + np.uint64((seed * 0x632BE59BD9B4E019) & _MASK)
    return mix(k) | np.uint64(1)


class WordHashes(dict):
    """Memo word -> 64-bit hash, emptied when it grows past ``limit`` words."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxh3_64_intdigest(word)
        return h


def word_hashes(text: bytes | None, memo: WordHashes) -> np.ndarray:
    words = text.lower().split() if text else []
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """64-bit fingerprints of all ``width``-word shingles in order; a shorter
    non-empty sequence is one shingle, an empty one has none."""
    n = len(hashes)
    if n == 0:
        return hashes
    w = min(n, width)
    mult = odd_constants(width, 1)
    m = n - w + 1
    acc = np.full(m, np.uint64((w * _GOLDEN) & _MASK), np.uint64)
    for j in range(w):
        acc += hashes[j:j + m] * mult[j]
    return mix(acc)
