"""What the text operators share: tables, blocks of texts as bytes, words, hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Texts are worked on in blocks of about so many bytes, whatever the size of an Arrow batch.
BLOCK_BYTES = 1 << 20

BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fold(column: str, parts: int) -> Column:
    """Remainder of the CRC-32 of the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (one more for the end)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, at, data = texts.buffers()
    if len(texts) == 0 or at is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(at, np.int64 if large else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    at = at.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def blocks(at: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` bytes together, at least one text each."""
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, last
        first = last


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective finaliser on 64 bits (splitmix)."""
    x = x + np.uint64((seed * 0xD1342543DE82EF95 + 0x9E3779B97F4A7C15) & MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2^64 and their inverses, grown on demand."""

    def __init__(self, base: int = BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64))])
                for b in (self.base, self.inverse)
            )
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """h with h[j] - h[i] = sum of (value + 1) * base^position over positions i..j-1."""
    up, _ = POWERS.to(len(values) + 1)
    h = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=h[1:])
    return h


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of the values at start..end-1, the same wherever they stand."""
    _, down = POWERS.to(len(h))
    size = (end - start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return mix((h[end] - h[start]) * down[start] + size, seed)


def word_bounds(
    data: np.ndarray, at: np.ndarray, gap: np.ndarray = IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for every text the number of words before it.

    `gap` tells for each byte value whether it stands between words.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    space = gap[data]
    filled = at[:-1][at[:-1] < at[1:]]
    before = np.empty(n, bool)
    before[0], before[1:] = True, space[:-1]
    before[filled] = True
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, space[1:]
    after[filled[1:] - 1] = True
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(after & ~space) + 1
    return starts, ends, np.searchsorted(starts, at)


def long_column(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))


def list_column(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    """A list per text, of the given sizes, from all values one after another."""
    at = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), values)
