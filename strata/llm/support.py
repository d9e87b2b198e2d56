"""Helpers that the operators share: tables, written intermediates, word hashes."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strata.session import scratch_path

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return freed memory to the system at the end of a task: Spark keeps Python workers for later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, U64)
    p[0] = 1
    return np.multiply.accumulate(p)


_KNOWN_POWERS: list[np.ndarray] = []
#: Length of the power tables that are kept.
KEPT_POWERS = 1 << 21


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, ``n`` at least: sums of byte x power make rolling hashes."""
    if n > KEPT_POWERS:
        return _powers(_BASE, n), _powers(U64(pow(int(_BASE), -1, 1 << 64)), n)
    if not _KNOWN_POWERS:
        _KNOWN_POWERS[:] = _powers(_BASE, KEPT_POWERS), _powers(U64(pow(int(_BASE), -1, 1 << 64)), KEPT_POWERS)
    return _KNOWN_POWERS[0], _KNOWN_POWERS[1]


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all texts in a row, and where each text's words begin.

    A word is a run of ASCII letters and digits and of any characters beyond
    ASCII. A null or empty text has no words.
    """
    parts = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" " + b" ".join(parts) + b" ", np.uint8)
    begins = np.cumsum([1, *(len(p) + 1 for p in parts)])
    inside = _WORD[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    up, down = power_tables(len(data) + 1)
    total = np.empty(len(data) + 1, U64)
    total[0] = 0
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start] + (end - start).astype(U64))
    return hashes, np.searchsorted(start, begins)


def shingles_of(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within each text, and where each text's begin.

    A text with fewer words, but at least one, has one shingle: all its words.
    """
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    begin = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], count)
    left = np.repeat(first[1:], count) - at
    out = np.zeros(begin[-1], U64)
    for k in range(size):
        has = left > k
        out[has] = mix(out[has] * _BASE + words[at[has] + k])
    return out, begin


def in_slices(texts: list[str | None], most: int = 1 << 20):
    """(from, to) over ``texts`` with about ``most`` characters each, one text at least."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if size and size + n > most:
            yield begin, i
            begin, size = i, 0
        size += n + 1
    if size:
        yield begin, len(texts)
