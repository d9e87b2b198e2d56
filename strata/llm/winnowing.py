"""Document fingerprints by winnowing, with positions.

Every run of ``gram`` code points has a rolling hash. Of every ``window``
neighbouring hashes the smallest is chosen, of equal ones the rightmost;
windows that hang over either end of the text count too, so the first and the
last run are always chosen. Two texts that share ``window + gram - 1`` code
points in a row therefore share a fingerprint at matching positions, and chosen
positions are at most ``window`` apart.

Defined cases: a null text counts as empty; an empty text has no fingerprint; a
text shorter than ``gram`` has one, of all its code points; equal texts have
equal fingerprints; two empty fingerprints are alike (1.0), an empty and another
one are not (0.0). ``with_next`` orders rows by id, of rows that repeat an id by
text; rows without id have no place in the order and so no next row; an empty
table gives an empty result. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.support import in_slices

GRAM = 16
WINDOW = 32
#: The hash's base and multiplier.
BASE = 0x9E3779B97F4A7C15
SPREAD = 0x9E3779B1
#: Code points whose powers of the base are kept; longer texts go by in blocks.
BLOCK = 1 << 20
_U = np.uint64
_PAD = np.int64(0x7FFFFFFFFFFFFFFF)
_POWERS: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    if not _POWERS:
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(BLOCK + 1, base, _U)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS


def run_hashes(codes: np.ndarray, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """Hashes, 0 or more, of the runs of ``size`` code points at the ascending places ``start``."""
    up, down = _powers()
    out = np.empty(len(start), np.int64)
    end, most, k = start + size, int(np.max(size, initial=0)), 0
    while k < len(start):
        low = int(start[k])
        n = int(np.searchsorted(start, low + BLOCK - most, "right"))
        n = max(n, k + 1)
        block = codes[low : int(end[k:n].max())].astype(_U) + _U(1)
        total = np.zeros(len(block) + 1, _U)
        np.cumsum(block * up[: len(block)], out=total[1:])
        a, b = start[k:n] - low, end[k:n] - low
        h = (total[b] - total[a]) * down[a]
        h = (h ^ (h >> _U(32))) * _U(SPREAD)
        out[k:n] = ((h ^ (h >> _U(29))) >> _U(1)).view(np.int64)
        k = n
    return out


def chosen(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the rightmost smallest hash of every ``window`` neighbours, ascending; pads are never chosen."""
    at, size = np.arange(len(hashes), dtype=np.int64), 1

    def wider(step: int) -> np.ndarray:
        left, right = at[:-step], at[step:]
        return np.where(hashes[right] <= hashes[left], right, left)

    while 2 * size <= window:
        at, size = wider(size), 2 * size
    if size < window:
        at = wider(window - size)
    at = at[np.append(True, at[1:] != at[:-1])] if len(at) else at
    return at[hashes[at] != _PAD]


def fingerprints(texts: list[str | None], gram: int = GRAM, window: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, positions in code points) of each text, positions ascending."""
    out = []
    for a, b in in_slices(texts):
        parts = [np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts[a:b]]
        n = np.array([len(p) for p in parts])
        first = np.cumsum(n) - n
        count = np.where(n >= gram, n - gram + 1, (n > 0).astype(n.dtype))
        gap = window - 1
        # each text's hashes in a row, with a window less one of pads before and behind
        begin = np.cumsum(count + gap) - count
        text = np.repeat(np.arange(len(n)), count)
        place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        codes = np.concatenate(parts)
        short = np.repeat(n < gram, count)
        row = np.full(count.sum() + gap * (len(n) + 1), _PAD)
        row[begin[text] + place] = run_hashes(codes, first[text] + place, np.where(short, n[text], gram))
        at = chosen(row, window)
        edge = np.searchsorted(at, np.append(begin, len(row)))
        out += [(row[at[i:j]], at[i:j] - s) for i, j, s in zip(edge, edge[1:], begin)]
    return out + [(np.empty(0, np.int64), np.empty(0, np.int64))] * (len(texts) - len(out))


def rendered(hashes: np.ndarray, places: np.ndarray) -> str:
    """Ten hexadecimal digits a fingerprint: two for the distance from the one before (window of 255 at most), eight of the hash."""
    row = np.empty(len(hashes), [("step", ">u1"), ("hash", ">u4")])
    row["step"], row["hash"] = np.diff(places, prepend=0), hashes & 0xFFFFFFFF
    return row.tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared hashes among all different hashes of two fingerprints."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def winnow(df: DataFrame, gram: int = GRAM, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, hashes and positions of each row's fingerprint."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = fingerprints(frame["text"].tolist(), gram, window)
            yield frame[["id"]].assign(hashes=[h for h, _ in found], positions=[p for _, p in found])

    kind = dict(rows.dtypes)["id"]
    return rows.mapInPandas(run, f"id {kind}, hashes array<long>, positions array<int>").withColumnRenamed("id", id_col)


def in_order(rows: DataFrame, parts: int) -> DataFrame:
    """``rows`` (id, text) dealt out in ranges of ids and sorted, each range closed by a copy of the row that follows it.

    Adds ``bucket`` and ``kind``: 0 a row, 1 the row that follows the range (the
    first row of all after the last range), 2 a row without id. The ranges'
    bounds come from a sample of ids, some ``16 * parts`` on the driver; which
    bounds they are does not change any result.
    """
    known, spark = rows.where("id is not null"), rows.sparkSession
    share = min(1.0, 16 * parts / max(1, known.count()))
    picked = known.select("id").where(F.xxhash64("id") <= min(int(share * (1 << 64)) - (1 << 63), (1 << 63) - 1))
    ids = sorted(r["id"] for r in picked.collect())
    bounds = sorted({ids[len(ids) * k // parts] for k in range(1, parts)}) if ids else []

    @F.pandas_udf("int")
    def bucket_of(column: pd.Series) -> pd.Series:
        return column.map(lambda x: bisect_right(bounds, x)).astype("int32")

    tagged = known.withColumn("bucket", bucket_of("id"))
    lowest = sorted(tuple(r) for r in tagged.groupBy("bucket").agg(F.min("id")).collect())  # a row for each range
    before = [b for b, _ in lowest]
    heads = [(before[k - 1], i) for k, (_, i) in enumerate(lowest)]
    head = spark.createDataFrame(heads, f"bucket int, h_id {dict(rows.dtypes)['id']}")
    follow = known.join(F.broadcast(head), F.col("id") == F.col("h_id")).groupBy("bucket", "id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    lone = rows.where("id is null").select("id", "text", F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int").alias("bucket"), F.lit(2).alias("kind"))
    every = tagged.select("id", "text", "bucket", F.lit(0).alias("kind")).union(follow.select("id", "text", "bucket", F.lit(1))).union(lone)
    dealt = every.repartitionById(parts, F.col("bucket"))
    return dealt.sortWithinPartitions("bucket", "kind", "id", F.coalesce("text", F.lit("")))


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def next_likeness(
    df: DataFrame, gram: int = GRAM, window: int = WINDOW, parts: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and how alike it is to that one and to the next row's.

    The texts are shuffled once; a task holds one batch of texts at a time.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = dict(rows.dtypes)["id"]
    schema = (
        f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row before, still waiting for the one that follows it

        def finished(pairs: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
            changed = [edited(t, following[1]) if following else t for (_, t, _), following in pairs]
            prints = fingerprints(changed, gram, window)
            return pa.record_batch(
                [
                    pa.array([i for (i, _, _), _ in pairs], id_type),
                    pa.array([len(t) for (_, t, _), _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                    pa.array([rendered(*p) for (_, _, p), _ in pairs]),
                    pa.array([rendered(*p) for p in prints]),
                    pa.array([likeness(p[0], q[0]) for ((_, _, p), _), q in zip(pairs, prints)], pa.float64()),
                    pa.array([f and likeness(p[0], f[2][0]) for (_, _, p), f in pairs], pa.float64()),
                ],
                names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            ids, kinds = batch["id"].to_pylist(), batch["kind"].to_pylist()
            for a, b in in_slices(texts):
                pairs = []
                for i, t, k, p in zip(ids[a:b], texts[a:b], kinds[a:b], fingerprints(texts[a:b], gram, window)):
                    row = (i, t, p)
                    if last:
                        pairs.append((last, row))
                    if k == 2:
                        pairs.append((row, None))
                    last = row if k == 0 else None
                if pairs:
                    yield finished(pairs, batch["id"].type)

    return in_order(rows, parts).mapInArrow(run, schema).withColumnRenamed("id", id_col)
