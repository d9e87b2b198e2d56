"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` points on a ring of 64-bit hashes. A row belongs to
the arc that ends at the next point clockwise, and that point's shard takes it
unless it is full; rows that find their shard full go on clockwise to the next
shard with room. With ``slack`` 0 the capacities differ by one row at most, so
all counts do; a larger slack lets counts differ and moves fewer rows when the
number of shards changes.

Rows enter the ring arc by arc, homes first. So the places of all rows follow
from the number of rows in each arc: the driver sees at most shards x vnodes
counts, and rows find their place from their rank in the arc. Ranks come from
windows over pieces of an arc; equal rows are counted before the shuffle and
laid out again afterwards, so no key needs a large group in one task.

Defined cases: a null id hashes by size and checksum; a null text has size 1 and
the checksum of the empty text; equal rows are interchangeable and take
neighbouring slots; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.support import written

PIECES = 16


def ring_points(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Ring positions in order, and the shard of each."""
    if shards < 1 or vnodes < 1:
        raise ValueError("a ring needs at least one shard and one point")
    at = {
        int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "big", signed=True): s
        for s in range(shards)
        for v in range(vnodes)
    }
    points = sorted(at)
    return np.array(points, np.int64), np.array([at[p] for p in points], np.int64)


def place_arcs(owner: np.ndarray, counts: np.ndarray, capacity: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(arc, from rank, to rank, shard, first slot): where the rows of every arc go."""
    room, used, out = capacity.copy(), np.zeros(len(capacity), np.int64), []

    def put(arc: int, begin: int, n: int, shard: int) -> None:
        out.append((arc, begin, begin + n, int(shard), int(used[shard])))
        used[shard] += n
        room[shard] -= n

    placed = np.minimum(counts, 0)
    for arc in np.flatnonzero(counts):
        if n := int(min(counts[arc], room[owner[arc]])):
            put(int(arc), 0, n, owner[arc])
            placed[arc] = n
    for arc in np.flatnonzero(counts > placed):
        step = arc
        while placed[arc] < counts[arc]:
            step = (step + 1) % len(owner)
            if n := int(min(counts[arc] - placed[arc], room[owner[step]])):
                put(int(arc), int(placed[arc]), n, owner[step])
                placed[arc] += n
    return out


def ring_shards(
    df: DataFrame, shards: int = 16, vnodes: int = 128, slack: float = 0.0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, size, text_crc32, shard, slot for each row; slots are gapless from 0 in each shard."""
    spark = df.sparkSession
    points, owner = ring_points(shards, vnodes)

    @F.pandas_udf("int")
    def arc_of(h: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(points, h.to_numpy()) % len(points)).astype("int32")

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
    ).withColumn("h", F.when(F.col("id").isNull(), F.xxhash64("size", "crc")).otherwise(F.xxhash64("id")))
    # equal rows become one with a count
    keyed = rows.groupBy("id", "size", "crc", "h").agg(F.count("*").alias("n")).withColumn("arc", arc_of("h"))
    keyed = written(keyed.withColumn("piece", F.pmod(F.shiftright("h", 7), F.lit(PIECES)).cast("int")), "ring-rows")

    pieces = written(keyed.groupBy("arc", "piece").agg(F.sum("n").alias("n")), "ring-pieces")
    counts = np.zeros(len(points), np.int64)
    for arc, n in pieces.groupBy("arc").agg(F.sum("n")).collect():  # at most shards x vnodes rows
        counts[arc] = n
    total = int(counts.sum())
    capacity = np.full(shards, total // shards) + (np.arange(shards) < total % shards)
    capacity = np.ceil(capacity * (1 + slack)).astype(np.int64)
    plan = spark.createDataFrame(
        place_arcs(owner, counts, capacity), "p_arc int, low long, high long, shard int, base long"
    )
    before = Window.partitionBy("arc").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("arc", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("arc", "piece").orderBy("h", "id", "size", "crc").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        keyed.withColumn("inner", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(F.broadcast(offsets), ["arc", "piece"])  # at most shards x vnodes x PIECES rows
        .withColumn("rank", F.explode(F.expr("sequence(offset + inner, offset + inner + n - 1)")))
    )
    return ranked.join(
        F.broadcast(plan),  # at most a few rows for each arc
        (F.col("arc") == F.col("p_arc")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    ).select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("base") + F.col("rank") - F.col("low")).alias("slot"),
    )
