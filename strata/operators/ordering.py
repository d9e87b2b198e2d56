"""A global order as a column, without one task that sorts everything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import scratch_path

#: The lower bits of a row's id count within its partition.
_PARTITION_BITS = 33


def with_positions(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``df`` with each row's place, from 1 on, in the order of ``order``.

    Spark deals the rows out in ranges of the order and sorts each range. The rows
    are written with their place in their range; a range's offset is the sum of
    the ranges before it, so the only window runs over one row for each range.
    Rows that ``order`` does not tell apart get places next to each other.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "ordered")
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # a row's id is its partition and, in the lower bits, its place there
    at = F.monotonically_increasing_id()
    sorted_rows.withColumn("_id", at).select(
        *df.columns, F.shiftright("_id", _PARTITION_BITS).alias("_range"), F.col("_id").bitwiseAND((1 << _PARTITION_BITS) - 1).alias("_at")
    ).write.parquet(path)
    placed = spark.read.parquet(path)
    sizes = placed.groupBy(F.col("_range").alias("_of")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_of", F.coalesce(before, F.lit(0)).alias("_offset"))
    # a row for each range, of which there are as many as shuffle partitions
    joined = placed.join(F.broadcast(offsets), F.col("_range") == F.col("_of"))
    return joined.select(*df.columns, (F.col("_offset") + F.col("_at") + 1).alias(name))
