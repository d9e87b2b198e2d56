"""Full extracts of dimensions from a database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.files import land_csv


def read_table(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    key: str | None = None,
    readers: int = 1,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """A database table. With ``key``, ``readers`` ranges of it are read side by side.

    The ends of the ranges come from a one-row query that the database answers.
    They only set the stride; rows outside of them are read as well.
    """
    source = spark.read.format("jdbc").options(**connection).option("fetchsize", fetch_rows)
    if key is None or readers < 2:
        return source.option("dbtable", table).load()
    ends = source.option("query", f"SELECT min({key}) AS low, max({key}) AS high FROM {table}").load()
    low, high = ends.first()
    # the reader object keeps its options, so start from a fresh one
    source = spark.read.format("jdbc").options(**connection).option("fetchsize", fetch_rows)
    source = source.option("dbtable", table)
    if low is None:
        return source.load()
    return source.options(
        partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=readers
    ).load()


def extract_dimension(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    folder: str,
    batch: int,
    key: str | None = None,
    readers: int = 1,
) -> str:
    """Land a whole dimension as CSV in the folder of its batch and return that folder."""
    rows = read_table(spark, connection, table, key, readers)
    target = f"{folder.rstrip('/')}/source_batch_id={batch}"
    land_csv(rows.select([F.col(c).cast("string").alias(c) for c in rows.columns]), target)
    return target
