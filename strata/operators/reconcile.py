"""Checks between layers and between files and their manifest.

Two sides are compared by stacking them and grouping by the key, not by a full
outer join: the rows are summed before the shuffle, so a key with very many
rows on one side is no burden, and a key may repeat.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import exact_sum, path_prefix, to_units


def layer_checks(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Bronze holds rows, Silver holds keys, Gold has positive revenue: check, value, passed."""
    parts = [
        bronze.agg(F.count("*").cast("double").alias("value")).select(
            F.lit("bronze_rows").alias("check"), "value"
        ),
        silver.agg(F.count_distinct("order_id").cast("double").alias("value")).select(
            F.lit("silver_orders").alias("check"), "value"
        ),
        gold.agg(
            (exact_sum(to_units(F.col("revenue"))).cast("double") / F.lit(100.0)).alias("value")
        ).select(F.lit("gold_revenue").alias("check"), "value"),
    ]
    checks = reduce(DataFrame.unionByName, parts)
    return checks.withColumn("passed", F.coalesce(F.col("value") > 0, F.lit(False)))


def assert_layers(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> None:
    """Run the checks (three rows come back) and raise if one does not pass."""
    failed = [r["check"] for r in layer_checks(bronze, silver, gold).collect() if not r["passed"]]
    if failed:
        raise AssertionError(f"layer checks failed: {failed}")


def reconcile_layers(
    layers: Mapping[str, DataFrame], batch: str = "source_batch_id", rows: str | None = None
) -> DataFrame:
    """Rows of every layer per batch, side by side.

    ``layers`` maps a name to a table with the batch column. A table that is
    already aggregated names its row counts in column ``rows`` if it has one.
    """
    counted = []
    for name, df in layers.items():
        n = F.col(rows) if rows and rows in df.columns else F.lit(1)
        counted.append(df.select(F.col(batch), F.lit(name).alias("_layer"), n.cast("bigint").alias("_n")))
    stacked = reduce(DataFrame.unionByName, counted)
    return stacked.groupBy(batch).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("_layer") == name, F.col("_n"))), F.lit(0)).alias(f"{name}_rows")
            for name in layers
        ]
    )


def content_mark(df: DataFrame) -> str:
    """A text that stays the same while the rows do, in whatever order they come.

    Schema, row count and two independent 64-bit hashes of every row, summed
    without overflow. Everything is read; one row comes back, nothing is shuffled.
    """
    # a hash passes over nulls, so where they are is hashed beside the values
    values = [F.col(c) for c in df.columns]
    nulls = [F.col(c).isNull() for c in df.columns]
    sums = [exact_sum(F.xxhash64(F.lit(seed), *values, *nulls)) for seed in (1, 2)]
    counted = df.agg(F.count("*"), *sums).first()
    return "|".join([df.schema.simpleString(), *[str(v) for v in counted]])


def file_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """SHA-256 of every file below a folder, hashed where the file is read.

    Spark lists no empty files, so one that the manifest names counts as missing.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    )
    return files.select("path", F.sha2("content", 256).alias("content_hash"))


#: What the comparison of a file with the manifest can give.
OK, CHANGED, MISSING, STALE = "ok", "changed", "missing", "stale"


def reconcile_manifest(delivered: DataFrame, listed: DataFrame) -> DataFrame:
    """Each path of either side as ok, changed, missing (not delivered) or stale (not listed).

    Both sides are ``(path, content_hash)``. A path with several contents is changed.
    """
    sides = delivered.select(
        "path", F.col("content_hash").alias("have"), F.lit(None).cast("string").alias("want")
    ).unionByName(
        listed.select("path", F.lit(None).cast("string").alias("have"), F.col("content_hash").alias("want"))
    )
    lowest_have, highest_have, lowest_want, highest_want = (
        F.col(c) for c in ("_have_low", "_have_high", "_want_low", "_want_high")
    )
    state = (
        F.when(lowest_have.isNull(), MISSING)
        .when(lowest_want.isNull(), STALE)
        .when(
            (lowest_have == lowest_want)
            & (highest_have == highest_want)
            & (lowest_have == highest_have),
            OK,
        )
        .otherwise(CHANGED)
    )
    return (
        sides.groupBy("path")
        .agg(
            F.min("have").alias("_have_low"),
            F.max("have").alias("_have_high"),
            F.min("want").alias("_want_low"),
            F.max("want").alias("_want_high"),
        )
        .select("path", state.alias("state"))
    )


def count_by_prefix(df: DataFrame, path: str) -> DataFrame:
    """Files per first part of their path."""
    return df.groupBy(path_prefix(F.col(path)).alias("prefix")).agg(F.count("*").alias("n_files"))
