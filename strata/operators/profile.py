"""A first look at a feed, and profiles of past sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import exact_sum


def profile_feed(df: DataFrame, key: str, nullable: Sequence[str]) -> DataFrame:
    """Rows, rows with a key, distinct keys and missing values per column, in one row."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count(key).alias("rows_with_key"),
        F.count_distinct(key).alias("distinct_keys"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in nullable],
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def weekday_profile(events: DataFrame, day: str = "event_date") -> DataFrame:
    """Days, rows and least, mean and most rows of a day, per weekday (1 = Monday)."""
    per_day = events.groupBy(day).agg(F.count("*").alias("rows_of_day"))
    return (
        per_day.filter(F.col(day).isNotNull())
        .groupBy((F.weekday(day) + 1).cast("bigint").alias("weekday"))
        .agg(
            F.count("*").alias("n_days"),
            F.sum("rows_of_day").alias("n_rows"),
            F.min("rows_of_day").alias("least_rows"),
            F.max("rows_of_day").alias("most_rows"),
        )
        .withColumn("mean_rows", F.col("n_rows") / F.col("n_days"))
    )


def with_share(parts: DataFrame, measure: str, whole: DataFrame) -> DataFrame:
    """Share of each row of ``parts`` in the sum of ``measure`` over ``whole``.

    The sum is a scalar subquery: no window over all rows and no join. When
    ``whole`` is an aggregate that ``parts`` is made of, Spark runs it once.
    """
    total = whole.agg(exact_sum(F.col(measure)).cast("double")).scalar()
    share = F.col(measure).cast("double") / F.nullif(total, F.lit(0.0))
    return parts.withColumn("share", share)


def product_mix(events: DataFrame, products: DataFrame) -> DataFrame:
    """Amount and share per product, with its name.

    Events are summed per product before the join, so a product with very many
    events enters the join as one row.
    """
    per_product = events.groupBy("product_id").agg(F.sum("amount_cents").alias("amount_cents"))
    return with_share(per_product, "amount_cents", per_product).join(
        products.select("product_id", "product_name", "brand"), "product_id", "left"
    )


def territory_mix(events: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Amount and share per nation of the supplier; same order of steps."""
    per_supplier = events.groupBy("supplier_id").agg(F.sum("amount_cents").alias("amount_cents"))
    per_nation = (
        per_supplier.join(suppliers, "supplier_id", "left")
        .groupBy("region", "nation")
        .agg(F.sum("amount_cents").alias("amount_cents"))
    )
    return with_share(per_nation, "amount_cents", per_supplier)
