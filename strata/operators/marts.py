"""Daily metrics, rankings and the answers a dashboard asks for."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.fixed import PAID
from strata.functions import exact_sum, from_units, mean_from_units, to_units
from strata.functions.money import ORDER_DIGITS


def daily_revenue(orders: DataFrame, paid: str = PAID) -> DataFrame:
    """Paid valid orders by day and channel: orders, revenue, mean ticket.

    Clean orders hold an order once, so a plain count is the distinct count and
    one partial aggregation before the shuffle is enough.
    """
    units = F.col("units")
    return (
        orders.filter(F.col("is_valid") & (F.col("status_clean") == paid))
        .select(
            "order_date", "channel_clean", to_units(F.col("amount_value"), ORDER_DIGITS).alias("units")
        )
        .groupBy("order_date", "channel_clean")
        .agg(F.count("*").alias("paid_orders"), exact_sum(units).alias("units"))
        .select(
            "order_date",
            F.col("channel_clean").alias("channel"),
            "paid_orders",
            from_units(units, ORDER_DIGITS).alias("revenue"),
            mean_from_units(units, F.col("paid_orders"), ORDER_DIGITS).alias("mean_ticket"),
        )
    )


def daily_channel_rank(revenue: DataFrame) -> DataFrame:
    """Channels of a day by revenue; equal revenue shares a rank, ranks have no gaps.

    A window holds one aggregated row per channel of one day.
    """
    by_day = Window.partitionBy("order_date").orderBy(F.desc("revenue"))
    return revenue.withColumn("rank_in_day", F.dense_rank().over(by_day))


def amount_summary(
    rows: DataFrame, by: Mapping[str, str], amount: str = "amount_value", distinct: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows and total amount of each group, what is no money amount counting as 0.

    ``by`` maps result to group columns, ``distinct`` results to columns whose
    different values are counted.
    """
    units = F.coalesce(to_units(F.col(amount), ORDER_DIGITS), F.lit(0))
    counts = [F.count_distinct(column).alias(name) for name, column in (distinct or {}).items()]
    grouped = rows.groupBy(*[F.col(column).alias(name) for name, column in by.items()])
    summed = grouped.agg(F.count("*").alias("n_rows"), *counts, exact_sum(units).alias("units"))
    total = from_units(F.col("units"), ORDER_DIGITS).alias("observed_amount")
    return summed.select(*by, "n_rows", *(distinct or {}), total)
