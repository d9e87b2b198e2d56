"""Sales ledger: sales, their adjustments and their cancellations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.fixed import ADJUSTMENT, CANCEL, SALE
from strata.functions import exact_sum, from_units


def _is(kind: str) -> Column:
    return F.col("event_type") == kind


def batch_event_counts(events: DataFrame) -> DataFrame:
    """Sale, adjustment and cancel rows per batch."""
    return events.groupBy("source_batch_id").agg(
        F.count_if(_is(SALE)).alias("sale_rows"),
        F.count_if(_is(ADJUSTMENT)).alias("adjustment_rows"),
        F.count_if(_is(CANCEL)).alias("cancel_rows"),
    )


def net_ledger(events: DataFrame) -> DataFrame:
    """Net value of each sale: 0 once cancelled, else sales plus adjustments with their sign."""
    cents = F.col("amount_cents")
    return (
        events.groupBy("sale_id")
        .agg(
            F.count("*").alias("n_events"),
            F.coalesce(F.sum(F.when(_is(SALE), cents)), F.lit(0)).alias("sale_cents"),
            F.coalesce(F.sum(F.when(_is(ADJUSTMENT), cents)), F.lit(0)).alias("adjustment_cents"),
            F.count_if(_is(ADJUSTMENT)).alias("adjustment_rows"),
            F.count_if(_is(CANCEL)).alias("cancel_rows"),
        )
        .withColumn(
            "net_cents",
            F.when(F.col("cancel_rows") > 0, F.lit(0)).otherwise(
                F.col("sale_cents") + F.col("adjustment_cents")
            ),
        )
    )


def daily_sales(events: DataFrame, by: Sequence[str] = ("event_date",)) -> DataFrame:
    """Events, sold quantity and amounts by day, or by the batch they came with and day."""
    cents = F.col("amount_cents")
    return (
        events.groupBy(*by)
        .agg(
            F.count_if(_is(SALE)).alias("sale_rows"),
            F.count_if(_is(ADJUSTMENT)).alias("adjustment_rows"),
            F.count_if(_is(CANCEL)).alias("cancel_rows"),
            F.coalesce(F.sum(F.when(_is(SALE), F.col("quantity").cast("bigint"))), F.lit(0)).alias("sold_quantity"),
            F.coalesce(F.sum(F.when(_is(SALE), cents)), F.lit(0)).alias("_sale"),
            F.coalesce(F.sum(F.when(_is(ADJUSTMENT), cents)), F.lit(0)).alias("_adjustment"),
        )
        .withColumns(
            {
                "sale_amount": from_units(F.col("_sale")),
                "adjustment_amount": from_units(F.col("_adjustment")),
            }
        )
        .drop("_sale", "_adjustment")
    )


#: Upper ends, in days, of the delay groups; later ones form the last group.
DELAY_GROUPS = ((0, "same day"), (7, "1-7 days"), (30, "8-30 days"), (90, "31-90 days"))
LATER, NEVER = "over 90 days", "not corrected"


def correction_delays(events: DataFrame) -> DataFrame:
    """Days from the first sale event to the first correction on or after it, per sale.

    A sale is first cut to its days, with partial aggregation before the
    shuffle; the window then holds one row per day of a sale, however many
    events the sale has.
    """
    days = events.groupBy("sale_id", "event_date").agg(
        F.bool_or(_is(SALE)).alias("sold"),
        F.bool_or(_is(ADJUSTMENT) | _is(CANCEL)).alias("corrected"),
    )
    first_sale = F.min(F.when(F.col("sold"), F.col("event_date"))).over(Window.partitionBy("sale_id"))
    correction = F.when(
        F.col("corrected") & (F.col("event_date") >= F.col("first_sale")), F.col("event_date")
    )
    return (
        days.withColumn("first_sale", first_sale)
        .filter(F.col("first_sale").isNotNull())
        .groupBy("sale_id", "first_sale")
        .agg(F.min(correction).alias("first_correction"))
        .withColumn("delay_days", F.datediff("first_correction", "first_sale"))
    )


def correction_latency(events: DataFrame) -> DataFrame:
    """Sales, and days waited in all, by delay of their first correction."""
    delay = F.col("delay_days")
    group = F.when(delay.isNull(), NEVER)
    for days, name in DELAY_GROUPS:
        group = group.when(delay <= days, name)
    return (
        correction_delays(events)
        .groupBy(group.otherwise(LATER).alias("delay_group"))
        .agg(
            F.count("*").alias("n_sales"),
            F.coalesce(F.sum(delay), F.lit(0)).alias("total_days"),
        )
    )


def top_products(events: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` products with the highest sale amount; the smaller id wins a tie.

    Only the ``k`` winners are joined with their names.
    """
    best = (
        events.filter(_is(SALE))
        .groupBy("product_id")
        .agg(F.count("*").alias("sale_rows"), F.sum("amount_cents").alias("cents"))
        .orderBy(F.desc("cents"), F.asc("product_id"))
        .limit(k)
    )
    return best.join(products.select("product_id", "product_name"), "product_id", "left").select(
        "product_id", "product_name", "sale_rows", from_units(F.col("cents")).alias("sale_amount")
    )


def kpi_summary(events: DataFrame, products: DataFrame) -> DataFrame:
    """Headline figures as ``(metric, value, label)`` rows.

    The figures come from one pass over the net ledger; the best product adds
    one row.
    """

    def total(column: str) -> Column:
        return exact_sum(F.col(column)).cast("double") / F.lit(100.0)

    def rate(condition: Column) -> Column:
        return F.count_if(condition) / F.nullif(F.count("*"), F.lit(0))

    figures = net_ledger(events).agg(
        F.count("*").cast("double").alias("sales"),
        total("sale_cents").alias("gross_sales"),
        total("net_cents").alias("net_revenue"),
        rate(F.col("adjustment_rows") > 0).alias("correction_rate"),
        rate(F.col("cancel_rows") > 0).alias("cancel_rate"),
    )
    names = ("sales", "gross_sales", "net_revenue", "correction_rate", "cancel_rate")
    rows = figures.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names]))
    ).withColumn("label", F.lit(None).cast("string"))
    best = top_products(events, products, 1).select(
        F.lit("best_product").alias("metric"),
        F.col("sale_amount").alias("value"),
        F.col("product_name").alias("label"),
    )
    return rows.unionByName(best)
