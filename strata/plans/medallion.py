"""The whole flow from a landed order feed to published daily revenue."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strata.operators.marts import daily_revenue
from strata.operators.reconcile import assert_layers
from strata.operators.refine import refine_orders
from strata.fixed import ORDER_FEED_SCHEMA
from strata.sources.files import read_feed, stamp_lineage
from strata.sources.tables import publish, scan


@dataclass(frozen=True)
class Layers:
    """Names of the published tables."""

    bronze: str
    silver: str
    gold: str

    def frames(self, spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
        return scan(spark, self.bronze), scan(spark, self.silver), scan(spark, self.gold)


def run_medallion(
    spark: SparkSession, feed: str, root: str, names: Layers, system: str = "orders"
) -> Layers:
    """Ingest, refine, publish and check, in this order.

    Each layer is a published table that the next one reads, so that a run that
    broke can go on from the last table. ``root`` holds the files of the tables.
    """
    rows = read_feed(spark, feed, ORDER_FEED_SCHEMA)
    publish(stamp_lineage(rows, system), names.bronze, "Orders as they came", f"{root}/bronze")
    publish(
        refine_orders(scan(spark, names.bronze)), names.silver, "Clean orders", f"{root}/silver"
    )
    publish(
        daily_revenue(scan(spark, names.silver)), names.gold, "Daily revenue by channel", f"{root}/gold"
    )
    assert_layers(*names.frames(spark))
    return names
