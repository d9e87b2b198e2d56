"""Current state of dimensions, and facts widened with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_batch(extracts: DataFrame, batch: str = "source_batch_id") -> DataFrame:
    """Rows of the most recent full extract.

    What the last extract does not list is gone. The batch number is a scalar
    subquery: on a table partitioned by batch only that partition is read.
    """
    return extracts.filter(F.col(batch) == extracts.agg(F.max(batch)).scalar())


def conform_places(nations: DataFrame, regions: DataFrame) -> DataFrame:
    """Nation key with the names of nation and region."""
    return nations.select(
        F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("nation"), "n_regionkey"
    ).join(
        regions.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region")),
        "n_regionkey",
        "left",
    ).drop("n_regionkey")


def conform_customers(customers: DataFrame, places: DataFrame) -> DataFrame:
    return customers.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_key"),
    ).join(places, "nation_key", "left").drop("nation_key")


def conform_suppliers(suppliers: DataFrame, places: DataFrame) -> DataFrame:
    return suppliers.select(
        F.col("s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.col("s_nationkey").alias("nation_key"),
    ).join(places, "nation_key", "left").drop("nation_key")


def build_obt(
    events: DataFrame, sales: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """One wide row per clean event: sale, customer and product beside it.

    ``sales`` gives ``sale_id`` and ``customer_id``. Every join keeps all
    events; the dimensions have one row per key. Spark broadcasts a dimension
    that is small and splits hot keys on the event side of the others.

    Sales are many times fewer than events, so they meet their customers first:
    events are shuffled by product and by sale, and never by customer.
    """
    described = ["product_name", "brand", "category", "list_price"]
    buyers = sales.select("sale_id", "customer_id").join(customers, "customer_id", "left")
    wide = events.join(products.select("product_id", *described), "product_id", "left").join(buyers, "sale_id", "left")
    facts = [c for c in events.columns if c not in ("product_id", "sale_id")]
    people = [c for c in customers.columns if c != "customer_id"]
    return wide.select("product_id", "customer_id", "sale_id", *facts, *people, *described)
