"""Messy feeds made from the clean test tables.

Defects depend on a row's own values only, so the same feed comes out on any
number of machines and an SQL oracle can repeat it. Every source row takes part.
"""

from __future__ import annotations

import posixpath

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def every(key: Column, n: int) -> Column:
    return F.pmod(key, F.lit(n)) == 0


def order_feed(spark: SparkSession, sf_dir: str, with_country: bool = True) -> DataFrame:
    """The orders as an all-text feed with unreadable, missing and repeated values.

    The country needs a join with the customers. Catalyst cannot drop an outer
    join whose columns nobody reads, so callers that do not use the country
    leave it out and get a null column.
    """
    orders = table(spark, sf_dir, "orders")
    if with_country:
        nations = table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
        )
        homes = (
            table(spark, sf_dir, "customer")
            .select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
            .join(nations, "c_nationkey", "left")
            .drop("c_nationkey")
        )
        orders = orders.join(homes, "o_custkey", "left")
    else:
        orders = orders.withColumn("country", F.lit(None).cast("string"))

    key = F.col("o_orderkey")
    status = F.element_at(
        F.create_map(*[F.lit(x) for x in ("O", "created", "F", "paid", "P", "cancelled")]),
        F.col("o_orderstatus"),
    )
    status = F.when(every(key, 110), F.lit(None)).when(every(key, 90), "returned").otherwise(status)

    def noisy(text: Column) -> Column:
        text = F.when(every(key, 3), F.upper(text)).otherwise(text)
        return F.when(every(key, 7), F.concat(F.lit("  "), text, F.lit(" "))).otherwise(text)

    copies = F.when(every(key, 20), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    placed = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=F.col("copy"))
    order_ts = (
        F.when(every(key, 70), F.lit(None))
        .when(every(key, 130), "not a time")
        .otherwise(F.date_format(placed, TIME_TEXT))
    )
    amount = F.when(every(key, 50), "n/a").otherwise(
        (F.col("o_totalprice") + F.col("copy")).cast("string")
    )
    return orders.withColumn("copy", F.explode(copies)).select(
        key.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        order_ts.alias("order_ts"),
        noisy(F.lower("o_orderpriority")).alias("channel"),
        amount.alias("amount"),
        noisy(status).alias("status"),
        noisy(F.lower("country")).alias("country"),
    )


def sales_event_feed(lines: DataFrame) -> DataFrame:
    """Order lines as a ledger of sale, adjustment and cancel events.

    An event is one line of one sale; the tables hold many lines several times
    with other contents, which is what event deduplication has to settle.
    """
    kinds = F.create_map(*[F.lit(x) for x in ("N", "sale", "A", "adjustment", "R", "cancel")])
    return lines.select(
        F.col("l_orderkey").alias("sale_id"),
        F.col("l_linenumber").alias("line_no"),
        F.element_at(kinds, F.col("l_returnflag")).alias("event_type"),
        F.to_date("l_shipdate").alias("event_date"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"),
        F.year("l_shipdate").alias("source_batch_id"),
    )


def product_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two full product extracts: the second lists new products and lacks retired ones."""
    batches = (
        F.when(F.col("p_size") <= 5, F.array(F.lit(2)))
        .when(F.col("p_size") == 50, F.array(F.lit(1)))
        .otherwise(F.array(F.lit(1), F.lit(2)))
    )
    old_price = F.when(F.col("source_batch_id") == 1, 10.0).otherwise(0.0)
    return (
        table(spark, sf_dir, "part")
        .withColumn("source_batch_id", F.explode(batches))
        .select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("category"),
            (F.col("p_retailprice") - old_price).alias("list_price"),
            "source_batch_id",
        )
    )


def account_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts to merge changes into."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account_id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )


def account_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change per customer and three per supplier.

    Customers give updates, deletes and inserts of keys that exist. Suppliers,
    under negative keys that no customer has, give inserts of new keys and,
    under still other keys, updates and deletes of keys that do not exist.
    """
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account_id"),
        F.col("c_name").alias("name"),
        (F.col("c_acctbal") + 1).alias("balance"),
        F.when(F.col("c_acctbal") < 0, "delete")
        .when(F.col("c_mktsegment") == "BUILDING", "insert")
        .otherwise("update")
        .alias("change_type"),
    )
    kinds = F.array(*[F.lit(x) for x in ("insert", "update", "delete")])
    suppliers = (
        table(spark, sf_dir, "supplier")
        .select("*", F.posexplode(kinds).alias("kind_no", "change_type"))
        .select(
            (-1 - (F.col("s_suppkey") * 3 + F.col("kind_no"))).alias("account_id"),
            F.col("s_name").alias("name"),
            F.col("s_acctbal").alias("balance"),
            "change_type",
        )
    )
    return customers.unionByName(suppliers)


def account_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the accounts in four deliveries that depend on their order.

    1 updates one market segment, 2 deletes overdrawn accounts, 3 inserts the
    suppliers and one market segment (which brings deleted accounts back),
    4 updates the inserted suppliers and the overdrawn accounts.
    """
    customers = table(spark, sf_dir, "customer")
    overdrawn = F.col("c_acctbal") < 0
    delivery = F.array_compact(
        F.array(
            F.when(F.col("c_mktsegment") == "BUILDING", 1),
            F.when(overdrawn, 2),
            F.when(F.col("c_mktsegment") == "AUTOMOBILE", 3),
            F.when(overdrawn, 4),
        )
    )
    kinds = F.create_map(
        *[F.lit(x) for pair in ((1, "update"), (2, "delete"), (3, "insert"), (4, "update")) for x in pair]
    )
    raised = F.create_map(
        *[F.lit(x) for pair in ((1, 1.0), (2, 0.0), (3, 0.0), (4, 5.0)) for x in pair]
    )
    from_customers = (
        customers.select("*", F.explode(delivery).alias("source_batch_id")).select(
            F.col("c_custkey").alias("account_id"),
            F.col("c_name").alias("name"),
            (F.col("c_acctbal") + raised[F.col("source_batch_id")]).alias("balance"),
            kinds[F.col("source_batch_id")].alias("change_type"),
            "source_batch_id",
        )
    )
    from_suppliers = (
        table(spark, sf_dir, "supplier")
        .select("*", F.explode(F.array(F.lit(3), F.lit(4))).alias("source_batch_id"))
        .select(
            (-1 - F.col("s_suppkey")).alias("account_id"),
            F.col("s_name").alias("name"),
            (F.col("s_acctbal") + raised[F.col("source_batch_id")]).alias("balance"),
            kinds[F.col("source_batch_id")].alias("change_type"),
            "source_batch_id",
        )
    )
    return from_customers.unionByName(from_suppliers)


def land_pages(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Pages delivered as files below ``folder``, and the manifest they should match, as ``(path, content_hash)``.

    Of the page ids those divisible by 7 are listed but not delivered, by 11
    delivered but not listed, by 13 listed with other contents; those divisible
    by 5 are empty.
    """
    page = F.col("page_id")
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat(F.pmod(page, F.lit(10)).cast("string"), F.lit("/"), page.cast("string"), F.lit(".html")).alias("path"),
        F.when(every(page, 5), "").otherwise(F.coalesce("html", F.lit(""))).alias("text"),
    )

    def land(frames):
        store, base = fs.FileSystem.from_uri(folder if ":/" in folder else f"file://{folder}")
        n = 0
        for frame in frames:
            for path, text in zip(frame["path"], frame["text"]):
                store.create_dir(posixpath.dirname(f"{base}/{path}"))
                with store.open_output_stream(f"{base}/{path}") as file:  # a task that comes again writes the same
                    file.write(text.encode())
                n += 1
        yield pd.DataFrame({"n": [n]})

    pages.filter(~every(page, 7)).select("path", "text").mapInPandas(land, "n long").agg(F.sum("n")).collect()
    listed = F.when(every(page, 13), F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    return pages.filter(~every(page, 11)).select("path", F.sha2(listed, 256).alias("content_hash"))


def page_manifest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Delivered pages and the manifest they should match, as ``(path, content_hash)``.

    Spanish pages are listed but not delivered, German ones delivered but not
    listed, and pages with a fragment in the address were listed with other contents.
    """
    pages = table(spark, sf_dir, "pages")
    language = F.split_part("url", F.lit("/"), F.lit(4))
    delivered = pages.filter(language != "es").select(
        F.col("url").alias("path"), F.sha2("html", 256).alias("content_hash")
    )
    listed_text = F.when(
        F.col("url").contains("#"), F.concat(F.col("html"), F.lit("!"))
    ).otherwise(F.col("html"))
    listed = pages.filter(language != "de").select(
        F.col("url").alias("path"), F.sha2(listed_text, 256).alias("content_hash")
    )
    return delivered, listed
