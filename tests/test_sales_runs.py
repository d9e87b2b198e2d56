"""Runs of the whole sales flow remake what something changed, and the wide join never shuffles events by customer."""

import re

from pyspark.sql import functions as F

from strata.operators.dimensions import build_obt
from strata.operators.reconcile import content_mark
from strata.plans.sales import PRODUCT_SCHEMA, run_sales_pipeline
from strata.plans.sales_incremental import run_sales_incremental
from strata.session import scratch_path
from strata.sources.files import land_csv
from strata.streaming.ingest import BATCH
from strata.streaming.ledger import EVENT_FEED_SCHEMA


def test_only_layers_of_which_something_changed_are_remade(spark):
    root = scratch_path(spark, "runs")
    sales = spark.createDataFrame([(n, n % 2) for n in range(6)], "sale_id BIGINT, customer_id BIGINT")

    def land(batch, rows):
        land_csv(spark.createDataFrame(rows, EVENT_FEED_SCHEMA), f"{root}/feed/{BATCH}={batch}", mode="append", compression="gzip")

    def run(name="Ann"):
        customers = spark.createDataFrame([(0, name), (1, None)], "customer_id BIGINT, customer_name STRING")
        return run_sales_pipeline(spark, f"{root}/feed", f"{root}/extracts", sales, customers, f"{root}/layers")

    def files(layers):
        return [sorted(df.inputFiles()) for df in (layers.silver, layers.wide, layers.daily)]

    def names(layers):
        return {r["sales_event_id"]: (r["customer_name"], r["product_name"]) for r in layers.wide.collect()}

    products = spark.createDataFrame([("7", "p", "b", "c", "1.5")], PRODUCT_SCHEMA)
    land_csv(products, f"{root}/extracts/{BATCH}=1", compression="gzip")
    land(1, [(str(s), "1", "sale", "2024-01-01", "7", "1", "2.0", "10.0") for s in range(3)])
    first = run()
    assert names(first) == {"0-1": ("Ann", "p"), "1-1": (None, "p"), "2-1": ("Ann", "p")}
    assert files(run()) == files(first)

    # another customer's name: the events stay as they were
    renamed = run("Zoe")
    assert files(renamed)[0] == files(first)[0]
    assert files(renamed)[1] != files(first)[1]
    assert names(renamed)["2-1"] == ("Zoe", "p")

    land(2, [("4", "1", "sale", "2024-01-02", "8", "1", "2.0", "10.0")])
    more = run("Zoe")
    assert names(more) == names(renamed) | {"4-1": ("Zoe", None)}
    assert more.daily.count() == 2
    assert files(run("Zoe")) == files(more)

    land_csv(products.withColumn("product_name", F.lit("new")), f"{root}/extracts/{BATCH}=2")
    assert names(run("Zoe"))["2-1"] == ("Zoe", "new")


def test_a_mark_tells_rows_apart_and_not_their_order(spark):
    schema = "a BIGINT, b BIGINT"
    rows = [(1, None), (2, 3), (2, 3)]
    mark = content_mark(spark.createDataFrame(rows, schema))
    assert content_mark(spark.createDataFrame(rows[::-1], schema).repartition(3)) == mark
    others = [[(None, 1), (2, 3), (2, 3)], [(1, None), (2, 3)], [(1, None), (3, 2), (2, 3)], []]
    assert mark not in [content_mark(spark.createDataFrame(o, schema)) for o in others]


def test_events_are_shuffled_by_product_and_sale_only(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = spark.range(1000).select((F.col("id") % 100).alias("sale_id"), (F.col("id") % 10).alias("product_id"), F.lit("x").alias("kind"))
        sales = spark.range(100).select(F.col("id").alias("sale_id"), (F.col("id") % 5).alias("customer_id"))
        customers = spark.range(5).select(F.col("id").alias("customer_id"), F.lit("n").alias("customer_name"))
        products = spark.range(10).select(F.col("id").alias("product_id"), *[F.lit("p").alias(c) for c in ("product_name", "brand", "category", "list_price")])
        wide = build_obt(events, sales, customers, products)
        assert wide.columns[:4] == ["product_id", "customer_id", "sale_id", "kind"]
        joins = re.findall(r"SortMergeJoin \[(\w+)#", wide._jdf.queryExecution().executedPlan().toString())
        assert joins == ["sale_id", "product_id", "customer_id"], "the sales' own join lies below that with the events"
        assert wide.filter("customer_name = 'n' and product_name = 'p'").count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_second_delivery_does_not_widen_the_first_again(spark):
    root = scratch_path(spark, "increments")
    sales = spark.createDataFrame([(n, 0) for n in range(6)], "sale_id BIGINT, customer_id BIGINT")
    customers = spark.createDataFrame([(0, "Ann", "s", "n", "r")], "customer_id BIGINT, customer_name STRING, segment STRING, nation STRING, region STRING")

    def run(batch, rows):
        land_csv(spark.createDataFrame(rows, EVENT_FEED_SCHEMA), f"{root}/feed/{BATCH}={batch}", mode="append", compression="gzip")
        return run_sales_incremental(spark, f"{root}/feed", f"{root}/extracts", sales, customers, f"{root}/logs", buckets=2)

    def event(sale, day):
        return (str(sale), "1", "sale", day, "7", "1", "2.0", "10.0")

    land_csv(spark.createDataFrame([("7", "p", "b", "c", "1.5")], PRODUCT_SCHEMA), f"{root}/extracts/{BATCH}=1", compression="gzip")
    logs = run(1, [event(s, "2024-01-02") for s in range(3)])
    assert "Window" not in logs.silver.current()._jdf.queryExecution().executedPlan().toString(), "one step replaces nothing"
    # the same event again and an older version change nothing, a newer one and a new event do
    logs = run(1, [event(0, "2024-01-02"), event(1, "2024-01-01"), event(2, "2024-01-03"), event(5, "2024-01-01")])
    assert [logs.silver.rows_at(s).count() for s in logs.silver.steps()] == [3, 2]
    assert [logs.wide.rows_at(s).count() for s in logs.wide.steps()] == [0, 3, 2]
    days = {r["sales_event_id"]: (r["event_date"].isoformat(), r["customer_name"], r["product_name"]) for r in logs.wide_rows().collect()}
    assert days == {f"{s}-1": (d, "Ann", "p") for s, d in ((0, "2024-01-02"), (1, "2024-01-02"), (2, "2024-01-03"), (5, "2024-01-01"))}


def test_a_run_of_the_incremental_flow_leaves_no_shuffles(spark):
    root = scratch_path(spark, "increments")
    sales = spark.createDataFrame([(n, 0) for n in range(6)], "sale_id BIGINT, customer_id BIGINT")
    customers = spark.createDataFrame([(0, "Ann", "s", "n", "r")], "customer_id BIGINT, customer_name STRING, segment STRING, nation STRING, region STRING")
    land_csv(spark.createDataFrame([("7", "p", "b", "c", "1.5")], PRODUCT_SCHEMA), f"{root}/extracts/{BATCH}=1", compression="gzip")
    held = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    for day in ("2024-01-02", "2024-01-03"):
        events = spark.createDataFrame([(str(s), "1", "sale", day, "7", "1", "2.0", "10.0") for s in range(3)], EVENT_FEED_SCHEMA)
        land_csv(events, f"{root}/feed/{BATCH}={day[-1]}", compression="gzip")
        before = held.size()
        logs = run_sales_incremental(spark, f"{root}/feed", f"{root}/extracts", sales, customers, f"{root}/logs", buckets=2)
        assert held.size() <= before
    assert {r["event_date"].day for r in logs.wide_rows().collect()} == {3}
