"""A hot key: plans that do not gather it, and results that stay whole."""

import pytest
from pyspark.sql import functions as F

from strata.operators import dimensions, ledger, merge, refine

HOT = 3  # a third of all rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot_events(spark):
    n = F.col("id")
    return spark.range(0, 30_000, 1, 8).select(
        F.when(n % HOT == 0, 0).otherwise(n).alias("sale_id"),
        F.when(n % HOT == 0, 1).otherwise(F.lit(2)).cast("int").alias("line_no"),
        F.lit("sale").alias("event_type"),
        F.date_add(F.lit("2025-01-01").cast("date"), (n % 300).cast("int")).alias("event_date"),
        F.when(n % HOT == 1, 1).otherwise(n % 1000).alias("product_id"),
        (n % 7).alias("supplier_id"),
        F.lit(1.0).alias("quantity"),
        (n % 100).cast("double").alias("amount"),
        F.lit(1).alias("source_batch_id"),
    )


def test_dedup_cuts_copies_before_the_shuffle(hot_events):
    clean = refine.refine_events(hot_events)
    plan = _plan(clean)
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:], "no cut below the shuffle"
    assert clean.count() == 20_001
    assert clean.filter("sale_id = 0").first()["event_date"].isoformat() == "2025-10-25"


def _shuffled_rows(df):
    """Rows written to each shuffle of the finished plan."""
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().get("shuffleRecordsWritten").get().value())
        if name == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            walk(node.plan())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    df.collect()
    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_hot_copies_are_not_shuffled(hot_events):
    rows = _shuffled_rows(refine.refine_events(hot_events))
    # 20,000 single events and at most one copy of the hot one per task
    assert rows == [20_000 + 8]


def test_hot_sale_is_summed_before_the_shuffle(spark, hot_events):
    one_sale = refine.normalise_events(hot_events).withColumn("sale_id", F.lit(1).cast("bigint"))
    rows = _shuffled_rows(ledger.net_ledger(one_sale))
    assert rows == [8]


def test_hot_product_is_split_in_the_wide_join(spark, hot_events):
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    try:
        events = refine.normalise_events(hot_events)
        products = spark.range(1000).select(
            F.col("id").alias("product_id"),
            F.lit("p").alias("product_name"),
            F.lit("b").alias("brand"),
            F.lit("c").alias("category"),
            F.lit(1.0).alias("list_price"),
        )
        sales = spark.range(30_000).select(F.col("id").alias("sale_id"), F.col("id").alias("customer_id"))
        customers = spark.range(30_000).select(F.col("id").alias("customer_id"), F.lit("n").alias("customer_name"))
        wide = dimensions.build_obt(events, sales, customers, products)
        assert len(wide.collect()) == 30_000
        assert "skew=true" in _plan(wide)
    finally:
        for key in (
            "spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        ):
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_merge_never_joins_full_outer(spark):
    target = spark.range(1000).select(F.col("id"), F.lit("x").alias("v"))
    changes = spark.range(10).select(F.col("id"), F.lit("y").alias("v"), F.lit("update").alias("change_type"))
    merged = merge.merge_changes(target, changes, ["id"])
    plan = _plan(merged)
    assert "FullOuter" not in plan
    assert merged.filter("v = 'y'").count() == 10


def test_hot_target_key_is_split_in_a_large_merge(spark):
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        # as in a session that was not built by this library
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = F.col("id")
        target = spark.range(0, 60_000, 1, 8).select(
            F.when(n % HOT == 0, 0).otherwise(n).alias("k"), F.xxhash64(n).alias("v")
        )
        # a changed partitioning, as files have it: a range would need no shuffle to be grouped
        changes = spark.range(0, 70_000, 7, 8).repartition(4, n % 5).select(
            n.alias("k"),
            F.lit(1).cast("bigint").alias("v"),
            F.when(n % 2 == 0, "insert").otherwise("update").alias("change_type"),
        )
        tagged = merge.tag_changes(target, changes, ["k"])
        counts = {r["action"]: r["n_rows"] for r in merge.merge_metrics(tagged).collect()}
        rows = tagged.collect()
        plan = _plan(tagged)
        outer = next(line for line in plan.split("Initial Plan")[0].splitlines() if "LeftOuter" in line)
        assert "skew=true" in outer, "the join with the updates splits the hot key"
        # Equal keys alone compress to next to nothing, so this small table does not
        # look skewed to the join with the inserts. It could be split all the same,
        # because the aggregate behind it has a shuffle of its own.
        semi = plan.index("LeftSemi")
        assert "Exchange hashpartitioning(_groupingexpression" in plan[:semi]
        updated = sum(1 for k in range(0, 60_000) if k % HOT and k % 7 == 0 and k % 2)
        # even keys of the changes are inserts: new beyond the target, and where the hot rows took the key
        taken = {0} | {k for k in range(60_000) if k % HOT}
        inserted = sum(1 for k in range(0, 70_000, 7) if k % 2 == 0 and k not in taken)
        assert counts == {"kept": 60_000 - updated, "updated": updated, "deleted": 0, "inserted": inserted}
        assert len(rows) == 60_000 + inserted
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
