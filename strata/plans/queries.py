"""The registered queries: each takes the session and a folder of test tables.

Every query reads whole tables. Queries that write do so in a fresh folder below
the shared checkpoint folder and return a read of what they wrote.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixed
from strata.functions import safe_identifier
from strata.operators import (
    bucketed,
    dimensions,
    expectations,
    ledger,
    marts,
    merge,
    ordering,
    profile,
    reconcile,
    refine,
    rescue,
)
from strata.operators.expectations import Rule
from strata.plans.medallion import Layers, run_medallion
from strata.plans.oracles import ALL_TABLES
from strata.plans.sales import SalesLayers, run_sales_pipeline
from strata.plans.sales_incremental import SalesLogs, run_sales_incremental
from strata.session import scratch_path
from strata.sources import feeds, files, folder, loads, tables
from strata.sources.feeds import table
from strata.sources.versions import KeyedLog, SteppedTable
from strata.streaming import admission, changes, ingest, seen
from strata.streaming import expectations as stream_rules
from strata.streaming import ledger as stream_ledgers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SYSTEM = "shop"
#: Folders of a keyed table; a table keeps the number it was made with.
BUCKETS = 8


def query(function: Query) -> Query:
    """Register a query under the name of its function."""
    QUERIES[function.__name__] = function
    return function


def _unique(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


def _as_text(df: DataFrame, *keep: str) -> DataFrame:
    """All columns as text, as a landed file holds them; ``keep`` stays as it is."""
    return df.select([F.col(c) if c in keep else F.col(c).cast("string").alias(c) for c in df.columns])


def _plain_time(column: str) -> Column:
    """Wall-clock time, comparable across engines."""
    return F.col(column).cast("timestamp_ntz").alias(column)


# ---- orders ---------------------------------------------------------------------------


def _orders(spark: SparkSession, sf_dir: str, with_country: bool = False) -> DataFrame:
    return refine.refine_orders(feeds.order_feed(spark, sf_dir, with_country))


@query
def feed_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = feeds.order_feed(spark, sf_dir, with_country=False)
    return profile.profile_feed(feed, "order_id", ["order_ts", "amount", "status"])


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = files.stamp_lineage(table(spark, sf_dir, "orders"), SYSTEM, batch=1)
    return stamped.select(
        "o_orderkey",
        F.element_at(F.split("_source_file", "/"), -1).alias("source_file"),
        F.col("_source_system").alias("source_system"),
        "source_batch_id",
        F.col("_ingested_at").isNotNull().alias("has_time"),
    )


@query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    folder = scratch_path(spark, "parts")
    files.land_csv(parts, folder, rows_per_file=1_000_000)
    return files.read_feed(spark, folder, parts.schema)


@query
def csv_hostile_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line ends, quotes and backslashes, landed and read back."""
    ends = [F.lit(x) for x in ("\nb", "\r", '","', "\\", "\r\n ", "")]
    docs = table(spark, sf_dir, "documents").filter(F.col("text") != "")
    docs = docs.select("doc_id", F.concat("text", F.element_at(F.array(*ends), (F.pmod("doc_id", F.lit(6)) + 1).cast("int"))).alias("text"))
    folder = scratch_path(spark, "texts")
    files.land_csv(docs, folder, rows_per_file=100_000, marked_ends=True)
    return files.read_feed(spark, folder, docs.schema, marked_ends=True)


@query
def ragged_feed_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with too few and too many values are kept and rescued."""
    key = F.col("p_partkey")
    line = F.concat_ws(
        ",", key, F.when(key % 10 != 0, F.col("p_size")), F.when((key % 15 == 0) & (key % 10 != 0), "more")
    )
    folder = scratch_path(spark, "ragged")
    lines = table(spark, sf_dir, "part").select(line.alias("value"))
    lines.write.text(folder)
    feed = files.read_feed(spark, folder, "part_key STRING, size STRING", ragged=True, header=False)
    parsed = rescue.typed_parse(feed, {"part_key": "bigint", "size": "int"})
    return parsed.withColumnRenamed(rescue.RESCUED, "rescued_data")


@query
def publish_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _unique("customers")
    tables.publish(
        table(spark, sf_dir, "customer"), name, "Customers", scratch_path(spark, "customers")
    )
    return tables.scan(spark, name)


@query
def typed_parse_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = feeds.order_feed(spark, sf_dir, with_country=False)
    parsed = rescue.typed_parse(feed, {"order_ts": "timestamp", "amount": "double"})
    return parsed.select(
        "order_id", _plain_time("order_ts"), "amount", F.col(rescue.RESCUED).alias("rescued_data")
    )


@query
def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, with_country=True)
    return orders.withColumn("order_time", _plain_time("order_time"))


@query
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.amount_summary(
        _orders(spark, sf_dir), {"is_valid": "is_valid"}, distinct={"distinct_orders": "order_id"}
    )


@query
def invalid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = refine.quarantine(_orders(spark, sf_dir, with_country=True))
    return rows.withColumn("order_time", _plain_time("order_time"))


def order_rules() -> list[Rule]:
    return [
        Rule("has_order_id", "order_id IS NOT NULL", "fail"),
        Rule("readable_amount", "amount_value IS NOT NULL", "drop"),
        Rule("readable_time", "order_time IS NOT NULL", "drop"),
        Rule("known_status", F.col("status_clean").isin(*fixed.ORDER_STATUSES), "warn"),
        Rule("large_order", "amount_value < 400000", "warn"),
    ]


@query
def expectations_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = refine.standardise(feeds.order_feed(spark, sf_dir, with_country=False))
    return expectations.expectations_report(feed, order_rules())


@query
def expectations_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = refine.standardise(feeds.order_feed(spark, sf_dir, with_country=False))
    rules = order_rules()
    kept = expectations.drop_failing(expectations.stop_on_failing(feed, rules), rules)
    return kept.select("order_id", _plain_time("order_time"), "amount_value", "status_clean")


@query
def gold_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_revenue(_orders(spark, sf_dir))


@query
def daily_channel_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_channel_rank(marts.daily_revenue(_orders(spark, sf_dir)))


@query
def ordered_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily revenue in the order of a report, the place as a column."""
    gold = marts.daily_revenue(_orders(spark, sf_dir))
    return ordering.with_positions(gold, [F.col("order_date").asc_nulls_last(), F.col("revenue").desc_nulls_last(), F.col("channel").asc_nulls_last()])


@query
def consumer_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _unique("daily_revenue")
    tables.publish(
        marts.daily_revenue(_orders(spark, sf_dir)), gold, path=scratch_path(spark, "daily_revenue")
    )
    columns = ["order_date", "channel", "paid_orders", "revenue", "mean_ticket"]
    return tables.consumer_view(spark, _unique("v_daily_revenue"), gold, columns, "revenue > 100000")


@query
def status_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = {"country": "country", "status": "status_clean"}
    return marts.amount_summary(_orders(spark, sf_dir, with_country=True), by)


@query
def layer_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks read layers that were written, as in a real run."""
    root = scratch_path(spark, "checks")
    feeds.order_feed(spark, sf_dir, with_country=False).write.parquet(f"{root}/bronze")
    bronze = spark.read.parquet(f"{root}/bronze")
    refine.refine_orders(bronze).write.parquet(f"{root}/silver")
    silver = spark.read.parquet(f"{root}/silver")
    return reconcile.layer_checks(bronze, silver, marts.daily_revenue(silver))


@query
def medallion_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole flow: landed CSV feed to published Gold, with its checks."""
    root = scratch_path(spark, "medallion")
    files.land_csv(feeds.order_feed(spark, sf_dir), f"{root}/feed", rows_per_file=1_000_000)
    names = Layers(_unique("bronze"), _unique("silver"), _unique("gold"))
    run_medallion(spark, f"{root}/feed", root, names, SYSTEM)
    return tables.scan(spark, names.gold)


# ---- sales events ---------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine.refine_events(feeds.sales_event_feed(table(spark, sf_dir, "lineitem")))


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.latest_batch(feeds.product_extracts(spark, sf_dir))


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.conform_places(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))


@query
def silver_sales_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir)


@query
def dim_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _products(spark, sf_dir)


@query
def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.conform_customers(table(spark, sf_dir, "customer"), _places(spark, sf_dir))


@query
def obt_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("sale_id"), F.col("o_custkey").alias("customer_id")
    )
    return dimensions.build_obt(
        _events(spark, sf_dir), sales, dim_customer(spark, sf_dir), _products(spark, sf_dir)
    )


@query
def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.daily_sales(_events(spark, sf_dir))


@query
def batch_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of what arrived, so before deduplication."""
    feed = refine.normalise_events(feeds.sales_event_feed(table(spark, sf_dir, "lineitem")))
    return ledger.batch_event_counts(feed)


@query
def sales_net_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.net_ledger(_events(spark, sf_dir))


@query
def correction_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.correction_latency(_events(spark, sf_dir))


@query
def weekday_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return profile.weekday_profile(sales.select(F.to_date("ts").alias("event_date")))


def _past_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as they stand after all corrections: an event counts once, however often it came."""
    return _events(spark, sf_dir).filter(F.col("event_type") == fixed.SALE)


@query
def product_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.product_mix(_past_sales(spark, sf_dir), _products(spark, sf_dir))


@query
def territory_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = dimensions.conform_suppliers(table(spark, sf_dir, "supplier"), _places(spark, sf_dir))
    return profile.territory_mix(_past_sales(spark, sf_dir), suppliers)


@query
def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.top_products(_events(spark, sf_dir), _products(spark, sf_dir), 10)


@query
def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.kpi_summary(_events(spark, sf_dir), _products(spark, sf_dir))


@query
def layer_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per batch as made, as landed, as cleaned and as counted in the daily metrics."""
    root = scratch_path(spark, "layers")
    made = feeds.sales_event_feed(table(spark, sf_dir, "lineitem"))
    files.land_csv(_as_text(made, ingest.BATCH), f"{root}/feed", partition_by=[ingest.BATCH])
    bronze = files.read_feed(
        spark, f"{root}/feed", f"{stream_ledgers.EVENT_FEED_SCHEMA}, {ingest.BATCH} INT"
    )
    typed = rescue.drop_rescued(rescue.typed_parse(bronze, stream_ledgers.EVENT_TYPES))
    refine.refine_events(typed).write.parquet(f"{root}/silver")
    silver = spark.read.parquet(f"{root}/silver")
    gold = ledger.daily_sales(silver, (ingest.BATCH, "event_date")).select(
        ingest.BATCH,
        (F.col("sale_rows") + F.col("adjustment_rows") + F.col("cancel_rows")).alias("n_rows"),
    )
    layers = {"made": made, "bronze": bronze, "silver": silver, "gold": gold}
    return reconcile.reconcile_layers(layers, ingest.BATCH, rows="n_rows")


def _sales_runs(spark: SparkSession, sf_dir: str) -> SalesLayers:
    """Two deliveries with a run after each, and a run without news."""
    root = scratch_path(spark, "sales")
    made = feeds.sales_event_feed(table(spark, sf_dir, "lineitem"))
    products = feeds.product_extracts(spark, sf_dir)
    files.land_csv(_as_text(products, ingest.BATCH), f"{root}/extracts", partition_by=[ingest.BATCH], compression="gzip")
    sales = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("sale_id"), F.col("o_custkey").alias("customer_id")
    )
    later = F.col(ingest.BATCH) >= 1998
    layers = None
    for part in (~later, later, None):
        if part is not None:
            landed = _as_text(made.filter(part), ingest.BATCH)
            files.land_csv(landed, f"{root}/feed", mode="append", partition_by=[ingest.BATCH], compression="gzip")
        layers = run_sales_pipeline(
            spark, f"{root}/feed", f"{root}/extracts", sales, dim_customer(spark, sf_dir), f"{root}/layers", SYSTEM
        )
    return layers


@query
def sales_pipeline_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily metrics by batch at the end of the whole flow."""
    return _sales_runs(spark, sf_dir).daily


@query
def sales_pipeline_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide rows at the end of the whole flow."""
    return _sales_runs(spark, sf_dir).wide


@query
def sales_pipeline_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every layer holds the events that the source reports, batch by batch."""
    return _sales_runs(spark, sf_dir).reconcile(feeds.sales_event_feed(table(spark, sf_dir, "lineitem")))


def _sales_increments(spark: SparkSession, sf_dir: str) -> SalesLogs:
    """Three deliveries and two product extracts, a run after each, and a run without news.

    The second delivery is a single day, and the last one comes with a new extract.
    """
    root = scratch_path(spark, "increments")
    made = feeds.sales_event_feed(table(spark, sf_dir, "lineitem"))
    products = feeds.product_extracts(spark, sf_dir)
    sales = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("sale_id"), F.col("o_custkey").alias("customer_id")
    )
    later, day = F.col(ingest.BATCH) >= 1998, F.col("event_date") == F.lit("1997-07-01").cast("date")
    logs = None
    for number, part in enumerate((~later & ~day, ~later & day, later, None)):
        if part is not None:
            landed = _as_text(made.filter(part), ingest.BATCH)
            files.land_csv(landed, f"{root}/feed", mode="append", partition_by=[ingest.BATCH], compression="gzip")
        if number in (0, 2):
            extract = _as_text(products.filter(F.col(ingest.BATCH) == (1 if number == 0 else 2)), ingest.BATCH)
            files.land_csv(extract, f"{root}/extracts", mode="append", partition_by=[ingest.BATCH], compression="gzip")
        logs = run_sales_incremental(
            spark, f"{root}/feed", f"{root}/extracts", sales, dim_customer(spark, sf_dir), f"{root}/layers", SYSTEM, BUCKETS
        )
    return logs


@query
def sales_pipeline_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily metrics by batch, kept up to date by what each delivery changes."""
    return _sales_increments(spark, sf_dir).daily()


@query
def sales_incremental_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide rows of the same flow; a new extract changed the rows of the products that differ."""
    return _sales_increments(spark, sf_dir).wide_rows()


# ---- merge ----------------------------------------------------------------------------


@query
def merge_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_changes(
        feeds.account_target(spark, sf_dir), feeds.account_changes(spark, sf_dir), ["account_id"]
    )


@query
def merge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_metrics(
        merge.tag_changes(
            feeds.account_target(spark, sf_dir), feeds.account_changes(spark, sf_dir), ["account_id"]
        )
    )


@query
def merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of ``merge_apply``, merged into a target that lies in buckets of its key."""
    path, name = scratch_path(spark, "bucketed"), _unique("accounts")
    bucketed.store_bucketed(feeds.account_target(spark, sf_dir), f"{name}__first", f"{path}/first", ["account_id"], BUCKETS)
    bucketed.show_bucketed(spark, name, f"{name}__first", ["account_id", "name", "balance"])
    bucketed.merge_bucketed(spark, name, feeds.account_changes(spark, sf_dir), ["account_id"], path, BUCKETS)
    return spark.table(name)


ACCOUNT_SCHEMA = "account_id BIGINT, name STRING, balance DOUBLE"


def _merge_deliveries(spark: SparkSession, sf_dir: str) -> KeyedLog:
    """Four deliveries; the stream runs after the first, after the second, and after both others."""
    root = scratch_path(spark, "accounts")
    target = KeyedLog(spark, f"{root}/log", ACCOUNT_SCHEMA, ["account_id"], BUCKETS, changes.NOTES)
    changes.start_table(target, feeds.account_target(spark, sf_dir))
    deliveries = feeds.account_deliveries(spark, sf_dir)
    for numbers in ((1,), (2,), (3, 4)):
        files.land_csv(
            deliveries.filter(F.col(ingest.BATCH).isin(*numbers)),
            f"{root}/feed",
            mode="append",
            partition_by=[ingest.BATCH],
        )
        stream = ingest.arriving_csv(spark, f"{root}/feed", f"{ACCOUNT_SCHEMA}, change_type STRING")
        changes.stream_changes(stream, target, f"{root}/checkpoint", ["account_id"])
    return target


@query
def merge_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge_deliveries(spark, sf_dir).current()


@query
def merge_stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.change_counts(_merge_deliveries(spark, sf_dir))


@query
def merge_stream_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same deliveries in halves that overtake each other, one file a trigger; each is merged when it is whole."""
    root = scratch_path(spark, "parts")
    target = KeyedLog(spark, f"{root}/log", ACCOUNT_SCHEMA, ["account_id"], BUCKETS, changes.NOTES)
    changes.start_table(target, feeds.account_target(spark, sf_dir))
    deliveries = feeds.account_deliveries(spark, sf_dir)
    announced = deliveries.groupBy(F.col(ingest.BATCH).alias("delivery")).agg(F.count("*").alias("n_rows"))
    waiting = admission.waiting_table(spark, f"{root}/waiting", f"{ACCOUNT_SCHEMA}, change_type STRING")
    half = F.pmod(F.col("account_id"), F.lit(2))
    for halves in (((2, 0), (1, 1), (4, 0)), ((3, 1), (1, 0), (4, 1)), ((3, 0), (2, 1))):
        for delivery, side in halves:
            part = deliveries.filter((F.col(ingest.BATCH) == delivery) & (half == side))
            files.land_csv(part.coalesce(1), f"{root}/feed", mode="append", partition_by=[ingest.BATCH])
        stream = ingest.arriving_csv(spark, f"{root}/feed", f"{ACCOUNT_SCHEMA}, change_type STRING", files_per_trigger=1)
        admission.stream_parts(stream, announced, waiting, target, f"{root}/checkpoint", ["account_id"])
    return target.current()


@query
def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly event files in two deliveries; the later one corrects sales of the first."""
    root = scratch_path(spark, "ledger")
    events, net = stream_ledgers.ledger_tables(spark, root, BUCKETS)
    feed = feeds.sales_event_feed(table(spark, sf_dir, "lineitem"))
    later = F.col(ingest.BATCH) >= 1998
    for part in (~later, later):
        files.land_csv(
            _as_text(feed.filter(part), ingest.BATCH),
            f"{root}/feed",
            mode="append",
            partition_by=[ingest.BATCH],
        )
        stream = ingest.arriving_csv(spark, f"{root}/feed", stream_ledgers.EVENT_FEED_SCHEMA)
        stream_ledgers.stream_ledger(stream, events, net, f"{root}/checkpoint")
    return net.current()


# ---- files and event streams ----------------------------------------------------------

CLICK_SCHEMA = "event_id STRING, ts STRING, user_id STRING, event_type STRING, value STRING, props STRING"
CLICK_TYPES = {"event_id": "bigint", "ts": "timestamp", "user_id": "bigint", "value": "double"}


def _typed_clicks(df: DataFrame) -> DataFrame:
    return rescue.drop_rescued(rescue.typed_parse(df, CLICK_TYPES))


def _land_clicks(spark: SparkSession, sf_dir: str, folder: str, batch: int, rows: Column) -> None:
    clicks = table(spark, sf_dir, "events").filter(rows)
    files.land_csv(_as_text(clicks), f"{folder}/{ingest.BATCH}={batch}")


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries and a run without news: every landed row arrives once."""
    root = scratch_path(spark, "ingest")

    def run() -> DataFrame:
        return ingest.stream_ingest(
            spark, f"{root}/feed", CLICK_SCHEMA, f"{root}/bronze", f"{root}/checkpoint", SYSTEM
        )

    purchase = F.col("event_type") == "purchase"
    _land_clicks(spark, sf_dir, f"{root}/feed", 1, ~purchase)
    run()
    _land_clicks(spark, sf_dir, f"{root}/feed", 2, purchase)
    run()
    return _typed_clicks(run()).select(
        "event_id",
        _plain_time("ts"),
        "user_id",
        "event_type",
        "value",
        "props",
        F.col("_source_system").alias("source_system"),
        ingest.BATCH,
    )


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest events first, then, long behind them, all events again under other file names."""
    root = scratch_path(spark, "dedup")
    schema = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    target = seen.SeenEvents(spark, f"{root}/silver", schema, ["event_id"], BUCKETS)
    for batch, rows in ((1, F.col("event_type") == "purchase"), (2, F.lit(True))):
        _land_clicks(spark, sf_dir, f"{root}/feed", batch, rows)
        stream = _typed_clicks(ingest.arriving_csv(spark, f"{root}/feed", CLICK_SCHEMA)).drop(ingest.BATCH)
        seen.dedup_seen(stream, target, f"{root}/checkpoint")
    return target.events().withColumn("ts", _plain_time("ts"))


def click_rules() -> list[Rule]:
    return [
        Rule("has_id", "event_id IS NOT NULL", "fail"),
        Rule("no_error", "event_type <> 'error'", "drop"),
        Rule("worth_something", "value >= 1.0", "warn"),
    ]


def _checked_stream(spark: SparkSession, sf_dir: str) -> SteppedTable:
    root = scratch_path(spark, "checked")
    target = stream_rules.checked_target(
        spark,
        f"{root}/silver",
        "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING,"
        " source_batch_id INT",
    )
    click = F.col("event_type") == "click"
    for batch, rows in ((1, click), (2, ~click)):
        _land_clicks(spark, sf_dir, f"{root}/feed", batch, rows)
        stream = _typed_clicks(ingest.arriving_csv(spark, f"{root}/feed", CLICK_SCHEMA))
        stream_rules.stream_checked(stream, click_rules(), target, f"{root}/checkpoint")
    return target


@query
def stream_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _checked_stream(spark, sf_dir).rows()
    return rows.select("event_id", _plain_time("ts"), "user_id", "event_type", "value")


@query
def stream_expectation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _checked_stream(spark, sf_dir).commits()
    return counts.groupBy("rule", "action").agg(
        F.sum("failed_rows").alias("failed_rows"), F.sum("checked_rows").alias("checked_rows")
    )


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of a judged stream: the accepted rows, and the rejected ones with what they broke."""
    root = scratch_path(spark, "judged")
    schema = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING, source_batch_id INT"
    target = stream_rules.judged_target(spark, f"{root}/silver", schema)
    rules = [*click_rules(), Rule("not_cheap", "value >= 5.0", "drop")]
    click = F.col("event_type") == "click"
    for batch, rows in ((1, click), (2, ~click)):
        _land_clicks(spark, sf_dir, f"{root}/feed", batch, rows)
        stream = _typed_clicks(ingest.arriving_csv(spark, f"{root}/feed", CLICK_SCHEMA))
        stream_rules.stream_judged(stream, rules, target, f"{root}/checkpoint")
    columns = ["event_id", "event_type", "value", ingest.BATCH]
    good = stream_rules.accepted(target).select(*columns, F.lit("").alias("broken"))
    bad = stream_rules.rejected(target).select(*columns, F.array_join(stream_rules.BROKEN, ",").alias("broken"))
    return good.unionByName(bad)


@query
def idempotent_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, each loaded twice."""
    root = scratch_path(spark, "load")
    target = loads.load_target(spark, f"{root}/bronze", CLICK_SCHEMA)
    signup = F.col("event_type") == "signup"
    for batch, rows in ((1, ~signup), (2, signup)):
        _land_clicks(spark, sf_dir, f"{root}/feed", batch, rows)
        for _ in range(2):
            loads.load_new_files(target, f"{root}/feed", CLICK_SCHEMA, SYSTEM)
    return _typed_clicks(target.rows()).select(
        "event_id", _plain_time("ts"), "user_id", "event_type", "value", "props", ingest.BATCH
    )


PART_FEED = "part_key BIGINT, name STRING, size INT"


def _land_changing_parts(spark: SparkSession, sf_dir: str, folder: str, batch: int) -> None:
    """Three deliveries: as agreed; in another order with a new column; with cut-off and overlong lines and unreadable sizes."""
    parts = table(spark, sf_dir, "part").filter(F.col("p_size") % 3 == batch - 1)
    key, name, size = F.col("p_partkey"), F.col("p_name"), F.col("p_size")
    columns = {"part_key": key, "name": name, "size": size, "brand": F.col("p_brand")}
    orders = {1: ("part_key", "name", "size"), 2: ("size", "brand", "part_key", "name")}
    path = f"{folder}/{ingest.BATCH}={batch}"
    if batch in orders:
        files.land_csv(parts.select(*[columns[c].alias(c) for c in orders[batch]]), path)
        return
    end = F.when(key % 10 == 0, F.lit(None)).when(key % 7 == 0, F.concat(F.lit("big "), size)).otherwise(size.cast("string"))
    line = F.concat_ws(",", key, name, end, F.when((key % 15 == 0) & (key % 10 != 0), "more"))
    # one column under the whole header, with a separator that no text holds: lines stand as they are
    parts.select(line.alias("part_key,name,size")).write.options(header="true", sep="\x01", quote="").csv(path)


def _rescued_parts(df: DataFrame) -> DataFrame:
    return df.select("part_key", "name", "size", F.col(rescue.RESCUED).alias("rescued_data"), F.col("_source_system").alias("source_system"), ingest.BATCH)


@query
def load_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries with other headers and ragged lines, loaded by column name; each is loaded twice."""
    root = scratch_path(spark, "load-rescue")
    target = loads.load_target(spark, f"{root}/bronze", PART_FEED)
    for batch in (1, 2, 3):
        _land_changing_parts(spark, sf_dir, f"{root}/feed", batch)
        for _ in range(2 if batch == 1 else 1):
            loads.load_new_files(target, f"{root}/feed", PART_FEED, SYSTEM)
    return _rescued_parts(target.rows())


@query
def stream_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same deliveries as a stream: one run for the first, one for the others, one without news."""
    root = scratch_path(spark, "stream-rescue")
    target = loads.load_target(spark, f"{root}/bronze", PART_FEED)
    for batches in ((1,), (2, 3), ()):
        for batch in batches:
            _land_changing_parts(spark, sf_dir, f"{root}/feed", batch)
        ingest.stream_rescue(spark, f"{root}/feed", PART_FEED, target, f"{root}/checkpoint", SYSTEM)
    return _rescued_parts(target.rows())


@query
def table_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = tables.table_file_stats({name: table(spark, sf_dir, name) for name in ALL_TABLES})
    return stats.select("table_name", "n_files", "n_rows", (F.col("n_bytes") > 0).alias("has_bytes"))


@query
def manifest_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reconcile_manifest(*feeds.page_manifest(spark, sf_dir))


@query
def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered files, hashed where they lie, against their manifest; empty files count."""
    path = scratch_path(spark, "delivered")
    listed = feeds.land_pages(spark, sf_dir, path)
    return reconcile.reconcile_manifest(folder.folder_hashes(spark, path), listed)


@query
def path_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = table(spark, sf_dir, "pages").select(
        F.regexp_replace("url", "^[a-z]+://[^/]+/", "").alias("path")
    )
    return reconcile.count_by_prefix(paths, "path")


@query
def safe_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web addresses, names, priorities (a digit leads) and names without letters (nothing is left)."""
    urls = table(spark, sf_dir, "pages").select(F.col("url").alias("text"))
    names = table(spark, sf_dir, "customer").select(
        F.explode(
            F.array("c_name", F.regexp_replace("c_name", "[A-Za-z0-9]", "-"))
        ).alias("text")
    )
    priorities = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("text"))
    texts = urls.unionByName(names).unionByName(priorities)
    return texts.groupBy("text").agg(F.count("*").alias("n_rows")).withColumn(
        "identifier", safe_identifier(F.col("text"))
    )
