"""The flow of sales events, kept up to date by what changed.

Every delivery becomes a step of Bronze. What its events change is worked out
from the touched events alone: their versions before and after the step. Silver
and the wide rows get new rows for the changed events. The daily metrics are
whole numbers that add up, so a day gets its old numbers less what the changed
events were plus what they are; days that no changed event was or is in are
neither read nor written. A new product extract changes the wide rows of the
products that differ, and nothing else.

Every layer is a log of steps that name the Bronze step they come from. What is
written above Silver follows from Silver's step and the steps before it, so a
run that broke anywhere is completed by the next one.

Customers and the sales' customers are looked up when an event changes; give
``rewiden`` the events to look them up again.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.fixed import ADJUSTMENT, CANCEL, SALE
from strata.functions import from_units
from strata.operators.dimensions import build_obt, latest_batch
from strata.operators.reconcile import reconcile_layers
from strata.operators.refine import EVENT_ID, EVENT_KEYS, event_id, latest_events, normalise_events
from strata.operators.rescue import drop_rescued, drop_unreadable, typed_parse
from strata.plans.sales import PRODUCT_SCHEMA, PRODUCT_TYPES
from strata.session import shuffles_removed
from strata.sources.files import read_feed
from strata.sources.loads import load_target
from strata.sources.versions import GONE, KeyedLog, SteppedTable
from strata.streaming.ingest import BATCH, stream_rescue
from strata.streaming.ledger import CLEAN_EVENTS, EVENT_FEED_SCHEMA, EVENT_TYPES

EVENT_KEY, DAY_KEY = "event_key", "day_key"
#: Whether an event comes from the delivery and not from Silver.
CAME = "_came"
PRODUCTS = "product_id BIGINT, product_name STRING, brand STRING, category STRING, list_price DOUBLE"
CUSTOMER = "customer_id BIGINT, customer_name STRING, segment STRING, nation STRING, region STRING"
#: Whole numbers per batch and day.
MEASURES = ("n_events", "sale_rows", "adjustment_rows", "cancel_rows", "sold_quantity", "sale_cents", "adjustment_cents")


def _measures() -> dict[str, Column]:
    """What an event adds to each measure of its day."""
    kind, cents = F.col("event_type"), F.col("amount_cents")
    values = (
        F.lit(1), kind == SALE, kind == ADJUSTMENT, kind == CANCEL, F.when(kind == SALE, F.col("quantity")),
        F.when(kind == SALE, cents), F.when(kind == ADJUSTMENT, cents),
    )
    return {name: value.cast("bigint") for name, value in zip(MEASURES, values)}


def _key(*columns: str) -> Column:
    """One text for several values, also where some are null."""
    return F.to_json(F.struct(*columns))


@dataclass(frozen=True)
class SalesLogs:
    """The layers; each but Bronze shows a key's rows as the last step left them."""

    bronze: SteppedTable
    products: KeyedLog
    silver: KeyedLog
    wide: KeyedLog
    days: KeyedLog

    def daily(self) -> DataFrame:
        """Daily metrics as ``ledger.daily_sales`` gives them."""
        return self.days.current().select(
            BATCH, "event_date", "sale_rows", "adjustment_rows", "cancel_rows", "sold_quantity",
            from_units(F.col("sale_cents")).alias("sale_amount"), from_units(F.col("adjustment_cents")).alias("adjustment_amount"),
        )

    def wide_rows(self) -> DataFrame:
        return self.wide.current().drop(EVENT_KEY)

    def reconcile(self, made: DataFrame) -> DataFrame:
        """Events per batch in every layer, beside what the source reports."""
        days = self.days.current().withColumnRenamed("n_events", "n_rows")
        layers = {"made": made, "bronze": self.bronze.rows(), "silver": self.silver.current(), "wide": self.wide.current(), "daily": days}
        return reconcile_layers(layers, BATCH, rows="n_rows")


def sales_logs(spark: SparkSession, root: str, buckets: int = 64) -> SalesLogs:
    events = f"{EVENT_KEY} STRING, {CLEAN_EVENTS}, sales_event_id STRING"
    numbers = ", ".join(f"{m} BIGINT" for m in MEASURES)
    wide = f"{events}, {CUSTOMER}, {PRODUCTS.removeprefix('product_id BIGINT, ')}"
    return SalesLogs(
        load_target(spark, f"{root}/bronze", EVENT_FEED_SCHEMA),
        KeyedLog(spark, f"{root}/products", PRODUCTS, ["product_id"], buckets),
        KeyedLog(spark, f"{root}/silver", events, [EVENT_KEY], buckets),
        KeyedLog(spark, f"{root}/wide", wide, [EVENT_KEY], buckets),
        KeyedLog(spark, f"{root}/days", f"{DAY_KEY} STRING, {BATCH} INT, event_date DATE, {numbers}", [DAY_KEY], buckets),
    )


def _differing(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Rows that ``others`` lacks in this very form."""
    same = reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in rows.columns])
    return rows.alias("l").join(others.select(*rows.columns).alias("r"), same, "left_anti")


def update_products(logs: SalesLogs, extracts: DataFrame) -> DataFrame | None:
    """Take in the last of the full extracts if it is new; the ids of the products that differ, or none."""
    last = extracts.agg(F.max(BATCH)).first()[0]
    if last is None:
        return None
    origin = f"extract:{last}"
    if not logs.products.has(origin):
        listed = drop_rescued(typed_parse(latest_batch(extracts), PRODUCT_TYPES)).drop(BATCH)
        held = logs.products.current()
        gone = held.join(listed.select("product_id"), "product_id", "left_anti").withColumn(GONE, F.lit(True))
        changed = _differing(listed.select(*held.columns), held).withColumn(GONE, F.lit(False)).unionByName(gone)
        logs.products.append(changed, logs.products.next_step(), origin)
    return logs.products.rows_at(logs.products.step_of(origin)).select("product_id").distinct()


def _events_of(rows: DataFrame) -> DataFrame:
    typed = drop_unreadable(typed_parse(rows, EVENT_TYPES), EVENT_TYPES)
    return normalise_events(typed.select(*[c.split()[0] for c in EVENT_FEED_SCHEMA.split(", ")], BATCH))


def _ids() -> dict[str, Column]:
    return {EVENT_KEY: _key(*EVENT_KEYS), EVENT_ID: event_id()}


def _with_ids(events: DataFrame) -> DataFrame:
    return events.withColumns(_ids())


def update_silver(logs: SalesLogs, bronze_step: int) -> int:
    """Append the events that a Bronze step changes; the step of Silver."""
    origin = f"bronze:{bronze_step}"
    if (done := logs.silver.step_of(origin)) is not None:
        return done
    fresh = _events_of(logs.bronze.rows_at(bronze_step))
    held = logs.silver.current(_with_ids(fresh)).select(*fresh.columns)
    # the latest of what was and what came: the order is total, so earlier versions need not be read again. Of equal
    # rows the held one wins, so the winners that came are the rows that differ
    latest = latest_events(held.withColumn(CAME, F.lit(False)).unionByName(fresh.withColumn(CAME, F.lit(True))))
    step = logs.silver.next_step()
    logs.silver.append(latest.filter(CAME).drop(CAME), step, origin, derived=_ids())
    return step


def update_days(logs: SalesLogs, silver_step: int, origin: str) -> None:
    """Add to the days what the events of a Silver step are, less what they were."""
    if logs.days.has(origin):
        return
    after = logs.silver.rows_at(silver_step).select(*logs.silver.columns)
    before = logs.silver.current(after, before=silver_step)
    signed = after.withColumn("_sign", F.lit(1)).unionByName(before.withColumn("_sign", F.lit(-1)))
    sums = [F.coalesce(F.sum(measure * F.col("_sign")), F.lit(0)).alias(name) for name, measure in _measures().items()]
    change = signed.groupBy(_key(BATCH, "event_date").alias(DAY_KEY), BATCH, "event_date").agg(*sums)
    both = logs.days.current(change).unionByName(change)
    total = both.groupBy(DAY_KEY, BATCH, "event_date").agg(*[F.sum(m).alias(m) for m in MEASURES])
    logs.days.append(total.withColumn(GONE, F.col("n_events") == 0), logs.days.next_step(), origin)


def rewiden(logs: SalesLogs, events: DataFrame, sales: DataFrame, customers: DataFrame, origin: str) -> None:
    """Append wide rows of these events, with their dimensions as they are now."""
    if logs.wide.has(origin):
        return
    # the texts that the keys give are made anew behind the joins and in the log: their shuffles need not carry them
    carried = [c for c in logs.silver.columns if c not in (EVENT_KEY, EVENT_ID)]
    rows = build_obt(events.select(*carried), sales, customers, logs.products.current())
    logs.wide.append(rows, logs.wide.next_step(), origin, derived=_ids())


def run_sales_incremental(
    spark: SparkSession, events: str, extracts: str, sales: DataFrame, customers: DataFrame, root: str, system: str = "sales", buckets: int = 64
) -> SalesLogs:
    """Take in what is new below ``events`` and ``extracts`` and bring the layers up to date."""
    with shuffles_removed(spark):
        logs = sales_logs(spark, root, buckets)
        listed = read_feed(spark, extracts, f"{PRODUCT_SCHEMA}, {BATCH} INT")
        differing = update_products(logs, listed)
        if differing is not None:
            origin = f"products:{logs.products.next_step() - 1}"
            if not logs.wide.has(origin):
                if logs.silver.next_step():
                    rewiden(logs, logs.silver.current().join(differing, "product_id", "left_semi"), sales, customers, origin)
                else:
                    # nothing to widen before the first delivery, which then meets these products: a step without rows says so
                    logs.wide.append(logs.wide.current(), logs.wide.next_step(), origin)
        stream_rescue(spark, events, EVENT_FEED_SCHEMA, logs.bronze, f"{root}/checkpoint", system, pattern="*.{csv,csv.gz}")
        for step in logs.bronze.steps():
            origin = f"bronze:{step}"
            if logs.days.has(origin) and logs.wide.has(origin):
                continue
            silver_step = update_silver(logs, step)
            update_days(logs, silver_step, origin)
            rewiden(logs, logs.silver.rows_at(silver_step), sales, customers, origin)
    return logs
