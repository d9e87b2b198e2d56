"""A net sales ledger that late corrections keep changing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators.ledger import net_ledger
from strata.operators.refine import latest_events, normalise_events
from strata.operators.rescue import drop_rescued, typed_parse
from strata.sources.versions import KeyedLog
from strata.streaming.ingest import run_batches

#: The event files: every column is text.
EVENT_FEED_SCHEMA = (
    "sale_id STRING, line_no STRING, event_type STRING, event_date STRING,"
    " product_id STRING, supplier_id STRING, quantity STRING, amount STRING"
)
EVENT_TYPES = {
    "sale_id": "bigint",
    "line_no": "int",
    "event_date": "date",
    "product_id": "bigint",
    "supplier_id": "bigint",
    "quantity": "double",
    "amount": "double",
}
CLEAN_EVENTS = (
    "sale_id BIGINT, line_no INT, event_type STRING, event_date DATE, product_id BIGINT,"
    " supplier_id BIGINT, quantity DOUBLE, source_batch_id INT, amount_cents BIGINT"
)
NET_LEDGER = (
    "sale_id BIGINT, n_events BIGINT, sale_cents BIGINT, adjustment_cents BIGINT,"
    " adjustment_rows BIGINT, cancel_rows BIGINT, net_cents BIGINT"
)


def ledger_tables(spark: SparkSession, root: str, buckets: int = 64) -> tuple[KeyedLog, KeyedLog]:
    """The clean events seen so far and the net ledger, both by sale."""
    return (
        KeyedLog(spark, f"{root}/events", CLEAN_EVENTS, ["sale_id"], buckets),
        KeyedLog(spark, f"{root}/ledger", NET_LEDGER, ["sale_id"], buckets),
    )


def stream_ledger(feed: DataFrame, events: KeyedLog, ledger: KeyedLog, checkpoint: str) -> None:
    """Append new clean events and the new ledger rows of the sales they touch.

    A correction may come any time after its sale. The seen events lie in a
    table and not in streaming state, so no watermark ever drops one. Only the
    touched sales are read again and get new rows; readers take a sale's last.
    """

    def apply(batch: DataFrame, origin: str) -> None:
        fresh = normalise_events(drop_rescued(typed_parse(batch, EVENT_TYPES)))
        if not events.has(origin):
            events.append(fresh, events.next_step(), origin)
        if not ledger.has(origin):
            seen = latest_events(events.history(fresh).select(*events.columns))
            ledger.append(net_ledger(seen), ledger.next_step(), origin)

    run_batches(feed, apply, checkpoint)
