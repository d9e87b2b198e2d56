"""The whole flow of sales events: landed deliveries to wide rows and daily metrics, batch by batch."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.dimensions import build_obt, latest_batch
from strata.operators.ledger import daily_sales
from strata.operators.reconcile import content_mark, reconcile_layers
from strata.operators.refine import EVENT_ID, event_id, refine_events
from strata.operators.rescue import drop_rescued, typed_parse
from strata.sources.files import read_feed
from strata.sources.tables import file_stats
from strata.sources.versions import STEP, SteppedTable
from strata.streaming.ingest import BATCH, stream_ingest
from strata.streaming.ledger import EVENT_FEED_SCHEMA, EVENT_TYPES

PRODUCT_SCHEMA = "product_id STRING, product_name STRING, brand STRING, category STRING, list_price STRING"
PRODUCT_TYPES = {"product_id": "bigint", "list_price": "double"}

#: What a finished run says: folders of its layers, and marks of what they were made of.
RUN = "silver STRING, wide STRING, silver_of STRING, wide_of STRING"


@dataclass(frozen=True)
class SalesLayers:
    """What a run made; every layer carries the batch of the events."""

    bronze: DataFrame
    silver: DataFrame
    wide: DataFrame
    daily: DataFrame

    def reconcile(self, made: DataFrame) -> DataFrame:
        """Events per batch in every layer, beside what the source reports."""
        daily = self.daily.withColumn("n_rows", self.daily.sale_rows + self.daily.adjustment_rows + self.daily.cancel_rows)
        layers = {"made": made, "bronze": self.bronze, "silver": self.silver, "wide": self.wide, "daily": daily}
        return reconcile_layers(layers, BATCH, rows="n_rows")


def run_sales_pipeline(
    spark: SparkSession,
    events: str,
    extracts: str,
    sales: DataFrame,
    customers: DataFrame,
    root: str,
    system: str = "sales",
) -> SalesLayers:
    """Take in what is new below ``events`` and remake the layers above Bronze that something changed.

    ``events`` holds deliveries and ``extracts`` full product extracts, both as
    CSV in folders by batch. Files come into Bronze once, however often this
    runs. The other layers are written to new folders, so readers of the ones
    before are not disturbed, and a run that broke leaves nothing that is read.

    Silver follows from the files of Bronze, the layers above it from Silver, the
    products, the sales and the customers. Each run reads all of these for their
    ``content_mark``; layers made of the same contents stand as they are.
    """
    bronze = stream_ingest(spark, events, EVENT_FEED_SCHEMA, f"{root}/bronze", f"{root}/checkpoint", system)
    runs = SteppedTable(spark, f"{root}/runs", "note STRING", RUN)
    last = runs.commits().orderBy(F.desc(STEP)).first()
    fresh = uuid.uuid4().hex

    def layer(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{root}/{fresh}/{name}")
        return held(fresh, name)

    def held(folder: str, name: str) -> DataFrame:
        return spark.read.parquet(f"{root}/{folder}/{name}")

    silver_of = content_mark(file_stats(bronze))
    same_silver = last is not None and last["silver_of"] == silver_of
    if same_silver:
        silver = held(last["silver"], "silver")
    else:
        typed = drop_rescued(typed_parse(bronze.select(*EVENT_TYPES_ORDER, BATCH), EVENT_TYPES))
        silver = layer(refine_events(typed), "silver")
    listed = read_feed(spark, extracts, f"{PRODUCT_SCHEMA}, {BATCH} INT")
    products = drop_rescued(typed_parse(latest_batch(listed), PRODUCT_TYPES)).drop(BATCH)
    wide_of = "\n".join([silver_of, *map(content_mark, (products, sales.select("sale_id", "customer_id"), customers))])
    if same_silver and last["wide_of"] == wide_of:
        return SalesLayers(bronze, silver, held(last["wide"], "wide"), held(last["wide"], "daily"))
    # the text id is made anew behind the joins: their shuffles need not carry it
    columns = build_obt(silver, sales, customers, products).columns
    joined = build_obt(silver.drop(EVENT_ID), sales, customers, products)
    wide = layer(joined.withColumn(EVENT_ID, event_id()).select(*columns), "wide")
    daily = layer(daily_sales(wide, (BATCH, "event_date")), "daily")
    said = spark.createDataFrame([(last["silver"] if same_silver else fresh, fresh, silver_of, wide_of)], RUN)
    runs.commit(said, runs.next_step())
    return SalesLayers(bronze, silver, wide, daily)


#: Columns of the event feed in their order.
EVENT_TYPES_ORDER = tuple(c.split()[0] for c in EVENT_FEED_SCHEMA.split(", "))
