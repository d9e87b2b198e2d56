"""The incremental sales flow: the same layers as the whole one, and only what changed is written."""

import datetime
import random

import pytest

from strata.plans import sales_incremental
from strata.plans.sales import run_sales_pipeline
from strata.plans.sales_incremental import run_sales_incremental, sales_logs
from strata.session import scratch_path
from strata.sources.files import land_csv
from strata.sources.versions import GONE
from strata.streaming.ingest import BATCH
from strata.streaming.ledger import EVENT_FEED_SCHEMA

PRODUCT = "product_id STRING, product_name STRING, brand STRING, category STRING, list_price STRING"
DAY = datetime.date


@pytest.fixture
def flow(spark):
    """Both flows over the same folders."""

    class Flow:
        def __init__(self):
            self.root = scratch_path(spark, "flow")
            self.sales = spark.createDataFrame([(n, n % 3) for n in range(40)], "sale_id BIGINT, customer_id BIGINT")
            self.customers = spark.createDataFrame([(n, f"c{n}", "s", "n", "r") for n in range(3)], "customer_id BIGINT, customer_name STRING, segment STRING, nation STRING, region STRING")
            self.extract(1, [("1", "p1", "b", "c", "1.5"), ("2", "p2", "b", "c", "2.5")])

        def events(self, batch, rows):
            land_csv(spark.createDataFrame(rows, EVENT_FEED_SCHEMA), f"{self.root}/feed/{BATCH}={batch}", mode="append")

        def extract(self, batch, rows):
            land_csv(spark.createDataFrame(rows, PRODUCT), f"{self.root}/extracts/{BATCH}={batch}", mode="append")

        def run(self):
            return run_sales_incremental(spark, f"{self.root}/feed", f"{self.root}/extracts", self.sales, self.customers, f"{self.root}/logs", buckets=4)

        def whole(self):
            return run_sales_pipeline(spark, f"{self.root}/feed", f"{self.root}/extracts", self.sales, self.customers, f"{self.root}/whole")

        def check(self, logs):
            layers = self.whole()
            for ours, theirs in ((logs.daily(), layers.daily), (logs.wide_rows(), layers.wide), (logs.silver.current().drop("event_key"), layers.silver)):
                rows = [sorted(map(tuple, df.select(*sorted(theirs.columns)).collect()), key=repr) for df in (ours, theirs)]
                assert rows[0] == rows[1]

    return Flow()


def event(sale, line, kind="sale", day="2024-01-01", product="1", amount="10.0"):
    return (str(sale), str(line), kind, day, product, "7", "2.0", amount)


def test_deliveries_in_any_order_end_like_the_whole_flow(flow):
    pick = random.Random(3)
    for number in range(4):
        rows = [
            event(pick.randint(0, 12), pick.randint(1, 2), pick.choice(["sale", "Adjustment", " cancel", "odd"]), f"2024-01-0{pick.randint(1, 6)}", str(pick.randint(1, 4)), str(pick.randint(1, 90) / 4))
            for _ in range(25)
        ]
        rows += [event(None if number % 2 else "x", 1), (None, None, "sale", None, None, None, None, "1"), event(5, 5, amount="unreadable")]
        flow.events(pick.randint(1, 3), [tuple(None if v == "None" else v for v in r) for r in rows])
        logs = flow.run()
        if number == 2:
            flow.extract(2, [("2", "p2 new", "b", "c", "2.5"), ("3", "p3", "b", "c", "1.0")])
    flow.check(flow.run())
    steps = logs.silver.steps()
    assert flow.run().silver.steps() == steps


def test_a_delivery_of_one_day_writes_that_day_only(flow):
    flow.events(1, [event(s, 1, day=f"2024-01-0{1 + s % 5}") for s in range(20)])
    flow.run()
    flow.events(1, [event(30, 1, day="2024-01-03"), event(31, 1, day="2024-01-03")])
    logs = flow.run()
    assert [r["event_date"] for r in logs.days.rows_at(logs.days.steps()[-1]).collect()] == [DAY(2024, 1, 3)]
    assert sorted(r["sale_id"] for r in logs.silver.rows_at(logs.silver.steps()[-1]).collect()) == [30, 31]
    assert sorted(r["sale_id"] for r in logs.wide.rows_at(logs.wide.steps()[-1]).collect()) == [30, 31]
    flow.check(logs)


def test_a_late_correction_moves_an_event_between_days(flow):
    flow.events(1, [event(1, 1, day="2024-01-01"), event(2, 1, day="2024-01-02")])
    flow.run()
    # the newer version of the event lies on another day and in another batch; an older one changes nothing
    flow.events(2, [event(1, 1, "cancel", day="2024-01-05"), event(2, 1, day="2023-01-01", amount="99")])
    logs = flow.run()
    touched = {(r["event_date"], r[GONE]) for r in logs.days.rows_at(logs.days.steps()[-1]).collect()}
    assert touched == {(DAY(2024, 1, 1), True), (DAY(2024, 1, 5), False)}
    assert sorted((r[BATCH], r["event_date"].day, r["cancel_rows"]) for r in logs.daily().collect()) == [(1, 2, 0), (2, 5, 1)]
    flow.check(logs)


def test_a_new_extract_changes_only_the_rows_of_products_that_differ(flow):
    flow.events(1, [event(s, 1, product=str(s % 3)) for s in range(9)])
    flow.run()
    flow.extract(2, [("1", "p1", "b", "c", "1.5"), ("2", "renamed", "b", "c", "2.5")])
    logs = flow.run()
    assert {r["product_id"] for r in logs.wide.rows_at(logs.wide.steps()[-1]).collect()} == {2}
    flow.check(logs)
    flow.extract(3, [("1", "p1", "b", "c", "1.5")])
    logs = flow.run()
    assert all(r["product_name"] is None for r in logs.wide.rows_at(logs.wide.steps()[-1]).collect())
    flow.check(logs)


@pytest.mark.parametrize("broken", ["update_days", "rewiden"])
def test_a_run_that_broke_is_completed_by_the_next(flow, monkeypatch, broken):
    flow.events(1, [event(s, 1) for s in range(4)])
    flow.run()
    flow.events(2, [event(1, 1, day="2024-02-01"), event(9, 1, day="2024-02-02")])

    def fails(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(sales_incremental, broken, fails)
        with pytest.raises(RuntimeError):
            flow.run()
    flow.events(3, [event(9, 1, day="2024-03-01")])
    flow.check(flow.run())


def test_the_layers_agree(spark, flow):
    flow.events(1, [event(s, 1) for s in range(4)])
    flow.events(2, [event(s, 2, day="2024-01-02") for s in range(5)])
    logs = flow.run()
    made = spark.createDataFrame([(1,)] * 4 + [(2,)] * 5, f"{BATCH} INT")
    assert sorted(tuple(r)[1:] for r in logs.reconcile(made).collect()) == [(4,) * 5, (5,) * 5]
    assert sales_logs(spark, f"{flow.root}/logs", 4).daily().count() == 2
