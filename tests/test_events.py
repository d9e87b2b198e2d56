"""Sales events, ledger, dimensions and profiles on small data; values by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import dimensions, ledger, profile, refine

D = dt.date
FEED = (
    "sale_id BIGINT, line_no INT, event_type STRING, event_date DATE, product_id BIGINT,"
    " supplier_id BIGINT, quantity DOUBLE, amount DOUBLE, source_batch_id INT"
)
ROWS = [
    # sold, then adjusted down
    (1, 1, " sale", D(2025, 1, 1), 10, 5, 2.0, 20.004, 1),
    (1, 2, "adjustment", D(2025, 1, 4), 10, 5, 0.0, -3.5, 1),
    # sold and cancelled later; the sale came twice, the later version counts
    (2, 1, "sale", D(2025, 1, 2), 11, 6, 1.0, 50.0, 1),
    (2, 1, "Sale", D(2025, 1, 3), 11, 6, 1.0, 55.555, 2),
    (2, 2, "cancel", D(2025, 2, 20), 11, 6, 0.0, 0.0, 2),
    # sold, never corrected
    (3, 1, "sale", D(2025, 1, 3), 10, 6, 1.0, 7.0, 2),
    # a correction that came before the sale does not count as its delay
    (4, 1, "cancel", D(2025, 1, 1), 12, 5, 0.0, 0.0, 1),
    (4, 2, "sale", D(2025, 1, 5), 12, 5, 1.0, 9.0, 2),
    # a correction without a sale
    (5, 1, "adjustment", D(2025, 1, 1), 12, 5, 0.0, 1.0, 1),
]


@pytest.fixture(scope="module")
def events(spark):
    return refine.refine_events(spark.createDataFrame(ROWS, FEED))


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(
        [(10, "pen", "B1"), (11, "cup", "B2")], "product_id BIGINT, product_name STRING, brand STRING"
    )


def test_events_are_clean_and_once(events):
    rows = {r["sales_event_id"]: r for r in events.collect()}
    assert len(rows) == 8
    assert rows["1-1"]["event_type"] == "SALE" and rows["1-1"]["amount_cents"] == 2000
    assert rows["2-1"]["amount_cents"] == 5556 and rows["2-1"]["source_batch_id"] == 2


def test_survivor_does_not_depend_on_row_order(spark, events):
    again = refine.refine_events(spark.createDataFrame(ROWS[::-1], FEED).repartition(7))
    assert sorted(map(str, again.collect())) == sorted(map(str, events.collect()))


def test_net_ledger(events):
    net = {r["sale_id"]: r["net_cents"] for r in ledger.net_ledger(events).collect()}
    assert net == {1: 1650, 2: 0, 3: 700, 4: 0, 5: 100}


def test_correction_delay(events):
    delays = {r["sale_id"]: r["delay_days"] for r in ledger.correction_delays(events).collect()}
    assert delays == {1: 3, 2: 48, 3: None, 4: None}
    groups = {r["delay_group"]: r["n_sales"] for r in ledger.correction_latency(events).collect()}
    assert groups == {"1-7 days": 1, "31-90 days": 1, "not corrected": 2}


def test_batch_counts_are_of_what_arrived(spark):
    arrived = refine.normalise_events(spark.createDataFrame(ROWS, FEED))
    assert {tuple(r) for r in ledger.batch_event_counts(arrived).collect()} == {(1, 2, 2, 1), (2, 3, 0, 1)}


def test_daily_sales(events):
    days = {r["event_date"]: r for r in ledger.daily_sales(events).collect()}
    assert days[D(2025, 1, 3)]["sale_amount"] == 62.56
    assert days[D(2025, 1, 4)]["adjustment_amount"] == -3.5
    assert days[D(2025, 1, 1)]["sold_quantity"] == 2


def test_top_products_break_ties_by_id(spark, products):
    sold = spark.createDataFrame(
        [("SALE", 11, 300), ("SALE", 10, 300), ("SALE", 12, 100), ("CANCEL", 12, 900)],
        "event_type STRING, product_id BIGINT, amount_cents BIGINT",
    )
    rows = ledger.top_products(sold, products, 2).collect()
    assert sorted((r["product_id"], r["product_name"], r["sale_amount"]) for r in rows) == [
        (10, "pen", 3.0),
        (11, "cup", 3.0),
    ]


def test_kpis(events, products):
    rows = {r["metric"]: (r["value"], r["label"]) for r in ledger.kpi_summary(events, products).collect()}
    assert rows == {
        "sales": (5.0, None),
        "gross_sales": (91.56, None),
        "net_revenue": (24.5, None),
        "correction_rate": (0.4, None),
        "cancel_rate": (0.4, None),
        "best_product": (55.56, "cup"),
    }


def test_kpis_of_no_events(events, products):
    rows = {r["metric"]: r["value"] for r in ledger.kpi_summary(events.filter("false"), products).collect()}
    assert rows == {"sales": 0.0, "gross_sales": None, "net_revenue": None, "correction_rate": None, "cancel_rate": None}


def test_shares_add_up(events, products):
    rows = profile.product_mix(events, products).collect()
    assert abs(sum(r["share"] for r in rows) - 1) < 1e-12
    assert {r["product_id"]: r["product_name"] for r in rows} == {10: "pen", 11: "cup", 12: None}


def test_territory_keeps_unknown_suppliers(spark, events):
    suppliers = spark.createDataFrame([(5, "North", "N1")], "supplier_id BIGINT, region STRING, nation STRING")
    rows = {r["nation"]: r["amount_cents"] for r in profile.territory_mix(events, suppliers).collect()}
    assert rows == {"N1": 2000 - 350 + 900 + 100, None: 5556 + 700}


def test_weekdays_start_on_monday(spark):
    days = [D(2025, 1, 6)] * 3 + [D(2025, 1, 13)] + [D(2025, 1, 12)] + [None]
    df = spark.createDataFrame([(d,) for d in days], "event_date DATE")
    rows = {r["weekday"]: r.asDict() for r in profile.weekday_profile(df).collect()}
    assert rows[1] == {"weekday": 1, "n_days": 2, "n_rows": 4, "least_rows": 1, "most_rows": 3, "mean_rows": 2.0}
    assert set(rows) == {1, 7}


def test_latest_extract_is_the_current_state(spark):
    extracts = spark.createDataFrame(
        [(1, "old", 1), (2, "gone", 1), (1, "new", 2), (3, "fresh", 2)], "id INT, name STRING, source_batch_id INT"
    )
    assert sorted(r["name"] for r in dimensions.latest_batch(extracts).collect()) == ["fresh", "new"]


def test_wide_table_keeps_every_event(spark, events, products):
    sales = spark.createDataFrame([(1, 100), (2, 101)], "sale_id BIGINT, customer_id BIGINT")
    customers = spark.createDataFrame([(100, "Zoe")], "customer_id BIGINT, customer_name STRING")
    full = products.withColumns({"category": F.lit("x"), "list_price": F.lit(1.0)})
    wide = dimensions.build_obt(events, sales, customers, full)
    assert wide.count() == events.count()
    names = {(r["sale_id"], r["customer_name"]) for r in wide.collect()}
    assert names == {(1, "Zoe"), (2, None), (3, None), (4, None), (5, None)}
