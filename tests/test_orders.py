"""The order flow on a small feed with planted defects; expected values by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.fixed import ORDER_FEED_SCHEMA
from strata.functions import to_units
from strata.operators import marts, profile, reconcile, refine, rescue
from strata.plans.medallion import Layers, run_medallion
from strata.session import scratch_path
from strata.sources.files import land_csv, read_feed, stamp_lineage
from strata.sources.tables import scan

ROWS = [
    ("A1", "K1", "2025-03-01 08:00:00", " Shop", "10.10", "Paid ", "de"),
    ("A2", "K2", "2025-03-01 09:00:00", "phone", "20.25", "PAID", "fr"),
    ("A3", "K1", "2025-03-01 23:59:59", "shop", "5.05", "paid", " DE"),
    ("A4", "K3", "2025-03-02 10:00:00", "shop", None, "created", "de"),
    ("A5", "K4", None, "phone", "7.00", "paid", "fr"),
    ("A6", "K5", "2025-03-02 11:00:00", "web", "30.00", "paid", "it"),
    ("A6", "K5", "2025-03-02 12:00:00", "web", "31.00", "paid", "it"),
    ("A7", "K6", "2025-03-02 12:30:00", "web", "many", "paid", "it"),
    ("A8", "K6", "2025-03-02 12:30:00", "web", "9.00", None, "it"),
    ("A9", "K6", "2025-03-02 12:30:00", "web", "9.00", "lost", "it"),
    (None, "K7", "2025-03-02 13:00:00", "web", "1.00", "paid", "it"),
]


@pytest.fixture(scope="module")
def feed(spark):
    return spark.createDataFrame(ROWS, ORDER_FEED_SCHEMA)


@pytest.fixture(scope="module")
def silver(feed):
    return refine.refine_orders(feed)


def test_profile_counts_rows_keys_and_gaps(feed):
    row = profile.profile_feed(feed, "order_id", ["order_ts", "amount", "status"]).first()
    assert row.asDict() == {
        "n_rows": 11,
        "rows_with_key": 10,
        "distinct_keys": 9,
        "order_ts_nulls": 1,
        "amount_nulls": 1,
        "status_nulls": 1,
    }


def test_duplicate_keys(feed):
    assert [tuple(r) for r in profile.duplicate_keys(feed, ["order_id"]).collect()] == [("A6", 2)]


def test_one_row_per_key_and_the_latest_stays(silver):
    assert silver.count() == 10
    assert silver.filter("order_id = 'A6'").first()["amount_value"] == 31.0


def test_texts_are_tidy_and_raw_columns_stay(silver):
    row = silver.filter("order_id = 'A1'").first()
    assert (row["status"], row["status_clean"]) == ("Paid ", "paid")
    assert (row["channel"], row["channel_clean"]) == (" Shop", "shop")
    assert row["country"] == "DE"
    assert row["order_date"] == dt.date(2025, 3, 1)


def test_valid_and_invalid_are_all_rows(silver):
    summary = {r["is_valid"]: r for r in marts.amount_summary(silver, {"is_valid": "is_valid"}, distinct={"distinct_orders": "order_id"}).collect()}
    assert set(summary) == {True, False}
    assert (summary[True]["n_rows"], summary[True]["observed_amount"]) == (4, 66.4)
    # a null key makes a row invalid and is no distinct order
    assert (summary[False]["n_rows"], summary[False]["distinct_orders"]) == (6, 5)
    assert summary[False]["observed_amount"] == 26.0
    ids = {r["order_id"] for r in refine.quarantine(silver).collect()}
    assert ids == {"A4", "A5", "A7", "A8", "A9", None}


def test_daily_revenue_and_rank(silver):
    gold = marts.daily_revenue(silver)
    ranked = marts.daily_channel_rank(gold).orderBy("order_date", "rank_in_day").collect()
    day1, day2 = dt.date(2025, 3, 1), dt.date(2025, 3, 2)
    assert [tuple(r) for r in ranked] == [
        (day1, "phone", 1, 20.25, 20.25, 1),
        # mean of 10.10 and 5.05 is 7.575: halves go up
        (day1, "shop", 2, 15.15, 7.58, 2),
        (day2, "web", 1, 31.0, 31.0, 1),
    ]


def test_equal_revenue_shares_a_rank_without_gaps(spark):
    day = dt.date(2025, 1, 1)
    gold = spark.createDataFrame(
        [(day, "a", 5.0), (day, "b", 9.0), (day, "c", 9.0)],
        "order_date DATE, channel STRING, revenue DOUBLE",
    )
    ranks = {r["channel"]: r["rank_in_day"] for r in marts.daily_channel_rank(gold).collect()}
    assert ranks == {"b": 1, "c": 1, "a": 2}


def test_status_by_country(silver):
    rows = {(r["country"], r["status"]): (r["n_rows"], r["observed_amount"]) for r in marts.amount_summary(silver, {"country": "country", "status": "status_clean"}).collect()}
    assert rows[("DE", "paid")] == (2, 15.15)
    assert rows[("DE", "created")] == (1, 0.0)
    assert rows[("IT", None)] == (1, 9.0)


def test_result_does_not_depend_on_row_order(feed, silver):
    again = refine.refine_orders(feed.repartition(5, "amount"))
    assert sorted(map(str, again.collect())) == sorted(map(str, silver.collect()))


def test_refining_twice_changes_nothing(silver):
    raw = silver.select("order_id", "customer_id", "order_ts", "channel", "amount", "status", "country")
    again = refine.refine_orders(raw)
    assert sorted(map(str, again.collect())) == sorted(map(str, silver.collect()))


def test_landed_feed_comes_back_unchanged(spark, feed):
    folder = scratch_path(spark, "feed")
    odd = spark.createDataFrame([("B1", 'a "quoted", text', " x ", None, "é", "1", "z")], ORDER_FEED_SCHEMA)
    land_csv(feed.unionByName(odd), folder, rows_per_file=3)
    back = read_feed(spark, folder, ORDER_FEED_SCHEMA)
    assert sorted(map(str, back.collect())) == sorted(map(str, feed.unionByName(odd).collect()))


def test_lineage_names_the_file(spark, feed):
    folder = scratch_path(spark, "feed")
    land_csv(feed, folder)
    row = stamp_lineage(read_feed(spark, folder, ORDER_FEED_SCHEMA), "shop", batch=7).first()
    assert folder in row["_source_file"] and row["_source_file"].endswith(".csv")
    assert (row["_source_system"], row["source_batch_id"]) == ("shop", 7)
    assert row["_ingested_at"] is not None


def test_whole_flow(spark, feed):
    root = scratch_path(spark, "flow")
    land_csv(feed, f"{root}/feed")
    names = run_medallion(spark, f"{root}/feed", root, Layers("t_bronze", "t_silver", "t_gold"))
    bronze, silver, gold = names.frames(spark)
    assert (bronze.count(), silver.count(), gold.count()) == (11, 10, 3)
    assert spark.catalog.getTable("t_gold").description == "Daily revenue by channel"
    checks = {r["check"]: (r["value"], r["passed"]) for r in reconcile.layer_checks(bronze, silver, gold).collect()}
    assert checks == {
        "bronze_rows": (11.0, True),
        "silver_orders": (9.0, True),
        "gold_revenue": (66.4, True),
    }
    assert scan(spark, "t_silver").count() == 10


def test_large_and_odd_numbers_stay_and_are_no_money(spark):
    """They were unreadable once, which lost their rows in flows that drop what does not fit."""
    texts = [("1e15", None), ("NaN", None), ("Infinity", None), ("-2e13", None), ("12.5", "x"), ("10:30", "10:30")]
    df = spark.createDataFrame(texts, "amount STRING, at STRING")
    rows = rescue.typed_parse(df, {"amount": "double", "at": "timestamp"}).collect()
    assert [r["amount"] is None for r in rows] == [False] * 5 + [True]
    assert [r[rescue.RESCUED] for r in rows[:4]] == [None] * 4
    # a time of day alone would be another time on another day
    assert rows[5][rescue.RESCUED] == '{"amount":"10:30","at":"10:30"}'
    units = df.select(to_units(F.col("amount").try_cast("double"), 2).alias("u")).collect()
    assert [r["u"] for r in units] == [None, None, None, -2 * 10**15, 1250, None]
    order = ("B1", "K1", "2025-03-02 13:00:00", "web", "NaN", "paid", "it")
    silver = refine.refine_orders(spark.createDataFrame([order], ORDER_FEED_SCHEMA)).first()
    assert silver["is_valid"] is False


def test_a_header_that_differs_is_an_error(spark):
    folder = scratch_path(spark, "header")
    land_csv(spark.createDataFrame([("1", "2")], "b STRING, a STRING"), folder)
    with pytest.raises(Exception, match="header|CSV"):
        read_feed(spark, folder, "a STRING, b STRING").collect()


def test_empty_gold_fails_the_checks(silver, feed):
    gold = marts.daily_revenue(silver.filter("false"))
    with pytest.raises(AssertionError, match="gold_revenue"):
        reconcile.assert_layers(feed, silver, gold)
