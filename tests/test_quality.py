import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from strata.functions import exact_sum, from_units, mean_from_units, safe_identifier, to_units
from strata.operators import reconcile
from strata.operators.expectations import (
    ExpectationFailed,
    Rule,
    drop_failing,
    expectations_report,
    observe_rules,
    raise_for,
    stop_on_failing,
)
from strata.operators.rescue import RESCUED, drop_rescued, typed_parse
from strata.session import scratch_path


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(
        [("1", "2.5", "2025-01-01"), ("x", "two", "soon"), (None, None, None), ("3", "1e20", "2025-01-02")],
        "a STRING, b STRING, c STRING",
    )


def test_misfits_are_rescued_in_order(texts):
    rows = typed_parse(texts, {"a": "int", "b": "double", "c": "date"}).collect()
    assert rows[0].asDict()[RESCUED] is None
    assert rows[1].asDict() == {
        "a": None,
        "b": None,
        "c": None,
        RESCUED: '{"a":"x","b":"two","c":"soon"}',
    }
    # missing is not misfit
    assert rows[2].asDict()[RESCUED] is None
    # a number that whole units of money cannot hold is still a number
    assert (rows[3]["b"], rows[3][RESCUED]) == (1e20, None)


def test_rescued_rows_are_left_out(texts):
    kept = drop_rescued(typed_parse(texts, {"a": "int"}))
    assert kept.columns == ["a", "b", "c"]
    assert [r["a"] for r in kept.collect()] == [1, None, 3]


RULES = [
    Rule("small", "n < 3", "warn"),
    Rule("present", "n IS NOT NULL", "drop"),
    Rule("not_huge", "coalesce(n, 0) < 100", "fail"),
]


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(1,), (5,), (None,)], "n INT")


def test_report_counts_null_as_failed(numbers):
    report = {r["rule"]: (r["action"], r["failed_rows"], r["checked_rows"]) for r in expectations_report(numbers, RULES).collect()}
    assert report == {"small": ("warn", 2, 3), "present": ("drop", 1, 3), "not_huge": ("fail", 0, 3)}


def test_report_of_no_rows(numbers):
    report = expectations_report(numbers.filter("false"), RULES).collect()
    assert [(r["failed_rows"], r["checked_rows"]) for r in report] == [(0, 0)] * 3


def test_drop_removes_and_warn_keeps(numbers):
    assert sorted(r["n"] for r in drop_failing(numbers, RULES).collect()) == [1, 5]


def test_fail_ends_the_job_even_for_a_count(spark, numbers):
    assert stop_on_failing(numbers, RULES).count() == 3
    bad = spark.createDataFrame([(1,), (500,)], "n INT")
    with pytest.raises(PySparkException, match="expectation not_huge failed"):
        stop_on_failing(bad, RULES).count()


def test_counts_taken_during_a_write(spark, numbers):
    counts = Observation()
    drop_failing(observe_rules(numbers, RULES, counts), RULES).write.parquet(scratch_path(spark, "obs"))
    assert counts.get == {"checked_rows": 3, "small": 2, "present": 1, "not_huge": 0}
    raise_for(counts.get, RULES)
    with pytest.raises(ExpectationFailed, match="not_huge"):
        raise_for({**counts.get, "not_huge": 4}, RULES)


def test_unknown_action_is_refused():
    with pytest.raises(ValueError):
        Rule("r", "true", "ignore")


@pytest.mark.parametrize(
    "text, name",
    [
        ("Ana.Silva@mail.org", "ana_silva_mail_org"),
        ("__a--b__", "a_b"),
        ("9lives", "u_9lives"),
        ("", "student"),
        ("***", "student"),
        ("ação", "a_o"),
        (None, None),
        ("x" * 60, "x" * 40),
        ("1" + "y" * 60, "u_1" + "y" * 37),
        ("a_" * 30, "a_" * 20),
    ],
)
def test_safe_identifier(spark, text, name):
    df = spark.createDataFrame([(text,)], "t STRING")
    assert df.select(safe_identifier(F.col("t")).alias("n")).first()["n"] == name


@pytest.mark.parametrize(
    "units, rows, digits, mean",
    [(5, 2, 2, 0.03), (-5, 2, 2, -0.03), (10, 4, 2, 0.03), (0, 0, 2, None), (75750, 1, 4, 7.58), (-75750, 1, 4, -7.58)],
)
def test_means_round_halves_away_from_zero(spark, units, rows, digits, mean):
    df = spark.createDataFrame([(units, rows)], "u BIGINT, n BIGINT")
    assert df.select(mean_from_units(F.col("u"), F.col("n"), digits).alias("m")).first()["m"] == mean


def test_sub_cent_amounts_are_rounded_once(spark):
    df = spark.createDataFrame([(0.005,), (0.005,)], "a DOUBLE")
    total = df.agg(F.sum(to_units(F.col("a"), 4)).alias("u")).select(from_units(F.col("u"), 4).alias("t"))
    assert total.first()["t"] == 0.01


@pytest.mark.parametrize("values", [[2**62, 2**62, 2**62], [-(2**62), -5, 3], [-1], [0], [2**63 - 1, -(2**63)], [None]])
def test_exact_sum_has_no_overflow(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "u BIGINT")
    total = sum(values) if values != [None] else None
    assert df.agg(exact_sum(F.col("u")).alias("t")).first()["t"] == total


def test_plain_sum_overflow_is_an_error(spark):
    df = spark.createDataFrame([(2**62,), (2**62,)], "u BIGINT")
    with pytest.raises(PySparkException, match="ARITHMETIC_OVERFLOW|overflow"):
        df.agg(F.sum("u")).collect()


def test_manifest_states(spark):
    schema = "path STRING, content_hash STRING"
    have = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", "4"), ("d", "5")], schema)
    want = spark.createDataFrame([("a", "1"), ("b", "9"), ("e", "6"), ("d", "4"), ("a", "1")], schema)
    states = {r["path"]: r["state"] for r in reconcile.reconcile_manifest(have, want).collect()}
    assert states == {"a": "ok", "b": "changed", "c": "stale", "d": "changed", "e": "missing"}


def test_files_are_hashed_where_they_lie(spark, tmp_path):
    import hashlib

    (tmp_path / "x").mkdir()
    for name, text in (("a.txt", "olá"), ("x/b.txt", "b")):
        (tmp_path / name).write_text(text, encoding="utf-8")
    rows = {r["path"].rsplit("/", 1)[1]: r["content_hash"] for r in reconcile.file_hashes(spark, str(tmp_path)).collect()}
    assert rows == {
        "a.txt": hashlib.sha256("olá".encode()).hexdigest(),
        "b.txt": hashlib.sha256(b"b").hexdigest(),
    }


def test_prefix_counts(spark):
    df = spark.createDataFrame([("en/a",), ("en/b/c",), ("pt/a",), ("top",)], "p STRING")
    assert {tuple(r) for r in reconcile.count_by_prefix(df, "p").collect()} == {("en", 2), ("pt", 1), ("top", 1)}


def test_layers_side_by_side(spark):
    raw = spark.createDataFrame([(1,), (1,), (2,)], "b INT")
    clean = spark.createDataFrame([(1,), (3,)], "b INT")
    daily = spark.createDataFrame([(1, 5), (1, 2)], "b INT, n BIGINT")
    rows = reconcile.reconcile_layers({"raw": raw, "clean": clean, "daily": daily}, "b", rows="n")
    assert {tuple(r) for r in rows.collect()} == {(1, 2, 1, 7), (2, 1, 0, 0), (3, 0, 1, 0)}
