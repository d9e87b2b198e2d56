"""Streams: each row once, replays do nothing, broken rules publish nothing."""

import pytest
from pyspark.errors import StreamingQueryException

from strata.operators.expectations import Rule
from strata.operators.ledger import net_ledger
from strata.operators.refine import refine_events
from strata.operators.rescue import drop_rescued, typed_parse
from strata.session import scratch_path
from strata.sources.files import land_csv, read_feed
from strata.sources.versions import BUCKET, STEP, KeyedLog, SteppedTable
from strata.streaming import changes, dedup, expectations, ingest, ledger

FEED = "n INT, t STRING"


def _land(spark, folder, batch, rows, schema=FEED):
    land_csv(spark.createDataFrame(rows, schema), f"{folder}/{ingest.BATCH}={batch}", mode="append")


def test_files_arrive_once(spark):
    root = scratch_path(spark, "in")

    def run():
        return ingest.stream_ingest(spark, f"{root}/feed", FEED, f"{root}/out", f"{root}/ck", "s")

    _land(spark, f"{root}/feed", 1, [(1, "a"), (2, "b")])
    assert run().count() == 2
    assert run().count() == 2
    _land(spark, f"{root}/feed", 2, [(3, "c")])
    _land(spark, f"{root}/feed", 1, [(4, "d")])
    rows = run().select("n", ingest.BATCH, "_source_system").collect()
    assert sorted(map(tuple, rows)) == [(1, 1, "s"), (2, 1, "s"), (3, 2, "s"), (4, 1, "s")]


def test_copies_within_the_delay_are_dropped(spark):
    root = scratch_path(spark, "dd")
    schema = "id INT, ts TIMESTAMP, v INT"

    def run():
        stream = ingest.arriving_csv(spark, f"{root}/feed", schema)
        stream = stream.withColumn(dedup.SPREAD, dedup.file_spread(4))
        once = dedup.dedup_stream(stream, ["id"], "ts", "10 days")
        ingest.append_stream(once.drop(ingest.BATCH), f"{root}/out", f"{root}/ck")
        return sorted(r["id"] for r in spark.read.parquet(f"{root}/out").collect())

    texts = "id INT, ts STRING, v INT"
    first = (1, "2025-01-01 00:00:00", 1)
    _land(spark, f"{root}/feed", 1, [first, first, (2, "2025-01-05 00:00:00", 1)], texts)
    assert run() == [1, 2]
    _land(spark, f"{root}/feed", 2, [(1, "2025-01-01 00:00:00", 1), (3, "2025-01-02 00:00:00", 1)], texts)
    assert run() == [1, 2, 3]
    # copies in very many files still give one row
    for _ in range(6):
        _land(spark, f"{root}/feed", 3, [(4, "2025-01-06 00:00:00", 1)], texts)
    assert run() == [1, 2, 3, 4]


RULES = [Rule("named", "t IS NOT NULL", "drop"), Rule("positive", "n > 0", "fail"), Rule("big", "n > 1", "warn")]


def test_rules_on_a_stream(spark):
    root = scratch_path(spark, "rules")
    target = expectations.checked_target(spark, f"{root}/out", f"{FEED}, {ingest.BATCH} INT")

    def run():
        stream = ingest.arriving_csv(spark, f"{root}/feed", FEED)
        expectations.stream_checked(stream, RULES, target, f"{root}/ck")

    _land(spark, f"{root}/feed", 1, [(1, "a"), (2, None)])
    run()
    assert [r["n"] for r in target.rows().collect()] == [1]
    counts = {r["rule"]: (r["failed_rows"], r["checked_rows"]) for r in target.commits().collect()}
    assert counts == {"named": (1, 2), "positive": (0, 2), "big": (1, 2)}

    _land(spark, f"{root}/feed", 2, [(5, "e"), (-1, "f")])
    with pytest.raises(StreamingQueryException, match="positive"):
        run()
    # nothing of the broken batch is published, and it stays broken
    assert [r["n"] for r in target.rows().collect()] == [1]
    with pytest.raises(StreamingQueryException):
        run()
    assert target.commits().select("_step").distinct().count() == 1


ACCOUNT = "id INT, name STRING, score DOUBLE"


def _accounts(spark, root, rows):
    target = KeyedLog(spark, f"{root}/t", ACCOUNT, ["id"], 4, changes.NOTES)
    changes.start_table(target, spark.createDataFrame(rows, ACCOUNT))
    return target


def _merge(spark, root, target, checkpoint="ck", **how):
    stream = ingest.arriving_csv(spark, f"{root}/feed", f"{ACCOUNT}, change_type STRING", **how)
    changes.stream_changes(stream, target, f"{root}/{checkpoint}", ["id"])
    return sorted(map(tuple, target.current().collect()))


def test_change_sets_apply_in_order(spark):
    root = scratch_path(spark, "ch")
    target = _accounts(spark, root, [(1, "a", 1.0), (2, "b", 2.0)])
    changes.start_table(target, spark.createDataFrame([(1, "other", 9.0)], ACCOUNT))

    schema = f"{ACCOUNT}, change_type STRING"
    # three deliveries at once; the key is inserted, updated, then deleted and another one updated
    _land(spark, f"{root}/feed", 1, [(3, "c", 3.0, "insert"), (1, "a", 1.5, "update")], schema)
    _land(spark, f"{root}/feed", 2, [(3, "c", 3.5, "update"), (1, "a", None, "delete")], schema)
    _land(spark, f"{root}/feed", 3, [(1, "a", 9.0, "update"), (2, "b", 2.5, "update")], schema)
    assert _merge(spark, root, target) == [(2, "b", 2.5), (3, "c", 3.5)]
    assert _merge(spark, root, target) == [(2, "b", 2.5), (3, "c", 3.5)]
    counted = {(r["delivery"], r["action"]): r["n_rows"] for r in changes.change_counts(target).collect()}
    assert len(counted) == 9 and {k: n for k, n in counted.items() if n} == {
        (1, "inserted"): 1,
        (1, "updated"): 1,
        (2, "updated"): 1,
        (2, "deleted"): 1,
        (3, "updated"): 1,
    }
    _land(spark, f"{root}/feed", 4, [(1, "a", 4.0, "insert")], schema)
    assert _merge(spark, root, target) == [(1, "a", 4.0), (2, "b", 2.5), (3, "c", 3.5)]


def test_a_change_set_out_of_order_is_an_error(spark):
    root = scratch_path(spark, "order")
    target = _accounts(spark, root, [(1, "a", 1.0)])
    schema = f"{ACCOUNT}, change_type STRING"
    _land(spark, f"{root}/feed", 2, [(1, "second", 2.0, "update")], schema)
    assert _merge(spark, root, target) == [(1, "second", 2.0)]
    _land(spark, f"{root}/feed", 1, [(1, "first", 1.0, "update")], schema)
    with pytest.raises(StreamingQueryException, match="change set 1 comes after change set 2"):
        _merge(spark, root, target)
    assert [tuple(r) for r in target.current().collect()] == [(1, "second", 2.0)]


def test_a_change_set_that_comes_in_parts_is_an_error(spark):
    root = scratch_path(spark, "parts")
    target = _accounts(spark, root, [(1, "a", 1.0)])
    for n in (1, 2):
        _land(spark, f"{root}/feed", 1, [(1, f"v{n}", 1.0, "update")], f"{ACCOUNT}, change_type STRING")
    with pytest.raises(StreamingQueryException, match="change set 1 comes after change set 1"):
        _merge(spark, root, target, files_per_trigger=1)


def test_another_checkpoint_applies_nothing_twice(spark):
    root = scratch_path(spark, "replay")
    target = _accounts(spark, root, [(1, "a", 1.0)])
    _land(spark, f"{root}/feed", 1, [(1, "a", None, "delete")], f"{ACCOUNT}, change_type STRING")
    assert _merge(spark, root, target, "ck1") == []
    # a fresh checkpoint hands out the files again, and says so
    with pytest.raises(StreamingQueryException, match="change set 1 comes after change set 1"):
        _merge(spark, root, target, "ck2")
    assert target.current().count() == 0 and target.next_step() == 2


def test_a_delivery_writes_and_reads_its_keys_only(spark):
    root = scratch_path(spark, "narrow")
    target = _accounts(spark, root, [(n, "a", 1.0) for n in range(200)])
    _land(spark, f"{root}/feed", 1, [(7, "new", 2.0, "update")], f"{ACCOUNT}, change_type STRING")
    assert len(_merge(spark, root, target)) == 200
    assert [r["id"] for r in target.history().filter(f"{STEP} = 1").collect()] == [7]
    plan = target.current(spark.createDataFrame([(7,)], "id INT"))._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({BUCKET}" in plan or f"{BUCKET}#" in plan.split("PartitionFilters: [")[1][:60]


def test_null_keys_and_repeated_keys_stay(spark):
    root = scratch_path(spark, "nulls")
    target = _accounts(spark, root, [(None, "n", 1.0), (1, "x", 1.0), (1, "y", 2.0)])
    _land(spark, f"{root}/feed", 1, [(None, "m", 2.0, "insert"), (1, "z", 3.0, "insert"), (None, "q", 1.0, "delete")], f"{ACCOUNT}, change_type STRING")
    rows = target.current().collect()
    stream = ingest.arriving_csv(spark, f"{root}/feed", f"{ACCOUNT}, change_type STRING")
    changes.stream_changes(stream, target, f"{root}/ck", ["id"])
    after = sorted(((r["id"] is None, r["id"] or 0, r["name"]) for r in target.current().collect()))
    assert len(rows) == 3
    assert after == [(False, 1, "x"), (False, 1, "y"), (True, 0, "m"), (True, 0, "n")]


def test_a_table_keeps_its_number_of_buckets(spark):
    root = scratch_path(spark, "buckets")
    _accounts(spark, root, [(n, "a", 1.0) for n in range(100)])
    with pytest.raises(ValueError, match="4 buckets, not 8"):
        KeyedLog(spark, f"{root}/t", ACCOUNT, ["id"], 8, changes.NOTES)


def test_a_second_stream_is_not_taken_for_the_first(spark):
    root = scratch_path(spark, "second")
    target = expectations.checked_target(spark, f"{root}/out", f"{FEED}, {ingest.BATCH} INT")
    for name, rows in (("a", [(1, "a"), (2, "b"), (3, "c")]), ("b", [(4, "d"), (5, "e")])):
        _land(spark, f"{root}/{name}", 1, rows)
        stream = ingest.arriving_csv(spark, f"{root}/{name}", FEED)
        expectations.stream_checked(stream, RULES, target, f"{root}/ck_{name}")
    assert sorted(r["n"] for r in target.rows().collect()) == [1, 2, 3, 4, 5]


def test_very_late_events_are_kept(spark):
    root = scratch_path(spark, "late")
    target = SteppedTable(spark, f"{root}/t", "id INT, ts TIMESTAMP, v INT")

    def run():
        stream = ingest.arriving_csv(spark, f"{root}/feed", "id INT, ts TIMESTAMP, v INT").drop(ingest.BATCH)
        dedup.dedup_into(stream, ["id"], target, f"{root}/ck")
        return sorted((r["id"], r["v"]) for r in target.rows().collect())

    texts = "id INT, ts STRING, v INT"
    _land(spark, f"{root}/feed", 1, [(1, "2025-01-01 00:00:00", 1), (1, "2025-01-01 00:00:00", 1)], texts)
    assert run() == [(1, 1)]
    _land(spark, f"{root}/feed", 2, [(2, "2019-01-01 00:00:00", 2), (1, "2025-01-01 00:00:00", 1)], texts)
    assert run() == [(1, 1), (2, 2)]
    assert run() == [(1, 1), (2, 2)]


EVENT = (
    "sale_id BIGINT, line_no INT, event_type STRING, event_date STRING, product_id BIGINT,"
    " supplier_id BIGINT, quantity STRING, amount STRING"
)


def _event(sale, line, kind, day, amount):
    return (sale, line, kind, day, 7, 8, "1.0", amount)



def test_late_corrections_change_the_ledger(spark):
    root = scratch_path(spark, "led")
    events, net = ledger.ledger_tables(spark, root, buckets=4)
    deliveries = {
        1: [
            _event(1, 1, "sale", "2025-01-01", "10.0"),
            _event(2, 1, "sale", "2025-01-01", "20.0"),
            _event(3, 1, "sale", "2025-01-02", "no"),
        ],
        2: [_event(1, 2, "adjustment", "2025-02-01", "-2.5"), _event(2, 1, "sale", "2025-01-01", "20.0")],
        # long after, and the first sale in a later version
        3: [_event(2, 2, "cancel", "2026-01-01", "0"), _event(1, 1, "sale", "2025-03-01", "11.0")],
    }
    want = [{1: 1000, 2: 2000}, {1: 750, 2: 2000}, {1: 850, 2: 0}]
    for (batch, rows), expected in zip(deliveries.items(), want):
        _land(spark, f"{root}/feed", batch, rows, EVENT)
        stream = ingest.arriving_csv(spark, f"{root}/feed", ledger.EVENT_FEED_SCHEMA)
        ledger.stream_ledger(stream, events, net, f"{root}/ck")
        assert {r["sale_id"]: r["net_cents"] for r in net.current().collect()} == expected
    # the same as one batch over everything
    schema = f"{ledger.EVENT_FEED_SCHEMA}, {ingest.BATCH} INT"
    everything = typed_parse(read_feed(spark, f"{root}/feed", schema), ledger.EVENT_TYPES)
    batch = net_ledger(refine_events(drop_rescued(everything)))
    assert sorted(map(str, batch.collect())) == sorted(map(str, net.current().select(batch.columns).collect()))


def test_crash_between_events_and_ledger_is_made_good(spark, monkeypatch):
    root = scratch_path(spark, "crash")
    events, net = ledger.ledger_tables(spark, root, buckets=4)
    _land(spark, f"{root}/feed", 1, [_event(1, 1, "sale", "2025-01-01", "10.0")], EVENT)

    def run():
        stream = ingest.arriving_csv(spark, f"{root}/feed", ledger.EVENT_FEED_SCHEMA)
        ledger.stream_ledger(stream, events, net, f"{root}/ck")

    def crash(*args, **kwargs):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as patch:
        patch.setattr(net, "append", crash)
        with pytest.raises(StreamingQueryException, match="lost the driver"):
            run()
    assert events.history().count() == 1 and net.current().count() == 0
    run()
    assert [(r["sale_id"], r["net_cents"]) for r in net.current().collect()] == [(1, 1000)]
    assert events.commits().count() == 1


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default):
            return self.value

    class Session:
        def __init__(self, master, value):
            self.conf = Conf(value)
            self.sparkContext = type("Context", (), {"master": master})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Session("yarn", None), "x")
    assert scratch_path(Session("yarn", "s3a://shared/work/"), "x").startswith("s3a://shared/work/x-")
