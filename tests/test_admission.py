"""Deliveries in parts: whole, in order, once."""

import random

import pytest
from pyspark.errors import StreamingQueryException

from strata.session import scratch_path
from strata.sources.files import land_csv
from strata.sources.versions import KeyedLog
from strata.streaming import admission, changes, ingest

ACCOUNT = "id INT, name STRING, score DOUBLE"
CHANGE = f"{ACCOUNT}, change_type STRING"
DELIVERIES = {
    1: [(1, "a1", 1.0, "update"), (2, None, None, "delete"), (3, "c", 1.0, "insert")],
    2: [(2, "b2", 2.0, "insert"), (3, "c2", 2.0, "update")],
    4: [(3, None, None, "delete"), (1, "a4", 4.0, "update")],
}
AFTER = {0: [(1, "a", 0.0), (2, "b", 0.0)], 1: [(1, "a1", 1.0), (3, "c", 1.0)], 2: [(1, "a1", 1.0), (2, "b2", 2.0), (3, "c2", 2.0)], 4: [(1, "a4", 4.0), (2, "b2", 2.0)]}


@pytest.fixture
def flow(spark):
    class Flow:
        def __init__(self, announced=None):
            self.root = scratch_path(spark, "parts")
            self.target = KeyedLog(spark, f"{self.root}/t", ACCOUNT, ["id"], 4, changes.NOTES)
            changes.start_table(self.target, spark.createDataFrame(AFTER[0], ACCOUNT))
            self.waiting = admission.waiting_table(spark, f"{self.root}/w", CHANGE)
            counts = announced or {d: len(rows) for d, rows in DELIVERIES.items()}
            self.announced = spark.createDataFrame(list(counts.items()), "delivery INT, n_rows BIGINT")

        def land(self, delivery, rows):
            land_csv(spark.createDataFrame(rows, CHANGE).coalesce(1), f"{self.root}/feed/{ingest.BATCH}={delivery}", mode="append")

        def run(self):
            stream = ingest.arriving_csv(spark, f"{self.root}/feed", CHANGE, files_per_trigger=1)
            admission.stream_parts(stream, self.announced, self.waiting, self.target, f"{self.root}/ck", ["id"])
            return sorted(map(tuple, self.target.current().collect()))

    return Flow


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_in_any_order_end_alike(flow, seed):
    f, pick = flow(), random.Random(seed)
    rows = [(d, row) for d, some in DELIVERIES.items() for row in some]
    pick.shuffle(rows)
    come = {d: 0 for d in DELIVERIES}
    for k, (d, row) in enumerate(rows):
        f.land(d, [row])
        come[d] += 1
        if k % 3 == 2 or k == len(rows) - 1:
            done = 0
            for n in DELIVERIES:  # complete so far, without a gap
                if come[n] < len(DELIVERIES[n]):
                    break
                done = n
            assert f.run() == AFTER[done]
    assert f.run() == AFTER[4]


def test_a_delivery_waits_for_the_one_before(flow):
    f = flow()
    f.land(2, DELIVERIES[2])
    f.land(4, DELIVERIES[4])
    assert f.run() == AFTER[0]
    f.land(1, DELIVERIES[1])
    assert f.run() == AFTER[4]


def test_a_merge_that_broke_is_made_up_for(flow, monkeypatch):
    f = flow()
    f.land(1, DELIVERIES[1])
    with monkeypatch.context() as patch:
        patch.setattr(admission, "merge_delivery", lambda *a: 1 / 0)
        with pytest.raises(StreamingQueryException):
            f.run()
    assert f.run() == AFTER[1]
    assert admission.arrived(f.waiting).first()["n_rows"] == 3


def test_more_rows_than_announced_and_deliveries_nobody_announced(flow):
    f = flow({1: 2})
    f.land(1, DELIVERIES[1])
    with pytest.raises(StreamingQueryException, match="delivery 1 has 3 rows, announced are 2"):
        f.run()
    f = flow({1: 3})
    f.land(9, DELIVERIES[1])
    with pytest.raises(StreamingQueryException, match="announced are None"):
        f.run()


def test_an_empty_delivery_holds_nothing_up(flow):
    f = flow({1: 3, 2: 0, 4: 2})
    f.land(4, DELIVERIES[4])
    f.land(1, DELIVERIES[1])
    assert f.run() == [(1, "a4", 4.0)]
