import math
import random

import pytest
from pyspark.sql import functions as F

from strata.llm.exact_topk import exact_topk
from strata.llm.queries import ORACLES, op7_exact_topk
from tests.llm.cases import rows_of
from tests.oracle_check import differences, duck

NAMES = ("query_id", "rank", "vec_id", "score")
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, k, asks):
    good = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            whole = [math.floor(256 * x) for x in v]
            good[i] = min(good.get(i, whole), whole)
    out = []
    for q in filter(asks, good):
        scores = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [(4096, 4096), (7, 3)])
def test_cases(spark, sizes):
    pick = random.Random(4)
    vector = lambda: [float(pick.choice([-1, -0.25, 0, 0.5, 0.125])) for _ in range(4)]
    rows = [(n, vector(), n) for n in range(90)] + [(100, None, 1), (110, [], 1), (120, [1.0, None, 0.0, 0.0], 1), (130, [float("nan")] * 4, None)]
    rows += [(140, [float("inf"), 0.0, 0.0, 0.0], 1), (None, vector(), 1), (150, [1.0, 2.0], 1), (160, [3.0, 1.0], 1), rows[5], rows[10], (170, [1e6] * 4, 2)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash")).withColumn("vec", F.lit(0))
    got = exact_topk(df, F.col("vec_id") % 10 == 0, 5, shard_rows=sizes[0], query_rows=sizes[1])
    assert rows_of(got, *NAMES) == brute_force(rows, 5, lambda i: i % 10 == 0)


def test_few_rows_and_values_beyond_doubles(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert rows_of(exact_topk(df, F.col("vec_id") == 0, 5), *NAMES) == [(0, 1, 1, 256 * 512)]
    big = spark.createDataFrame([(0, [3e6 + 1, 1.0]), (1, [5e6, 2.0])], "vec_id long, embedding array<double>")
    assert rows_of(exact_topk(big, F.col("vec_id") == 0, 5), *NAMES) == [(0, 1, 1, 256 * 3000001 * 256 * 5000000 + 256 * 512)]
    assert exact_topk(df.limit(0), F.col("vec_id") == 0, 5).count() == 0
    assert exact_topk(df, F.col("vec_id") == 9, 5).count() == 0


def test_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    assert differences(op7_exact_topk(spark, folder), ORACLES["op7_exact_topk"], duck(folder)) == []
