import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.loser_tree import common_prefix, merge_prefixed, merge_runs
from strata.llm.queries import op1_suffix_dedup
from strata.llm.suffix_dedup import GROUP, HOT, LAST_ID, _by_pairs, _by_windows, _how_sent, remove_repeats
from tests.llm.cases import documents, plain, rows_of

SMALL = "/root/testdata/sf0.001"


def brute_force(rows, length=50):
    coded = [(LAST_ID if i is None else i, t.encode()) for i, t in rows]
    first = {}
    for i, b in coded:
        for p in range(len(b) - length + 1):
            first[b[p : p + length]] = min(first.get(b[p : p + length], LAST_ID), i)
    out = []
    for (i, _), (own, b) in zip(rows, coded):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < own:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for j, g in enumerate(gone) if g and (not j or not gone[j - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df, **how):
    out = remove_repeats(df, **how).withColumn("sha", F.sha2("kept", 256))
    return rows_of(out, "doc_id", "n_bytes", "n_removed", "n_spans", "sha")


@pytest.mark.parametrize("how", [{}, {"hot": 2, "partitions": 3, "run_bytes": 500}, {"length": 20}])
def test_like_brute_force(spark, how):
    pick = random.Random(5)
    base = ["".join(pick.choice("abcé ") for _ in range(400)) for _ in range(3)]
    cut = lambda: pick.choice(base)[(a := pick.randint(0, 300)) : a + pick.randint(10, 160)]
    rows = [(n // 2 if n % 7 == 0 else n, "".join(cut() for _ in range(pick.randint(0, 5)))) for n in range(40)]
    df = documents(spark, [*rows, (None, rows[3][1]), (90, None), (91, ""), (92, "a" * 300), (93, "a" * 200)])
    assert found(df, **how) == brute_force(plain(df), how.get("length", 50))


def test_cases_and_clashing_columns(spark):
    df = documents(spark).withColumn("kept", F.lit(1)).withColumn("n_spans", F.lit("x"))
    assert found(df) == brute_force(plain(df))
    assert set(df.columns) <= set(remove_repeats(df).columns)
    assert remove_repeats(df.limit(0)).count() == 0


def test_text_longer_than_a_piece(spark):
    pick = random.Random(1)
    long = "".join(pick.choice("abcdefgh") for _ in range(1_100_000))
    seam = long[1_048_000:1_049_200]
    got = found(documents(spark, [(1, long), (2, seam)]))
    assert got[1][:4] == (2, 1200, 1200, 1) and got[0][2] == 0


def test_signs_stay_whole(spark):
    df = documents(spark, [(1, "é" * 40), (2, "x" + "é" * 26 + "è" * 30)])
    out = {r["doc_id"]: bytes(r["kept"]).decode() for r in remove_repeats(df, whole_signs=True).collect()}
    assert out == {1: "é" * 40, 2: "x" + "è" * 30}


def test_query_over_the_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = brute_force(plain(docs))
    assert rows_of(op1_suffix_dedup(spark, SMALL), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_loser_trees():
    pick = random.Random(3)
    for _ in range(500):
        runs = [sorted(bytes(pick.choice(b"ab") for _ in range(pick.randint(0, 6))) for _ in range(pick.randint(0, 8))) for _ in range(pick.randint(0, 9))]
        shared = [[0, *(common_prefix(a, b) for a, b in zip(r, r[1:]))] for r in runs]
        out = list(merge_prefixed(runs, shared))
        items = [runs[r][p] for r, p, _ in out]
        assert items == sorted(x for r in runs for x in r) == list(merge_runs(runs, lambda x: x))
        assert [n for *_, n in out[1:]] == [common_prefix(a, b) for a, b in zip(items, items[1:])]


def test_common_anchors_are_sent_in_the_form_of_fewer_entries():
    # documents of an anchor, runs that have it: rare; over HOT, but in so many runs that windows take more; in few runs; too common for a group
    docs, runs = np.array([1, 2, HOT + 1, HOT + 1, GROUP * HOT + 1]), np.array([1, 2, 1500, 50, GROUP * HOT + 1])
    assert _how_sent(docs, runs, 23, HOT).tolist() == [0, 1, 1, 2, 2]


@pytest.mark.parametrize("hot", [0, 1])
def test_window_by_window_like_brute_force(spark, hot):
    pick = random.Random(9)
    line = "".join(pick.choice("abc") for _ in range(70))
    texts = ["".join(pick.choice("xyz") for _ in range(pick.randint(0, 40))) + line[pick.randint(0, 15) :] + "".join(pick.choice("xyz") for _ in range(20)) for _ in range(60)]
    df = documents(spark, list(enumerate(texts)))
    assert found(df, hot=hot, partitions=3, run_bytes=700) == brute_force(plain(df))


def test_pairs_and_windows_say_the_same():
    pick, length = random.Random(4), 12
    for _ in range(300):
        entries = sorted({("aaaaaaa" + "".join(pick.choice("ab") for _ in range(pick.randint(0, 5))), "".join(pick.choice("ab") for _ in range(5))) for _ in range(pick.randint(2, 8))})
        entries = [(s.encode(), l.encode()) for s, l in entries]
        if len(entries) < 2:
            continue
        least = {e: pick.choice([1, 2, 3, LAST_ID]) for e in entries}
        nearest = [0, *(common_prefix(a[0], b[0]) for a, b in zip(entries, entries[1:]))]
        windows = {}
        for (suffix, left), own in least.items():
            for p in range(len(left) + len(suffix) - length + 1):
                windows.setdefault((left + suffix)[p : p + length], []).append((len(left) - p, own))
        bits = {
            (suffix, left): sum(1 << p for p in range(len(left) + len(suffix) - length + 1) if any(at == len(left) - p and i < own for at, i in windows[(left + suffix)[p : p + length]]))
            for (suffix, left), own in least.items()
        }
        assert _by_pairs(least, nearest, length) == _by_windows(least, nearest, length) == bits
