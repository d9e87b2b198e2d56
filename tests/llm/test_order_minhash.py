import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from strata.llm.components import components
from strata.llm.order_minhash import _occurrences, band_keys, common_length, keep_one, near_duplicates, shingle_rows, similarity
from strata.llm.queries import op8_order_minhash
from tests.llm.cases import documents, plain, rows_of

SMALL = "/root/testdata/sf0.001"


def plain_common(a, b):
    before = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
        before = row
    return before[-1]


def brute_force(rows, threshold=0.8):
    """Classes by comparing all texts that share a shingle."""
    members = defaultdict(list)
    for i, t in rows:
        members[t].append(i)
    nodes = [(min((i for i in ids if i is not None), default=None), shingle_rows(t)[0], ids) for t, ids in members.items()]
    root = list(range(len(nodes)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    seen, by_id = defaultdict(set), {}
    for n, (_, row, ids) in enumerate(nodes):
        near = Counter(m for s in set(row) for m in seen[s])
        for m in near:
            other = nodes[m][1]
            common = plain_common(row, other) if near[m] >= 0.5 * max(len(set(row)), len(set(other))) else 0
            if common / (len(row) + len(other) - common) >= threshold - 1e-12:
                root[find(n)] = find(m)
        for s in set(row):
            seen[s].add(n)
        for i in ids:
            if i is not None:
                root[find(n)] = find(by_id.setdefault(i, n))
    least = {}
    for n, (i, _, _) in enumerate(nodes):
        if i is not None:
            least[find(n)] = min(least.get(find(n), i), i)
    return sorted(((i, least.get(find(n)), len(ids)) for n, (_, _, ids) in enumerate(nodes) for i in ids), key=repr)


def edited(pick, words, n):
    words = list(words)
    for _ in range(n):
        words[pick.randrange(len(words))] = f"w{pick.randrange(10**6)}"
    return " ".join(words)


def test_alignment_is_exact_within_the_threshold():
    pick = random.Random(1)
    for _ in range(2000):
        a = [pick.randint(0, 3) for _ in range(pick.randint(1, 14))]
        b = [x for x in a if pick.random() < 0.9] + [5] if pick.random() < 0.5 else [pick.randint(0, 3) for _ in range(pick.randint(1, 14))]
        common = plain_common(a, b)
        assert common_length(a, b, 50) == common
        value = common / (len(a) + len(b) - common)
        assert (similarity(a, b, 0.8) >= 0.8 - 1e-12) == (value >= 0.8 - 1e-12)


def test_sketches_label_occurrences_and_keep_order():
    row, doc = np.array([5, 7, 5, 5, 7], np.uint64), np.array([0, 0, 0, 1, 1])
    assert _occurrences(row, doc).tolist() == [0, 0, 1, 0, 0]
    ahead, moved = np.arange(1, 41, dtype=np.uint64), np.concatenate([np.arange(21, 41), np.arange(1, 21)]).astype(np.uint64)
    same = band_keys(np.concatenate([ahead, ahead]), np.array([0, 40, 80]))
    swapped = band_keys(np.concatenate([ahead, moved]), np.array([0, 40, 80]))
    assert (same[0] == same[1]).all() and (swapped[0] == swapped[1]).mean() < 0.9


def test_cases(spark):
    df = documents(spark).withColumn("class_id", F.lit(0)).withColumn("text_a", F.lit("x"))
    pick = random.Random(2)
    base = [f"v{n}" for n in range(120)]
    more = documents(spark, [(100, " ".join(base)), *((101 + n, edited(pick, base, 1)) for n in range(4)), (110, edited(pick, base, 40)), (100, "a second text of one id"), (111, "a second text of one id")])
    df = df.unionByName(more, allowMissingColumns=True)
    got = near_duplicates(df)
    assert rows_of(got, "doc_id", "class_id", "n_copies") == brute_force(plain(df))
    assert near_duplicates(df.limit(0)).count() == 0


def test_a_large_group_around_one_original(spark):
    """Copies far from each other but near their original are one class, whichever id the original has."""
    pick = random.Random(3)
    base = [f"v{n}" for n in range(150)]
    rows = [(n, edited(pick, base, 2)) for n in range(70)] + [(70, " ".join(base))] + [(71 + n, edited(pick, base, 2)) for n in range(30)]
    rows += [(200 + n, " ".join(f"u{pick.randrange(900)}" for _ in range(80))) for n in range(40)]
    df = documents(spark, rows)
    want = brute_force(plain(df))
    assert rows_of(near_duplicates(df), "doc_id", "class_id", "n_copies") == want
    assert Counter(c for _, c, _ in want)[0] > 90
    kept = {r["doc_id"] for r in keep_one(df).collect()}
    assert kept == {c for _, c, _ in want}


def test_a_large_group_of_texts_too_far_apart(spark):
    """Copies that are candidates of each other but no near copies, among them some pairs that are."""
    pick = random.Random(5)
    base = [f"v{n}" for n in range(150)]
    far = [edited(pick, base, 9) for _ in range(120)]
    near = [edited(pick, text.split(), 1) for text in far[:25]]
    df = documents(spark, list(enumerate(far + near)))
    want = brute_force(plain(df))
    assert 20 <= sum(i != c for i, c, _ in want) <= 40
    assert rows_of(near_duplicates(df), "doc_id", "class_id", "n_copies") == want


def test_a_large_group_with_pairs_at_the_very_threshold(spark):
    """All are candidates of each other and just below the threshold to their original; pairs of 0.802 still link."""
    pick = random.Random(11)
    base = [f"v{n}" for n in range(95)]
    texts = [" ".join(base)]
    for p in range(80):
        at, new = 5 + p % 77, [f"p{p}w{n}" for n in range(8)]
        texts += [" ".join(base[: at + s] + new[s : s + 7] + base[at + s + 7 :]) for s in (0, 1)]
    pick.shuffle(texts)
    rows = [shingle_rows(t)[0] for t in texts]
    alike = sum(similarity(a, b, 0.8) >= 0.8 for n, a in enumerate(rows) for b in rows[:n])
    got = near_duplicates(documents(spark, list(enumerate(texts)))).collect()
    assert alike == 80 and sum(r["doc_id"] != r["class_id"] for r in got) == 80


def test_chains_of_copies_in_a_large_group(spark):
    """Each link of a chain is a near copy of the one before alone; the rest of the bucket is too far apart."""
    pick = random.Random(13)
    base = [f"v{n}" for n in range(95)]
    texts = [edited(pick, base, 7) for _ in range(60)]
    for _ in range(6):
        texts.append(edited(pick, base, 3))
        for _ in range(9):
            texts.append(edited(pick, texts[-1].split(), 2))
    pick.shuffle(texts)
    df = documents(spark, list(enumerate(texts)))
    want = brute_force(plain(df))
    assert max(Counter(c for _, c, _ in want).values()) >= 10
    assert rows_of(near_duplicates(df), "doc_id", "class_id", "n_copies") == want


def test_components(spark):
    edges = [(n, n + 1) for n in range(1, 30)] + [(50, n) for n in range(60, 90)] + [(95, 95)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{n: 1 for n in range(1, 31)}, 50: 50, **{n: 50 for n in range(60, 90)}, 95: 95}


def test_query_over_the_whole_table(spark):
    rows = plain(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert rows_of(op8_order_minhash(spark, SMALL), "doc_id", "class_id", "n_copies") == brute_force(rows)
