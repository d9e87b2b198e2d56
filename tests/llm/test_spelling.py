import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import spelling
from strata.llm.queries import ORACLES, op11_spelling_variants
from strata.llm.spelling import RUNS, Trie, damaged_words, lowered, near_words, spelling_groups
from tests.llm.cases import documents, rows_of
from tests.oracle_check import differences, duck

SMALL = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(words, ratio=2):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(((-words[x], x) for x in others), default=None)
        form[w] = best[1] if best and -best[0] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def vocabulary(seed, signs="abeèß", n=300, most=9):
    pick = random.Random(seed)
    words = {"".join(pick.choice(signs) for _ in range(pick.randint(1, most))): pick.randint(1, 200) for _ in range(n)}
    for w in list(words)[:60]:
        at = pick.randrange(len(w))
        words[w[:at] + pick.choice(signs) + w[at:]] = pick.randint(1, 9)
    return words


def frame(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


@pytest.mark.parametrize("part,crowd", [(16384, 64), (8, 64), (40, 0)])
def test_groups_like_brute_force(spark, monkeypatch, part, crowd):
    monkeypatch.setattr(spelling, "PART", part)
    monkeypatch.setattr(spelling, "CROWD", crowd)
    for seed, signs in ((1, "abeèß"), (2, "ab"), (3, "zyxwvu")):
        words = vocabulary(seed, signs)
        assert rows_of(spelling_groups(frame(spark, words)), *COLUMNS) == plain_groups(words)


def test_trie_finds_every_pair_once_from_the_shorter_word(monkeypatch):
    monkeypatch.setattr(spelling, "STATES", 7)
    monkeypatch.setattr(spelling, "LETTERS", 16)
    words = list(vocabulary(4)) + ["x" * 3000, "x" * 2999, "x" * 1500 + "y" + "x" * 1499]
    trie = Trie(words)
    found = Counter((words[x], trie.words[y]) for x, y in trie.near(words))
    assert found == Counter((a, b) for a in words for b in words if len(a) <= len(b) and one_edit(a, b))
    assert list(Trie(["abc"]).near([])) == []


def test_a_large_leaf_is_not_compared_pair_by_pair():
    pick = random.Random(6)
    letters = list("abcdefghijkl")
    words = {"".join(pick.sample(letters, len(letters))) for _ in range(3000)}  # one frequency vector
    words |= {w[:3] + "a" + w[4:] for w in list(words)[:200]}
    words = sorted(words)
    counted = []
    true = spelling._verified
    try:
        spelling._verified = lambda own, theirs, x, y, longer: (counted.append(len(x)), true(own, theirs, x, y, longer))[1]
        trie = Trie(words)
        found = {(words[x], trie.words[y]) for x, y in trie.near(words)}
    finally:
        spelling._verified = true
    by = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            by[w[:i], w[i + 1 :]].add(w)
    assert found == {(a, b) for same in by.values() for a in same for b in same if a != b}
    crowded = 3000**2  # what the pairs of the large leaf alone would be
    assert sum(counted) < 0.1 * crowded


def test_parts_hold_a_bounded_number_of_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PART", 50)
    words = vocabulary(8, "aeinsrtolud", 2000, 12)
    held = []
    true = spelling._part_numbers
    # the words of each part, as they are dealt out by as many top levels as are needed
    vectors = spelling.vectors(list(words))
    for top in range(2, len(spelling.GROUPS) + 1):
        most = max(Counter(map(tuple, vectors[:, : top + 1].tolist())).values())
        if most <= 50:
            held = Counter(true(vectors[:, : top + 1], -(-2 * len(words) // 50)).tolist())
            break
    assert held and max(held.values()) <= 4 * 50
    pairs = near_words(frame(spark, words))
    assert pairs.count() == sum(one_edit(a, b) for a in words for b in words)


def test_cases(spark):
    assert spelling_groups(frame(spark, {}).limit(0)).count() == 0
    assert damaged_words(documents(spark).limit(0)).count() == 0
    df = documents(spark).withColumn("word", F.lit("clash")).withColumn("n", F.lit(0))
    total = Counter()
    for r in df.collect():
        for run in RUNS.findall(r["text"] or ""):
            word = lowered(run)
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{word}".encode())
            if h % 7 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= 4:
                total[word] += 1
    expected = sorted((w, n) for w, n in total.items() if n >= 2)
    assert rows_of(damaged_words(df, 7, 4, 2), "word", "n") == sorted(expected, key=repr)
    assert lowered("ÀÉABZé") == "ÀÉabzé" and lowered("ABC") == "abc"


def test_ties_and_chains(spark):
    words = {"color": 100, "colour": 100, "colou": 10, "colouu": 50, "collour": 2, "co": 1}
    got = {r[0]: r[1:] for r in rows_of(spelling_groups(frame(spark, words)), *COLUMNS)}
    assert got["colou"] == ("color", "color", 10, 3, 100)  # color and colour tie: the smaller word
    assert got["colouu"][:2] == ("colour", "colour") and got["color"][0] is None
    assert got["collour"] == ("colour", "colour", 2, 1, 100) and got["co"][3] == 0
    long = {"aaaaaaa" + "b" * k: 2 ** (k + 1) for k in range(9)}
    got = {r[0]: r[2] for r in rows_of(spelling_groups(frame(spark, long)), *COLUMNS)}
    assert set(got.values()) == {"aaaaaaa" + "b" * 8}


def test_vectors_count_every_letter():
    rows = spelling.vectors(["ea", "zé×", ""])
    assert rows[:, 0].tolist() == [2, 3, 0] and np.array_equal(rows[:, 1:].sum(1), rows[:, 0])


def test_query_like_its_sql(spark):
    assert differences(op11_spelling_variants(spark, SMALL), ORACLES["op11_spelling_variants"], duck(SMALL)) == []
