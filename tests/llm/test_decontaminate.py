import re
import time
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from strata.llm.decontaminate import ItemIndex, _best_window, _covering, _matches, drop_contaminated, find_contamination, similarity
from strata.llm.queries import op5_decontaminate
from strata.llm.support import words_of
from tests.llm.cases import documents, plain, rows_of

SMALL = "/root/testdata/sf0.001"
words = lambda text: re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower())


def brute_force(docs, items, threshold=0.8):
    out = []
    for i, text in docs:
        w = words(text)
        for item, wanted in items:
            v = words(wanted or "")
            if not v or not w:
                continue
            k = min(5, len(v))
            cut = lambda x, k=k: [tuple(x[a : a + k]) for a in range(max(1, len(x) - k + 1))]
            n, own, want = max(1, min(len(v), len(w)) - k + 1), cut(w), Counter(cut(v))
            best = max((similarity(Counter(own[a : a + n]), want) for a in range(len(own) - n + 1)), default=0)
            if best >= threshold:
                out.append((i, item, round(best, 9)))
    return sorted(out, key=repr)


def found(docs, items, **how):
    return sorted(((r[0], r[1], round(r[2], 9)) for r in find_contamination(docs, items, **how).collect()), key=repr)


def test_like_brute_force_and_edits(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    w = item.split()
    edited = " ".join([*w[:19], "other"])
    far = " ".join([*w[:8], "a", "b", "c", *w[12:]])
    docs = documents(spark, [
        (1, "noise " * 9 + item + " noise" * 5), (2, edited.upper() + "!"), (3, far), (4, None), (5, ""), (6, "Yes, indeed"), (7, "plain text without any of it"),
        (8, " ".join(w[:18])), (None, item), (9, item), (9, item),
    ])
    items = [(10, item), (11, "yes indeed"), (12, None), (13, ""), (14, item), (15, "..")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    want = brute_force(plain(docs), items)
    assert found(docs, table) == want and len(want) > 8
    assert found(docs, table, item_block_bytes=1) == want
    hit = {i for i, *_ in want}
    stays = rows_of(drop_contaminated(docs, table, item_block_bytes=1), "doc_id")
    assert stays == sorted([(i,) for i, _ in plain(docs) if i not in hit], key=repr)
    assert drop_contaminated(docs, table).columns == docs.columns


def test_empty_tables(spark):
    docs, none = documents(spark), spark.createDataFrame([], "item_id long, text string")
    assert find_contamination(docs, none).count() == 0 and drop_contaminated(docs, none).count() == docs.count()
    assert find_contamination(docs.limit(0), none).count() == 0


def test_blocks_find_all_within_the_radius():
    pick = np.random.default_rng(1)
    index = ItemIndex([], [], [], *[np.empty(0)] * 3, pick.integers(0, 1 << 63, 40, dtype=np.uint64), {})
    flips = pick.integers(0, 64, (3000, 30))
    prints = index.prints[pick.integers(0, 40, 3000)]
    for n in range(30):
        prints = np.where(pick.random(3000) < 0.7, prints ^ (np.uint64(1) << flips[:, n].astype(np.uint64)), prints)
    for radius in (3, 10, 23):
        near = np.bitwise_count(prints[:, None] ^ index.prints[None, :]) <= radius
        at, item = index.within(prints, np.arange(40), radius)
        assert set(zip(at.tolist(), item.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(near))))


def test_query_over_the_whole_table(spark):
    docs = plain(spark.read.parquet(f"{SMALL}/documents.parquet"))
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    shingles = defaultdict(list)
    for item in items:
        v = words(item[1])
        for a in range(max(1, len(v) - 4)):
            shingles[tuple(v[a : a + 5])].append(item)
    want = []
    for doc in docs:
        w = words(doc[1])
        near = {i for a in range(max(1, len(w) - 4)) for i in shingles.get(tuple(w[a : a + 5]), ())}
        want += brute_force([doc], near)
    got = sorted(((r[0], r[1], round(r[2], 9)) for r in op5_decontaminate(spark, SMALL).collect()), key=repr)
    assert got == sorted(want, key=repr) and got


def test_no_pair_of_texts_that_repeat_themselves_is_lost():
    pick = np.random.default_rng(7)
    lost, total = 0, 0
    for _ in range(1500):
        period, n = int(pick.integers(2, 5)), int(pick.integers(30, 61))
        base = [f"w{k}" for k in range(period)]
        item = [base[k % period] for k in range(n)]
        text = list(item)
        for _ in range(int(pick.integers(0, 3))):
            text[int(pick.integers(0, n))] = f"x{pick.integers(0, 9)}"
        index = ItemIndex.of([(1, " ".join(item))])
        own, want = words(" ".join(text)), Counter(tuple(item[a : a + 5]) for a in range(n - 4))
        true = similarity(Counter(tuple(own[a : a + 5]) for a in range(n - 4)), want)
        got = _matches(index, words_of([" ".join(text)])[0], 23, 0.8)
        total += true >= 0.8
        lost += true >= 0.8 and not (0 in got and abs(got[0][0] - true) < 1e-9)
    assert total > 700 and lost == 0


def test_sliding_counts_are_the_windows_counts():
    pick = np.random.default_rng(8)
    for _ in range(300):
        own, n = pick.integers(0, 6, 80).tolist(), int(pick.integers(1, 20))
        wanted = Counter(pick.integers(0, 6, int(pick.integers(1, 25))).tolist())
        begins = np.flatnonzero(pick.random(81 - n) < pick.choice([0.05, 0.5, 1.0])).tolist()
        true = [similarity(Counter(own[b : b + n]), wanted) for b in begins]
        value, begin = _best_window(own, begins, n, wanted)
        assert abs(value - max(true, default=0)) < 1e-12
        assert not value or begin == begins[true.index(max(true))]


def test_windows_around_places():
    pick = np.random.default_rng(9)
    for _ in range(200):
        n, count = int(pick.integers(1, 12)), int(pick.integers(1, 50))
        places = np.unique(pick.integers(0, count + n - 1, int(pick.integers(0, 9))))
        want = [b for b in range(count) if any(b <= p < b + n for p in places)]
        assert _covering(places, n, count).tolist() == want


def test_long_texts_and_many_items_that_share_a_phrase():
    pick = np.random.default_rng(10)
    word = lambda n: [f"v{k}" for k in pick.integers(0, 5000, n)]
    phrase = word(12)
    items = [(k, " ".join([*word(194), *phrase, *word(194)])) for k in range(200)]
    index = ItemIndex.of(items)
    text = word(20_000)
    for at in range(0, 20_000, 400):
        text[at : at + 12] = phrase
    text[6000:6400] = items[17][1].split()
    tracemalloc.start()
    begin = time.monotonic()
    got = _matches(index, words_of([" ".join(text)])[0], 23, 0.8)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert list(got) == [17] and got[17] == (1.0, 6000)
    assert most < 1 << 29 and time.monotonic() - begin < 120
