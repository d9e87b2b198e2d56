import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from strata.llm import winnowing
from strata.llm.queries import ORACLES, op12_winnowing
from strata.llm.winnowing import BASE, SPREAD, chosen, fingerprints, likeness, next_likeness, rendered, winnow
from tests.llm.cases import documents, rows_of
from tests.oracle_check import differences, duck

SMALL = "/root/testdata/sf0.001"
ALL = (1 << 64) - 1


def plain_hash(run):
    h = sum((ord(c) + 1) * pow(BASE, j, 1 << 64) for j, c in enumerate(run)) & ALL
    h = (h ^ h >> 32) * SPREAD & ALL
    return (h ^ h >> 29) >> 1


def plain_print(text, gram, window):
    runs = [text[i : i + gram] for i in range(max(1, len(text) - gram + 1))] if text else []
    h = [plain_hash(r) for r in runs]
    places = set()
    for begin in range(1 - window, len(h)) if h else ():
        here = range(max(0, begin), min(len(h), begin + window))
        places.add(max((-h[i], i) for i in here)[1])
    return [(h[i], i) for i in sorted(places)]


def texts_of(seed):
    pick = random.Random(seed)
    for signs in ("ab", "abcdefgh ", "aé日😀 ", "a"):
        for n in (0, 1, 3, 4, 5, 17, 90, 400):
            yield "".join(pick.choice(signs) for _ in range(n))


def test_prints_like_the_definition(monkeypatch):
    monkeypatch.setattr(winnowing, "BLOCK", 64)
    monkeypatch.setattr(winnowing, "_POWERS", [])
    texts = [*texts_of(1), None]
    for gram, window in ((4, 1), (4, 5), (5, 8), (16, 32), (3, 100)):
        found = fingerprints(texts, gram, window)
        assert len(found) == len(texts)
        for text, (h, p) in zip(texts, found):
            assert list(zip(h.tolist(), p.tolist())) == plain_print(text or "", gram, window), (text, gram, window)


def test_ties_go_to_the_rightmost():
    assert chosen(np.array([5, 1, 1, 7, 1, 9]), 3).tolist() == [2, 4]
    assert chosen(np.array([3, 3, 3, 3]), 2).tolist() == [1, 2, 3]


def test_shared_passages_share_a_print_at_matching_places():
    pick, gram, window = random.Random(5), 8, 12
    text = lambda n: "".join(pick.choice("abcdefghij ") for _ in range(n))
    for _ in range(100):
        passage, a, b = text(gram + window - 1), text(pick.randint(0, 60)), text(pick.randint(0, 60))
        left, right = fingerprints([a + passage + text(30), b + passage + text(50)], gram, window)
        at = {(h, p - len(a)) for h, p in zip(*map(np.ndarray.tolist, left))} & {(h, p - len(b)) for h, p in zip(*map(np.ndarray.tolist, right))}
        assert any(0 <= p < window for _, p in at)
        assert max(np.diff(left[1]), default=0) <= window


def test_rendered_holds_hashes_and_places():
    (h, p), = fingerprints(["the quick brown fox jumps over the lazy dog " * 5], 6, 9)
    text = rendered(h, p)
    parts = [text[i : i + 10] for i in range(0, len(text), 10)]
    assert np.cumsum([int(x[:2], 16) for x in parts]).tolist() == p.tolist()
    assert [int(x[2:], 16) for x in parts] == (h & 0xFFFFFFFF).tolist()
    assert rendered(*fingerprints([""])[0]) == ""
    empty = np.empty(0, np.int64)
    assert (likeness(empty, empty), likeness(h, empty), likeness(h, h)) == (1.0, 0.0, 1.0)


def expected(rows):
    order = sorted((i, t or "") for i, t in rows if i is not None)
    follow = list(zip(order, order[1:] + order[:1])) + [((None, t or ""), None) for i, t in rows if i is None]
    out = []
    for (i, t), after in follow:
        n = len(t) // 4
        changed = t[: len(t) - n] + after[1][:n] if after else t
        (own, at), (new, to) = fingerprints([t, changed])
        near = likeness(own, fingerprints([after[1]])[0][0]) if after else None
        out.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), rendered(own, at), rendered(new, to), likeness(own, new), near))
    return sorted(out, key=repr)


NAMES = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def test_cases(spark):
    df = documents(spark).withColumn("fingerprint", F.lit("clash")).withColumn("bucket", F.lit(1))
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    for parts in (1, 3, 50):
        assert rows_of(next_likeness(df, parts=parts), *NAMES) == expected(rows)
    assert next_likeness(df.limit(0)).count() == 0
    assert next_likeness(df.where("doc_id is null")).where("near_next is not null").count() == 0
    one = df.where("doc_id = 3")
    assert rows_of(next_likeness(one), *NAMES) == expected([(r["doc_id"], r["text"]) for r in one.collect()])
    named = df.select(F.concat(F.lit("n"), F.col("doc_id").cast("string")).alias("name"), F.col("text").alias("body"))
    found = next_likeness(named, id_col="name", text_col="body")
    assert rows_of(found, "name", *NAMES[1:]) == expected([tuple(r) for r in named.collect()])


def test_winnow_keeps_positions(spark):
    df = documents(spark)
    found = {(r["doc_id"], tuple(r["hashes"]), tuple(r["positions"])) for r in winnow(df, 5, 8).collect()}
    assert found == {(r["doc_id"], *(tuple(x.tolist()) for x in fingerprints([r["text"]], 5, 8)[0])) for r in df.collect()}


def test_query_like_its_sql(spark):
    assert differences(op12_winnowing(spark, SMALL), ORACLES["op12_winnowing"], duck(SMALL)) == []
