import resource
import zlib

import numpy as np
from pyspark.sql import functions as F

from strata.llm import toxicity
from strata.llm.queries import op10_toxicity
from strata.llm.support import words_of
from strata.llm.toxicity import ToxicityModel, document_frequencies, fit_toxicity, score_toxicity
from tests.llm.cases import documents, rows_of

FOLDER = "/root/testdata/sf0.01"


def test_nearest_examples_are_exact():
    pick = np.random.default_rng(1)
    model = ToxicityModel(terms=np.sort(words_of(["a b c d e f g h"])[0]), k=7)
    model.labels, model.idf = pick.integers(0, 2, 500).astype(float), pick.random(9) + 0.5
    texts = [" ".join(pick.choice(list("abcdefghxyz"), pick.integers(1, 12))) for _ in range(500)]
    rows, terms, weights = model.vectors(texts)
    model.index(rows, terms, weights)
    full = np.zeros((500, 9))
    full[rows, terms] = weights
    for i in range(0, 500, 7):
        own = full[i].nonzero()[0]
        found, near = model.nearest(own, full[i, own])
        cosine = full @ full[i]
        order = np.lexsort((np.arange(500), -cosine.round(12)))[:7]
        assert np.allclose(np.sort(near), np.sort(cosine[order])) and np.allclose(near, cosine[found])


def test_document_frequencies_cover_all_rows(spark):
    df = documents(spark, [(1, "a b a"), (2, "A, c"), (3, None), (4, ""), (4, "b")]).select("text")
    terms = np.sort(words_of(["a b z"])[0])
    counts = dict(zip(terms.tolist(), document_frequencies(df, terms).tolist()))
    assert [counts[h] for h in words_of(["a b z"])[0].tolist()] == [2, 2, 0]
    assert document_frequencies(df, terms)[-1] == 5


def labelled(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int, toxic int")


def test_cases(spark):
    bad, good = "you utter idiot and moron in some plain words", "some plain words about the weather and more"
    rows = [(n, (bad if n % 3 == 0 else good) + f" number{n}") for n in range(120)]
    df = documents(spark, [*rows, (200, None), (201, ""), (202, bad * 300), (None, bad), (203, bad), (203, bad), (204, "!?")])
    labels = labelled(spark, [*((n, 1, int(n % 3 == 0)) for n in range(100)), (None, 1, 1), (5, None, None), (0, 0, 1), (0, 0, 0), (777, 1, 1)])
    df = df.withColumn("tox_score", F.lit("clash")).withColumn("toxic", F.lit(1))
    model = fit_toxicity(df, labels)
    scored = score_toxicity(df, model).collect()
    assert len(scored) == df.count()
    for r in scored:
        assert 0 <= r["tox_score"] <= 1
        assert (r["tox_score"] >= 0.7) == ("idiot" in (r["text"] or ""))
    hit = next(r for r in scored if r["doc_id"] == 3)
    assert hit["tox_evidence"][0]["toxic"] == 1 and hit["tox_evidence"][0]["cosine"] > 0.5
    assert score_toxicity(df.limit(0), model).count() == 0


def test_a_copy_of_an_example_without_telling_words(spark):
    bad, good = "you utter idiot and moron in some plain words", "some plain words about the weather and more"
    rows = [(n, (bad if n % 3 == 0 else good) + f" number{n}") for n in range(120)]
    rows += [(400 + n, " ".join(f"u{n}x{m}" for m in range(8))) for n in range(40)]
    rows += [(i, "zorp quux blarg fnord wibble flarn") for i in (500, 501)]
    df = documents(spark, rows)
    labels = labelled(spark, [*((n, 1, int(n % 3 == 0)) for n in range(120)), *((400 + n, 1, 0) for n in range(40)), (500, 0, 1)])
    scored = {r["doc_id"]: r for r in score_toxicity(df, fit_toxicity(df, labels)).collect()}
    first = scored[501]["tox_evidence"][0]
    assert first["example"] == 500 and first["toxic"] == 1 and abs(first["cosine"] - 1) < 1e-9
    assert scored[501]["tox_score"] > scored[400]["tox_score"]


def test_labels_of_one_class_or_none(spark):
    df = documents(spark)
    for pairs, score in (([(n, 1, 0) for n in range(9)], 0.0), ([(n, 1, 1) for n in range(9)], 1.0), ([], 0.0), ([(n, 1, n % 2) for n in range(900, 909)], None)):
        model = fit_toxicity(df, labelled(spark, pairs))
        scores = {round(r["tox_score"], 6) for r in score_toxicity(df, model).collect()}
        assert len(scores) == 1 and (score is None or scores == {score})
    assert fit_toxicity(df.limit(0), labelled(spark, [(1, 1, 1), (2, 1, 0)])).score(0.0) == 0.5


def test_query_on_held_out_rows(spark):
    got = op10_toxicity(spark, FOLDER)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)
    assert sum(a == b for a, b in held) / len(held) > 0.9
    clean = [b for a, b in held if a == 0]
    assert sum(clean) / len(clean) < 0.03


def test_result_does_not_depend_on_rows_order(spark):
    df, labels = documents(spark), labelled(spark, [(n, 1, n % 2) for n in range(30)])
    one = score_toxicity(df, fit_toxicity(df, labels))
    two = score_toxicity(df.repartition(5), fit_toxicity(df.repartition(5), labels.repartition(3)))
    assert rows_of(one.withColumn("s", F.round("tox_score", 9)), "doc_id", "s") == rows_of(two.withColumn("s", F.round("tox_score", 9)), "doc_id", "s")


def test_slices_of_texts_find_what_brute_force_finds_in_few_blocks(monkeypatch):
    monkeypatch.setattr(toxicity, "CELLS", 1 << 14)
    pick = np.random.default_rng(4)
    words = [[f"{lang}{n}" for n in range(300)] for lang in "abcd"]
    share = 1 / np.arange(1, 301)
    text = lambda lang, n: " ".join(pick.choice(words[lang], n, p=share / share.sum())) + (" vile" if pick.random() < 0.3 else "")
    examples = [text(k % 4, pick.integers(1, 120)) for k in range(1500)]
    model = ToxicityModel(terms=np.unique(words_of(examples)[0]), k=15, labels=pick.integers(0, 2, 1500).astype(float))
    model.idf = np.append(pick.random(len(model.terms)) + 0.5, 1.0)
    model.telling = np.isin(np.append(model.terms, 0), words_of(["vile"])[0])
    rows, terms, weights = model.vectors(examples)
    model.index(rows, terms, weights)
    full = np.zeros((1500, len(model.terms) + 1))
    full[rows, terms] = weights
    asked = [text(k % 4, pick.integers(1, 200)) for k in range(300)] + ["", None, "unheard of", examples[7]]
    own = model.vectors(asked)
    but = np.full(len(asked), -1)
    but[-1] = 7
    found, near, visits = model.nearest_to_each(*own, len(asked), but)
    ask = np.zeros((len(asked), full.shape[1]))
    ask[own[0], own[1]] = own[2]
    cosine = ask @ full.T
    cosine[-1, 7] = 0
    for i in range(len(asked)):
        order = np.lexsort((np.arange(1500), -cosine[i].round(12)))[:15]
        true = np.where(cosine[i][order] > 1e-12, cosine[i][order], 0)
        assert np.allclose(near[i], true), i
        assert all(f < 0 or abs(cosine[i, f] - s) < 1e-9 for f, s in zip(found[i], near[i]))
    blocks = -(-1500 // toxicity.BLOCK)
    assert visits.mean() < blocks / 3
    assert model.votes(found, near)[300:303].tolist() == [0, 0, 0]


def test_large_examples_stay_off_the_driver(spark):
    words = F.transform(F.sequence(F.lit(0), F.lit(2300)), lambda k: F.concat(F.lit("w"), F.pmod(F.xxhash64(F.col("id"), k), F.lit(40_000)).cast("string")))
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.substring(F.concat_ws(" ", F.when(F.col("id") % 2 == 0, "vile"), F.array_join(F.flatten(F.array(words, words)), " ")), 1, 32768).alias("text"))
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2 == 0).cast("int").alias("toxic"))
    assert df.agg(F.max(F.octet_length("text"))).first()[0] > 30_000
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    model = fit_toxicity(df, labels)
    assert len(model.ids) == 3000
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 500
