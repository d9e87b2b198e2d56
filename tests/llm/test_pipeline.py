import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from strata.llm.toxicity import fit_toxicity, held_out, score_toxicity
from tests.llm import test_decontaminate, test_order_minhash
from tests.llm.cases import documents, plain, rows_of

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def cut_repeats(rows, length=50):
    """Plain version of the third stage, whole signs only."""
    first = {}
    for i, t in rows:
        b = t.encode()
        for p in range(len(b) - length + 1):
            first[b[p : p + length]] = min(first.get(b[p : p + length], i), i)
    out = []
    for i, t in rows:
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        at, kept = 0, []
        for sign in t:
            n = len(sign.encode())
            if not all(gone[at : at + n]):
                kept.append(sign)
            at += n
        out.append((i, "".join(kept)))
    return out


def test_run_like_plain_versions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where(~held_out())
    bad = {r["doc_id"] for r in score_toxicity(docs, fit_toxicity(docs, labels)).where("tox_score >= 0.7").collect()}
    rows = [(i, t) for i, t in plain(docs) if i not in bad]
    kept = {i for i, c, _ in test_order_minhash.brute_force(rows) if i == c}
    rows = cut_repeats([(i, t) for i, t in rows if i in kept])
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {i for i, *_ in test_decontaminate.brute_force(rows, items)}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((i, library.encode(t, add_special_tokens=False).ids) for i, t in rows if i not in hit)
    got = sorted((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert got == want and 0 < len(got) < docs.count()


def test_stages_on_odd_rows(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert name == "encode" or out.columns == COLUMNS
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
        more = stage(spark, docs.withColumn("root", F.lit(1)).withColumn("item_id", F.lit("x")), FOLDER)
        assert rows_of(more, "doc_id") == rows_of(out, "doc_id")
