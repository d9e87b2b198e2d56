"""The document pipeline: filters and deduplication before encoding.

``run`` applies ``STAGES`` to the documents, each stage to all that the stage
before it kept. The stages up to the last return the columns of documents:

- toxicity drops rows that score ``TOXIC_FROM`` or more;
- near_dedup keeps, of each class of near copies, the row with the smallest id;
- suffix_dedup cuts out what an earlier document holds, whole UTF-8 signs only,
  and counts n_chars anew; a row stays even if nothing of its text does;
- decontaminate drops rows that hold a benchmark passage;
- encode gives doc_id, n_tokens and ids (little-endian unsigned 32-bit).

Null ids, null or empty texts and repeated rows are treated as the operators'
docstrings say; columns beyond those of documents are passed on up to the last
stage, except those named like suffix_dedup's results.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.bpe import encode_documents
from strata.llm.decontaminate import drop_contaminated
from strata.llm.order_minhash import keep_one
from strata.llm.suffix_dedup import remove_repeats
from strata.llm.support import written
from strata.llm.toxicity import fit_toxicity, held_out, score_toxicity

TOXIC_FROM = 0.7


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(docs, labels.where(~held_out()))
    scored = score_toxicity(docs, model)
    return scored.where(F.col("tox_score") < TOXIC_FROM).drop("tox_score", "tox_evidence")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text = F.decode("kept", "UTF-8")
    cut = remove_repeats(docs, 50, whole_signs=True).withColumn("text", F.when(F.col("n_removed") > 0, text).otherwise(F.col("text")))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

#: No stage has an SQL form; tests hold the pipeline against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        # each stage is evaluated once, whatever the next one reads twice
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
