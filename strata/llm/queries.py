"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from strata.llm.bpe import encode_documents
from strata.llm.decontaminate import find_contamination
from strata.llm.exact_topk import exact_topk
from strata.llm.order_minhash import near_duplicates
from strata.llm.shard_ring import ring_shards
from strata.llm.spelling import damaged_words, spelling_groups
from strata.llm.suffix_dedup import remove_repeats
from strata.llm.support import table, written
from strata.llm.token_alignment import align_tokens, link_scores, pair_counts, vocabulary_size
from strata.llm.token_counts import count_tokens
from strata.llm.toxicity import fit_toxicity, held_out, score_toxicity
from strata.llm.url_filter import UrlRules, judge_urls
from strata.llm.warc import capture_index, read_archives, write_archives
from strata.llm.winnowing import BASE, GRAM, SPREAD, WINDOW, next_likeness
from strata.session import scratch_path

TOXIC_FROM = 0.7
URL_RULES = UrlRules(
    rules=(
        ("allow", "org/"),
        ("block", "example.org/es/"),
        ("block", "example.org/en/1"),
        ("allow", "com/fr/"),
        ("block", "com/de/"),
    )
)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), 50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path, 0)
    # read once: the index samples its keys and then cuts them into ranges
    index = capture_index(written(read_archives(spark, path).drop("payload"), "captures"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "range", "place")


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), digests=True)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ring_shards(table(spark, sf_dir, "documents"), 16)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rules=URL_RULES).drop("strict_hits", "soft_hits")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels").where(~held_out()))
    scored = score_toxicity(docs, model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("tox_score").alias("score"),
        (F.col("tox_score") >= TOXIC_FROM).cast("int").alias("predicted"),
        F.expr("transform(tox_evidence, e -> e.example)").alias("evidence"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(damaged_words(table(spark, sf_dir, "documents")))


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_likeness(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    documents, bitmaps = align_tokens(table(spark, sf_dir, "documents"), *paths)
    return link_scores(documents, bitmaps, pair_counts(bitmaps, vocabulary_size(paths[1]))).withColumnRenamed("id", "doc_id")


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_token_counts, op3_warc_index, op4_bpe_codec, op5_decontaminate, op6_ring_sharding, op7_exact_topk,
        op8_order_minhash, op9_url_filter, op10_toxicity, op11_spelling_variants, op12_winnowing, op13_token_alignment,
    )
}

OP7_SQL = """
WITH vecs AS (
    SELECT vec_id, list_transform(embedding, lambda x : CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM vecs q JOIN vecs c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0 AND len(q.v) = len(c.v)
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# crc32 by its definition: the table of 256 steps, then a step for each byte in UTF-8
OP11_SQL = """
WITH RECURSIVE steps AS (
    SELECT list_transform(range(256), lambda i : list_reduce(range(8),
        lambda c, k : CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00c0-\u00ff]+')) AS run FROM documents
), counted AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word, count(*) AS n
    FROM runs GROUP BY ALL
), hashed AS (
    SELECT word, n, xor(4294967295, list_reduce(flatten(list_transform(string_split(concat(doc_id, ':', word), ''),
        lambda s : CASE WHEN unicode(s) < 128 THEN [unicode(s)] ELSE [192 + unicode(s) // 64, 128 + unicode(s) % 64] END)),
        lambda c, b : xor(c >> 8, t[1 + xor(c, b::BIGINT) % 256]), 4294967295::BIGINT)) AS h
    FROM counted, steps WHERE length(word) >= 5
), damaged AS (
    SELECT CASE WHEN h % 97 = 0 THEN concat(left(word, h % length(word)), substr(word, h % length(word) + 2)) ELSE word END AS word, n
    FROM hashed
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), places AS (
    SELECT word, n, unnest(range(length(word))) AS place FROM words
), less AS (
    SELECT word, n, place, concat(left(word, place), substr(word, place + 2)) AS rest FROM places
), near AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.place = b.place AND length(a.word) = length(b.word) AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, min({'less': -near_n, 'form': near}) AS b FROM near GROUP BY word
), forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 2 * w.n THEN b.form END AS form,
        CASE WHEN -b.less >= 2 * w.n THEN -b.less END AS form_n
    FROM words w LEFT JOIN best ON w.word = best.word
), chain AS (
    SELECT word, word AS here FROM forms
    UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON chain.here = forms.word WHERE forms.form IS NOT NULL
), roots AS (
    SELECT chain.word, chain.here AS root FROM chain JOIN forms ON chain.here = forms.word WHERE forms.form IS NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN roots r ON f.word = r.word
"""

# polynomial hashes modulo 2^64, then the rightmost smallest of every window from either side
OP12_SQL = f"""
WITH own AS (
    SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id, coalesce(text, '')) AS r, count(*) OVER () AS total
    FROM documents WHERE doc_id IS NOT NULL
), pairs AS (
    SELECT a.doc_id, a.r, b.r AS next_r, a.text,
        concat(left(a.text, length(a.text) - length(a.text) // 4), left(b.text, length(a.text) // 4)) AS edited
    FROM own a JOIN own b ON b.r = a.r % a.total + 1
), texts AS (
    SELECT r, 0 AS side, text FROM pairs UNION ALL SELECT r, 1, edited FROM pairs
), letters AS (
    SELECT r, side, length(text) AS size, unnest(range(length(text))) AS p,
        unnest(list_transform(string_split(text, ''), lambda s : unicode(s) + 1))::HUGEINT AS c
    FROM texts WHERE length(text) > 0
), sums AS (
    SELECT r, side, size, p, ({" + ".join(f"lead(c, {j}, 0) OVER w * {pow(BASE, j, 1 << 64)}::HUGEINT" for j in range(GRAM))}) % {1 << 64}::HUGEINT AS h
    FROM letters WINDOW w AS (PARTITION BY r, side ORDER BY p)
), mixed AS (
    SELECT r, side, p, (xor(h::UBIGINT, h::UBIGINT >> 32)::HUGEINT * {SPREAD}) % {1 << 64}::HUGEINT AS h
    FROM sums WHERE p = 0 OR p <= size - {GRAM}
), grams AS (
    SELECT r, side, p, xor(h::UBIGINT, h::UBIGINT >> 29) >> 1 AS h FROM mixed
), mins AS (
    SELECT r, side, p, h,
        min(h::HUGEINT * {1 << 32} + {(1 << 32) - 1} - p) OVER (PARTITION BY r, side ORDER BY p ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS before,
        min(h::HUGEINT * {1 << 32} + {(1 << 32) - 1} - p) OVER (PARTITION BY r, side ORDER BY p ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS behind
    FROM grams
), places AS (
    SELECT DISTINCT r, side, {(1 << 32) - 1} - m % {1 << 32} AS p
    FROM (SELECT r, side, before AS m FROM mins UNION SELECT r, side, behind FROM mins)
), chosen AS (
    SELECT r, side, p, h FROM grams JOIN places USING (r, side, p)
), steps AS (
    SELECT r, side, p, h, p - lag(p, 1, 0) OVER (PARTITION BY r, side ORDER BY p) AS step FROM chosen
), prints AS (
    SELECT r, side, string_agg(printf('%02x%08x', step::INTEGER, (h % {1 << 32})::BIGINT), '' ORDER BY p) AS print FROM steps GROUP BY r, side
), sets AS (
    SELECT DISTINCT r, side, h FROM chosen
), sizes AS (
    SELECT r, side, count(*) AS n FROM sets GROUP BY r, side
), compared AS (
    SELECT r, r AS other, 1 AS side FROM pairs UNION ALL SELECT r, next_r, 0 FROM pairs
), shared AS (
    SELECT c.r, c.other, c.side, count(*) AS n
    FROM compared c JOIN sets a ON a.r = c.r AND a.side = 0 JOIN sets b ON b.r = c.other AND b.side = c.side AND b.h = a.h
    GROUP BY ALL
), likeness AS (
    SELECT c.r, c.other, c.side,
        CASE WHEN coalesce(a.n, 0) + coalesce(b.n, 0) = 0 THEN 1.0::DOUBLE
        ELSE coalesce(s.n, 0)::DOUBLE / (coalesce(a.n, 0) + coalesce(b.n, 0) - coalesce(s.n, 0)) END AS near
    FROM compared c LEFT JOIN sizes a ON a.r = c.r AND a.side = 0
    LEFT JOIN sizes b ON b.r = c.other AND b.side = c.side
    LEFT JOIN shared s ON s.r = c.r AND s.other = c.other AND s.side = c.side
)
SELECT p.doc_id, length(p.text)::BIGINT AS n_chars, sha256(p.edited) AS edited_sha256, coalesce(f.print, '') AS fingerprint,
    coalesce(e.print, '') AS edited_fingerprint, near_edited.near AS near_edited, near_next.near AS near_next
FROM pairs p LEFT JOIN prints f ON f.r = p.r AND f.side = 0 LEFT JOIN prints e ON e.r = p.r AND e.side = 1
JOIN likeness near_edited ON near_edited.r = p.r AND near_edited.side = 1
JOIN likeness near_next ON near_next.r = p.r AND near_next.side = 0
"""

ORACLES = {"op7_exact_topk": OP7_SQL, "op11_spelling_variants": OP11_SQL, "op12_winnowing": OP12_SQL}
