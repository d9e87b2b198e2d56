"""Exact top-k search by inner product, in tiles of queries and candidates.

Vectors become integers, floor(scale * x). Candidates are dealt into shards and
queries into blocks; each tile (shard, block) is one matrix product, of which
only the k best of every query leave the task. These partial lists are merged
in a tree, ``FAN`` lists at a time, so no task sees more than FAN x k of one
query's rows.

Defined cases: a row whose vector or id is null, whose vector is empty or holds
a null or non-finite component takes no part; vectors of another length score
nothing together; rows with an equal id count once, with the smallest vector;
ties go to the smaller id; no query or no candidate gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.support import written

FAN = 8
_PARTIAL = "query_id long, node long, vec_id long, score long"


def _matrix(rows: pa.Table, name: str) -> np.ndarray:
    values = rows[name].combine_chunks()
    flat = (values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values).flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(rows), -1)


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products: doubles while every sum stays below 2**53, else Python integers."""
    bound = float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1]
    if bound < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return (q.astype(object) @ c.astype(object).T).astype(np.int64)


def _tile(k: int):
    def best(cands: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query_id": [], "node": [], "vec_id": [], "score": []}
        if len(cands) and len(queries):
            node = cands["shard"][0].as_py()
            cands = cands.sort_by("vec_id")
            ids, qids = cands["vec_id"].to_numpy(), queries["q_id"].to_numpy()
            c, q = _matrix(cands, "vec"), _matrix(queries, "q_vec")
            for at in range(0, len(qids), 256):
                scores = _products(q[at : at + 256], c)
                for row, qid in zip(scores, qids[at : at + 256]):
                    # candidates are in order of id, so a stable sort settles ties
                    keep = min(k + 1, len(row))
                    floor = np.partition(row, len(row) - keep)[len(row) - keep]
                    found = np.flatnonzero(row >= floor)
                    found = found[np.argsort(-row[found], kind="stable")]
                    found = found[ids[found] != qid][:k]
                    out["query_id"].append(np.full(len(found), qid))
                    out["vec_id"].append(ids[found])
                    out["score"].append(row[found])
            out = {n: np.concatenate(v) if v else np.empty(0, np.int64) for n, v in out.items() if n != "node"}
            out["node"] = np.full(len(out["vec_id"]), node)
        return pa.table({n: pa.array(out[n], pa.int64()) for n in ("query_id", "node", "vec_id", "score")})

    return best


def exact_topk(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = 4096,
    query_rows: int = 4096,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every query row."""
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = (
        df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("raw"), F.coalesce(is_query, F.lit(False)).alias("asks"))
        .where(F.col("vec_id").isNotNull() & (F.size("raw") > 0) & finite)
        .select("vec_id", "asks", F.transform("raw", lambda x: F.floor(x.cast("double") * scale)).alias("vec"))
        .groupBy("vec_id")
        .agg(F.min(F.struct("vec", "asks")).alias("one"))
        .select("vec_id", F.size("one.vec").alias("dim"), "one.vec", "one.asks")
    )
    rows = written(rows, "topk-vectors")
    n, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(asked / query_rows))

    cands = rows.select(
        "vec_id", "vec", "dim",
        F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    queries = rows.where("asks").select(
        F.col("vec_id").alias("q_id"), F.col("vec").alias("q_vec"), F.col("dim").alias("q_dim"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("q_shard"),
        F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(blocks)).cast("int").alias("q_block"),
    )
    lists = (
        cands.groupBy("dim", "shard", "block")
        .cogroup(queries.groupBy("q_dim", "q_shard", "q_block"))
        .applyInArrow(_tile(k), _PARTIAL)
    )
    while True:
        # every level merges the lists of FAN neighbouring nodes
        shards = math.ceil(shards / FAN)
        item = F.struct((-F.col("score")).alias("neg"), "vec_id")
        lists = (
            lists.groupBy("query_id", F.floor(F.col("node") / FAN).alias("node"))
            .agg(F.slice(F.array_sort(F.collect_list(item)), 1, k).alias("best"))
        )
        if shards <= 1:
            break
        lists = lists.select("query_id", "node", F.explode("best").alias("b")).select(
            "query_id", "node", "b.vec_id", (-F.col("b.neg")).alias("score")
        )
    return lists.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "b.vec_id", (-F.col("b.neg")).alias("score")
    )
