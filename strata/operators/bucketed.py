"""Changes merged into a table that is stored in buckets of its key.

The target is read once and not shuffled: its buckets meet the changes, which
are summed up to one row a key and dealt into the same buckets. The result is
written in the same buckets, so the next merge finds it as this one did.
Inserts look for their key in what was just written and not in the target.

The rules are those of ``merge.tag_changes``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.fixed import DELETE, INSERT, UPDATE
from strata.operators.merge import ACTION, DELETED, INSERTED, KEPT, MERGE_ACTIONS, UPDATED

#: Whether the changes name the key of a row with an insert.
WANTED = "_wanted"


def store_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int, mode: str = "error") -> None:
    """Write a table in buckets of its keys, one file a bucket."""
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", path).saveAsTable(table)


def joined_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str], buckets: int, op_col: str = "change_type") -> DataFrame:
    """Rows of a target in ``buckets`` after updates and deletes, tagged, and whether an insert wants their key."""
    keys = list(keys)
    columns = [c for c in target.columns if c not in keys]
    op = F.col(op_col)
    acting = op.isin(UPDATE, DELETE)
    summary = changes.filter(acting | (op == INSERT)).groupBy(*keys).agg(
        F.count_if(acting).alias("_n"),
        F.first(F.when(acting, F.struct(op.alias("_op"), *columns)), ignorenulls=True).alias("_change"),
        F.bool_or(op == INSERT).alias(WANTED),
    )
    too_many = F.raise_error(F.lit("more than one update or delete meets the same target row"))
    action = (
        F.when(F.coalesce("_n", F.lit(0)) == 0, KEPT)
        .when(F.col("_n") > 1, too_many.cast("string"))
        .when(F.col("_change._op") == UPDATE, UPDATED)
        .otherwise(DELETED)
    )
    # one row a key, dealt as the target is: else Spark may shuffle the target to the session's number of partitions,
    # and the merge join keeps the target in its buckets whatever the size of the changes
    summary = summary.repartition(buckets, *keys).hint("merge")
    met = target.join(summary, keys, "left").withColumn(ACTION, action)
    changed = [F.when(F.col(ACTION) == UPDATED, F.col("_change")[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns]
    return met.select(*changed, ACTION, F.coalesce(WANTED, F.lit(False)).alias(WANTED))


def merge_bucketed(
    spark: SparkSession, view: str, changes: DataFrame, keys: Sequence[str], path: str, buckets: int, op_col: str = "change_type"
) -> str:
    """Merge changes into the bucketed rows behind ``view`` and point the view at the result; its table.

    The result lies in a new folder below ``path`` and is shown only when it is
    complete, so a merge that broke changes nothing.
    """
    target = spark.table(view)
    fresh = f"{view}__{uuid.uuid4().hex}"
    place = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    held = joined_changes(target, changes, keys, buckets, op_col)
    # the join leaves the rows in their buckets: nothing is dealt out anew
    held.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", place).saveAsTable(fresh)
    taken = spark.table(fresh).filter(WANTED).select(*keys).distinct()
    inserts = changes.filter(F.col(op_col) == INSERT).select(*target.columns).join(taken, list(keys), "left_anti")
    inserts = inserts.select(*target.columns, F.lit(INSERTED).alias(ACTION), F.lit(True).alias(WANTED))
    store_bucketed(inserts, fresh, place, keys, buckets, "append")
    show_bucketed(spark, view, fresh, target.columns)
    return fresh


def show_bucketed(spark: SparkSession, view: str, table: str, columns: Sequence[str]) -> None:
    """Let ``view`` show the rows of a merged table that were not deleted."""
    names = ", ".join(f"`{c}`" for c in columns)
    deleted = f" WHERE {ACTION} <> '{DELETED}'" if ACTION in spark.table(table).columns else ""
    spark.sql(f"CREATE OR REPLACE VIEW `{view}` AS SELECT {names} FROM `{table}`{deleted}")


def bucketed_metrics(merged: DataFrame) -> DataFrame:
    """Rows kept, updated, deleted and inserted by the merge that wrote a table, also those that are 0."""
    counts = merged.agg(*[F.count_if(F.col(ACTION) == a).alias(a) for a in MERGE_ACTIONS])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(a).alias("action"), F.col(a).alias("n_rows")) for a in MERGE_ACTIONS])))
