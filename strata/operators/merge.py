"""Apply a set of inserts, updates and deletes to a table.

The rules are those of an SQL ``MERGE`` with the clauses "matched and update",
"matched and delete", "not matched and insert"; other changes do nothing. A
target row that more than one update or delete meets is an error. Null keys
match nothing.

The target is the left side of a left join and never of a full outer join: so
small change sets are broadcast when Spark sees that they are small and the
target is not shuffled at all, and a hot key of a large target can be split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.fixed import DELETE, INSERT, UPDATE

ACTION = "_action"
KEPT, UPDATED, DELETED, INSERTED = "kept", "updated", "deleted", "inserted"
MERGE_ACTIONS = (KEPT, UPDATED, DELETED, INSERTED)


def tag_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    op_col: str = "change_type",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of the target, with changes applied, and new rows, tagged with ``_action``.

    ``columns`` are set on update; by default all but the keys. Deleted rows
    are still there, tagged as deleted, so that they can be counted.
    """
    keys = list(keys)
    columns = [c for c in target.columns if c not in keys] if columns is None else list(columns)
    op = F.col(op_col)

    # Both groupings below are by the keys as one struct. Grouping by the bare
    # keys would share its shuffle with the join beside it, and Spark splits a
    # hot target key only in a join whose sides have shuffles of their own. The
    # price is one more shuffle of the changes, and only if they are large.
    whole_key = F.struct(*keys).alias("_key")

    acting = (
        changes.filter(op.isin(UPDATE, DELETE))
        .groupBy(whole_key)
        .agg(
            F.count("*").alias("_n"),
            F.first(F.struct(op.alias("_op"), *columns)).alias("_change"),
        )
        .select("_key.*", "_n", "_change")
    )
    too_many = F.raise_error(F.lit("more than one update or delete meets the same target row"))
    action = (
        F.when(F.col("_n").isNull(), KEPT)
        .when(F.col("_n") > 1, too_many.cast("string"))
        .when(F.col("_change._op") == UPDATE, UPDATED)
        .otherwise(DELETED)
    )
    present = target.join(acting, keys, "left").withColumn(ACTION, action)
    present = present.select(
        *[
            F.when(F.col(ACTION) == UPDATED, F.col("_change")[c]).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in target.columns
        ],
        ACTION,
    )

    inserts = changes.filter(op == INSERT)
    taken = (
        target.join(inserts.select(*keys), keys, "left_semi")
        .groupBy(whole_key)
        .agg(F.count("*").alias("_rows"))
        .select("_key.*")
    )
    fresh = inserts.join(taken, keys, "left_anti").select(
        *[F.col(c) for c in target.columns], F.lit(INSERTED).alias(ACTION)
    )
    return present.unionByName(fresh)


def without_deleted(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(ACTION) != DELETED).drop(ACTION)


def merge_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    op_col: str = "change_type",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The target after the changes."""
    return without_deleted(tag_changes(target, changes, keys, op_col, columns))


def merge_metrics(tagged: DataFrame) -> DataFrame:
    """Rows kept, updated, deleted and inserted, also those that are 0."""
    counts = tagged.agg(
        *[F.count_if(F.col(ACTION) == a).alias(a) for a in MERGE_ACTIONS]
    )
    return counts.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(a).alias("action"), F.col(a).alias("n_rows")) for a in MERGE_ACTIONS]
            )
        )
    )
