"""Change sets that arrive as a stream, merged into a table in their order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.merge import ACTION, DELETED, INSERTED, KEPT, UPDATED, tag_changes
from strata.sources.versions import GONE, STEP, KeyedLog
from strata.streaming.ingest import BATCH, run_batches

#: Column of a change log that says what was done to a row.
NOTES = f"{ACTION} STRING"


def start_table(target: KeyedLog, rows: DataFrame) -> None:
    """First step of a table that has no rows yet; does nothing on a table that was started."""
    if target.next_step() == 0:
        target.append(rows.withColumn(ACTION, F.lit(None).cast("string")), 0, "start")


def merge_delivery(target: KeyedLog, part: DataFrame, origin: str, delivery: int, keys: Sequence[str], op_col: str) -> None:
    """Append the rows that one change set changes, as a step that names it; a set that was merged changes nothing."""
    if target.has(origin):
        return
    tagged = tag_changes(target.current(part), part, keys, op_col)
    changed = tagged.filter(F.col(ACTION) != KEPT).withColumn(GONE, F.col(ACTION) == DELETED)
    target.append(changed, target.next_step(), origin, delivery)


def stream_changes(
    changes: DataFrame,
    target: KeyedLog,
    checkpoint: str,
    keys: Sequence[str],
    op_col: str = "change_type",
    order_col: str = BATCH,
) -> None:
    """Merge new change sets into ``target``, a log opened with ``notes=NOTES``.

    A change set reads only the keys it names and appends only their new rows.
    Change sets that came together are applied one after the other, in the
    order of ``order_col``, each as a step of the table. A set that does not
    come after the last applied one is an error, whichever stream brings it:
    its place in the order is taken. So a set has to arrive whole, which rules
    out a limit of files per trigger; ``admission.stream_parts`` has no such rule.
    What a step names as its origin is not applied again.
    """

    def apply(batch: DataFrame, origin: str) -> None:
        # one number per waiting delivery, not per row
        waiting = [r[0] for r in batch.select(order_col).distinct().orderBy(order_col).collect()]
        for delivery in waiting:
            name = f"{origin}:{delivery}"
            if target.has(name):
                continue
            last = target.last_order()
            if delivery is None or (last is not None and delivery <= last):
                raise ValueError(f"change set {delivery} comes after change set {last} was applied")
            part = batch.filter(F.col(order_col) == delivery).drop(order_col)
            merge_delivery(target, part, name, delivery, keys, op_col)

    run_batches(changes, apply, checkpoint)


def change_counts(target: KeyedLog) -> DataFrame:
    """Rows updated, deleted and inserted by each delivery, also those that are 0.

    They are counted from what was written, so a repeated task counts nothing twice.
    """
    done = target.commits().filter(F.col("last_order").isNotNull()).select(STEP, F.col("last_order").cast("int").alias("delivery"))
    actions = F.explode(F.array(*[F.lit(a) for a in (UPDATED, DELETED, INSERTED)])).alias(ACTION)
    counts = target.history().groupBy(STEP, ACTION).agg(F.count("*").alias("n"))
    return done.select("*", actions).join(counts, [STEP, ACTION], "left").select(
        "delivery", F.col(ACTION).alias("action"), F.coalesce("n", F.lit(0)).alias("n_rows")
    )
