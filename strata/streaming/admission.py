"""Deliveries that arrive in parts and are let in whole and in their order.

A manifest announces how many rows each delivery has. What arrives is kept in
steps of a waiting table, whatever the order and the cut of the files, and their
commits hold the rows per delivery. A delivery is merged once all of its rows are
there and every announced delivery before it has been merged. So a stream may take
as few files per trigger as it likes, and files may overtake each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.versions import KeyedLog, SteppedTable
from strata.streaming.changes import merge_delivery
from strata.streaming.ingest import BATCH, run_batches

#: What a commit says of its step: rows of each delivery.
ARRIVED = "delivery INT, n_rows BIGINT"


def waiting_table(spark: SparkSession, root: str, schema: str) -> SteppedTable:
    """Parts of deliveries, in folders by delivery."""
    return SteppedTable(spark, root, f"{schema}, {BATCH} INT", ARRIVED, [BATCH])


def arrived(waiting: SteppedTable) -> DataFrame:
    """(delivery, n_rows) that came so far; from the commits, without reading rows."""
    return waiting.commits().groupBy("delivery").agg(F.sum("n_rows").alias("n_rows"))


def admissible(announced: DataFrame, waiting: SteppedTable, target: KeyedLog) -> list[int]:
    """The deliveries that are complete and next in order; one number for each announced delivery is looked at.

    More rows than announced are an error, and so are rows of a delivery that nobody announced.
    """
    here = announced.select(F.col("delivery").cast("int").alias("delivery"), F.col("n_rows").alias("due"))
    both = here.join(arrived(waiting), "delivery", "full_outer").orderBy("delivery").collect()
    last, ready, gap = target.last_order(), [], False
    for row in both:
        if row["due"] is None or (row["n_rows"] or 0) > row["due"]:
            raise ValueError(f"delivery {row['delivery']} has {row['n_rows']} rows, announced are {row['due']}")
        gap = gap or (row["n_rows"] or 0) < row["due"]
        if not gap and (last is None or row["delivery"] > last):
            ready.append(row["delivery"])
    return ready


def admit(announced: DataFrame, waiting: SteppedTable, target: KeyedLog, keys: Sequence[str], op_col: str = "change_type") -> None:
    """Merge what is complete, one delivery a step."""
    for delivery in admissible(announced, waiting, target):
        part = waiting.rows().filter(F.col(BATCH) == delivery).drop(BATCH)
        merge_delivery(target, part, f"delivery:{delivery}", delivery, keys, op_col)


def stream_parts(
    changes: DataFrame, announced: DataFrame, waiting: SteppedTable, target: KeyedLog, checkpoint: str, keys: Sequence[str], op_col: str = "change_type"
) -> None:
    """Take in parts of deliveries and merge into ``target``, a log opened with ``changes.NOTES``, what is complete.

    A batch that comes again is not kept again; a merge that broke is made up for by the
    next run. Deliveries without rows need no file.
    """

    def apply(batch: DataFrame, origin: str) -> None:
        if not waiting.has(origin):
            step = waiting.next_step()
            waiting.stage(batch, step)
            counts = waiting._rows_of([step]).groupBy(F.col(BATCH).alias("delivery")).agg(F.count("*").alias("n_rows"))
            waiting.commit(counts, step, origin)
        admit(announced, waiting, target, keys, op_col)

    run_batches(changes, apply, checkpoint)
    admit(announced, waiting, target, keys, op_col)
