"""Row rules on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.expectations import Rule, drop_failing, observe_rules, raise_for
from strata.sources.versions import SteppedTable
from strata.streaming.ingest import run_batches

ACCEPTED, BROKEN = "_accepted", "_broken_rules"
COUNTS = "rule STRING, action STRING, failed_rows BIGINT, checked_rows BIGINT"


def checked_target(spark: SparkSession, root: str, schema: str) -> SteppedTable:
    """Target of ``stream_checked``; its commits hold the counts of each rule."""
    return SteppedTable(spark, root, schema, facts=COUNTS)


def stream_checked(
    stream: DataFrame, rules: Sequence[Rule], target: SteppedTable, checkpoint: str
) -> None:
    """Append the rows that meet the ``drop`` rules and record counts for all rules.

    Counts are taken while the rows are written. A ``fail`` rule that breaks
    leaves the rows uncommitted and stops the stream with an error.
    """
    if not rules:
        raise ValueError("without rules there are no counts to commit; use append_stream")

    def apply(batch: DataFrame, origin: str) -> None:
        if target.has(origin):
            return
        counts, step = Observation(), target.next_step()
        target.stage(drop_failing(observe_rules(batch, rules, counts), rules), step)
        seen = counts.get
        raise_for(seen, rules)
        facts = [(r.name, r.action, seen[r.name], seen["checked_rows"]) for r in rules]
        target.commit(target.spark.createDataFrame(facts, COUNTS), step, origin)

    run_batches(stream, apply, checkpoint)


def judged_target(spark: SparkSession, root: str, schema: str) -> SteppedTable:
    """Target of ``stream_judged``: accepted and rejected rows in folders of their own, the counts in the commits."""
    return SteppedTable(spark, root, f"{schema}, {BROKEN} ARRAY<STRING>, {ACCEPTED} BOOLEAN", COUNTS, [ACCEPTED])


def stream_judged(stream: DataFrame, rules: Sequence[Rule], target: SteppedTable, checkpoint: str) -> None:
    """Append every row, the ones that break a ``drop`` rule apart and with the names of the rules they break.

    Both sides of a batch are one write and one step: they are committed together
    or not at all, so accepted and rejected rows are always all that arrived. Counts are
    taken on the way. A ``fail`` rule that breaks leaves the batch uncommitted
    and stops the stream with an error.
    """
    if not rules:
        raise ValueError("without rules there is nothing to judge; use append_stream")
    broken = F.array_compact(F.array(*[F.when(~r.holds, F.lit(r.name)) for r in rules if r.action == "drop"])).cast("array<string>")

    def apply(batch: DataFrame, origin: str) -> None:
        if target.has(origin):
            return
        counts, step = Observation(), target.next_step()
        judged = observe_rules(batch, rules, counts).withColumn(BROKEN, broken).withColumn(ACCEPTED, F.size(BROKEN) == 0)
        target.stage(judged, step)
        seen = counts.get
        raise_for(seen, rules)
        facts = [(r.name, r.action, seen[r.name], seen["checked_rows"]) for r in rules]
        target.commit(target.spark.createDataFrame(facts, COUNTS), step, origin)

    run_batches(stream, apply, checkpoint)


def accepted(target: SteppedTable) -> DataFrame:
    """The rows that met the rules; the folders of the others are not read."""
    return target.rows().filter(ACCEPTED).drop(ACCEPTED, BROKEN)


def rejected(target: SteppedTable) -> DataFrame:
    """The rows that did not, with the names of the rules they broke."""
    return target.rows().filter(f"NOT {ACCEPTED}").drop(ACCEPTED)
