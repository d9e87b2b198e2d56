"""Event deduplication on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.refine import keep_one
from strata.sources.versions import SteppedTable
from strata.streaming.ingest import run_batches

#: Column that spreads the copies of one event over tasks.
SPREAD = "_spread"


def file_spread(salts: int = 16) -> Column:
    """Number from 0 to ``salts - 1`` by file and file block; for streams of files."""
    place = F.xxhash64("_metadata.file_path", "_metadata.file_block_start")
    return F.pmod(place, F.lit(salts))


def dedup_stream(events: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """First copy of each event; copies come within ``delay`` of each other in event time.

    An event that is older than the newest one by more than ``delay`` is taken
    for a late copy and dropped, so ``delay`` has to cover the whole lateness
    of the source. Where no such bound is known, use ``dedup_into``, which keeps
    the seen events in a table and never drops a new one.

    With a column ``_spread`` the copies of an event are first cut to one per
    value of it: a single event delivered very many times then loads many
    tasks instead of one.
    """
    watched = events.withWatermark(time, delay)
    if SPREAD in events.columns:
        watched = watched.dropDuplicatesWithinWatermark([*keys, SPREAD]).drop(SPREAD)
    return watched.dropDuplicatesWithinWatermark(list(keys))


def dedup_into(events: DataFrame, keys: Sequence[str], target: SteppedTable, checkpoint: str) -> None:
    """Append each event once to ``target``, however late it comes.

    What was seen is the target itself: new events are those without partner
    among its keys, of which only the key columns are read. Of copies that come
    together the first in the order of all columns stays, as in a batch.
    """

    def apply(batch: DataFrame, origin: str) -> None:
        if target.has(origin):
            return
        others = [F.asc_nulls_last(c) for c in batch.columns if c not in keys]
        once = keep_one(batch, keys, others or [F.col(keys[0])])
        step = target.next_step()
        target.stage(once.join(target.rows().select(*keys), list(keys), "left_anti"), step)
        target.commit(target.note("events"), step, origin)

    run_batches(events, apply, checkpoint)
