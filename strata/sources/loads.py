"""Idempotent batch loads: files that were loaded once are skipped."""

from __future__ import annotations

from itertools import batched

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.named import LINEAGE, by_header, headers_of, literal_path, read_by_name
from strata.sources.versions import SteppedTable

LOADED = "file_path STRING"


def load_target(spark: SparkSession, root: str, feed_schema: str) -> SteppedTable:
    """Target of ``load_new_files`` and ``stream_rescue``; its commits are the ledger of loaded files."""
    return SteppedTable(spark, root, f"{feed_schema}, {LINEAGE}", facts=LOADED)


def new_files(target: SteppedTable, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Files of the folder that the ledger lacks. Only names are read, not contents."""
    files = (
        target.spark.read.format("binaryFile")
        .options(recursiveFileLookup="true", pathGlobFilter=pattern)
        .load(folder)
        .select(F.col("path").alias("file_path"))
    )
    return files.join(target.commits(), "file_path", "left_anti")


def load_new_files(
    target: SteppedTable, folder: str, feed_schema: str, system: str, files_per_step: int = 10_000, line_ends: bool = False
) -> int:
    """Append the rows of files not loaded before; returns the number of steps taken.

    Each value lands under the column that its file's header names, whatever
    the order; see ``read_by_name`` for what is kept in ``_rescued_data``. The
    folder is listed once. Each step takes at most ``files_per_step`` names, so
    the names on the driver are bounded; steps go on until no file is left.
    """
    steps, spark = 0, target.spark
    pending = (r["file_path"] for r in new_files(target, folder).toLocalIterator())

    def loaded(paths: list[str], rows: DataFrame) -> None:
        nonlocal steps
        step = target.next_step()
        target.stage(rows, step)
        target.commit(spark.createDataFrame([(p,) for p in paths], LOADED), step)
        steps += 1

    for names in batched(pending, files_per_step):
        files = headers_of(spark.read.text([literal_path(n) for n in names]).select("value", "_metadata"))
        for groups in by_header(files, files_per_step):
            loaded([p for _, paths in groups for p in paths], read_by_name(spark, groups, feed_schema, system, line_ends))
        if empty := sorted(set(names) - {path for path, _ in files}):
            loaded(empty, target.rows().limit(0))
    return steps
