"""Ingestion of arriving files: each file once, stamped, appended."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.sources.files import STRICT_OPTIONS, stamp_lineage
from strata.sources.named import BATCH, by_header, headers_of, read_by_name
from strata.sources.versions import SteppedTable


def arriving_csv(
    spark: SparkSession, folder: str, schema: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream over CSV files in delivery folders below ``folder``, with an explicit schema.

    A header that differs from the schema and a line with too few or too many
    values stop the stream with an error; ``stream_rescue`` keeps both.
    """
    reader = spark.readStream.options(**STRICT_OPTIONS).schema(f"{schema}, {BATCH} INT")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(folder)


def append_stream(stream: DataFrame, target: str, checkpoint: str, partition_by: str | None = None) -> None:
    """Append what is new to a folder of Parquet files, then stop.

    The checkpoint remembers the files read and the sink's log the files
    written, so a run that is repeated or was cut off adds nothing twice.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.start(target).awaitTermination()


def run_batches(
    stream: DataFrame, apply: Callable[[DataFrame, str], None], checkpoint: str
) -> None:
    """Hand what is new to ``apply(batch, origin)``, then stop.

    A batch can come again after a crash, then with the same origin; ``apply``
    has to know what it has done. The origin holds the checkpoint's own identity,
    so that the batches of another stream never look like those of this one.
    """

    def numbered(batch: DataFrame, number: int) -> None:
        identity = batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0]
        apply(batch, f"{json.loads(identity)['id']}:{number}")

    (
        stream.writeStream.foreachBatch(numbered)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def stream_ingest(
    spark: SparkSession,
    folder: str,
    schema: str,
    target: str,
    checkpoint: str,
    system: str,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Append new files to Bronze with their lineage and return Bronze."""
    stream = arriving_csv(spark, folder, schema, files_per_trigger)
    append_stream(stamp_lineage(stream, system), target, checkpoint, partition_by=BATCH)
    return spark.read.parquet(target)


def stream_rescue(
    spark: SparkSession,
    folder: str,
    schema: str,
    target: SteppedTable,
    checkpoint: str,
    system: str,
    files_per_trigger: int = 10_000,
    pattern: str = "*.csv",
    line_ends: bool = False,
) -> None:
    """Append what arrives below ``folder`` to ``target``, each value under the column that its file's header names.

    ``target`` comes from ``loads.load_target``. Values without a place and lines
    with too few or too many values are kept in ``_rescued_data``. The stream
    itself reads lines, of which only the first of each file is looked at; a
    batch is one step of the table, so a batch that comes again adds nothing.
    """
    lines = spark.readStream.format("text").options(recursiveFileLookup="true", pathGlobFilter=pattern, maxFilesPerTrigger=files_per_trigger)

    def apply(batch: DataFrame, origin: str) -> None:
        if target.has(origin):
            return
        files = headers_of(batch)
        groups = [g for part in by_header(files) for g in part]
        step = target.next_step()
        if groups:
            target.stage(read_by_name(spark, groups, schema, system, line_ends), step)
        else:
            target.stage(target.rows().limit(0), step)
        target.commit(spark.createDataFrame([(path,) for path, _ in files], "file_path STRING"), step, origin)

    run_batches(lines.load(folder).select("value", "_metadata"), apply, checkpoint)
