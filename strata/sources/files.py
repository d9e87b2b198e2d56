"""Landing folders of headed CSV files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The header has to name the schema's columns; quotes inside a text are doubled.
CSV_OPTIONS = {"header": "true", "enforceSchema": "false", "escape": '"'}
#: No line is cut or filled up silently: with fewer columns read, Spark would not see that values are missing.
STRICT_OPTIONS = CSV_OPTIONS | {"mode": "FAILFAST", "columnPruning": "false"}
#: Column of a line as it stands in the file, where it has too few or too many values.
CORRUPT = "_corrupt_record"


#: Signs that would end a line, and the escape itself, in an order in which they can be put in and taken out one by one:
#: the sign after an escape is never one, so no two marks overlap.
LINE_MARKS = (("\\", "\\0"), ("\n", "\\1"), ("\r", "\\2"))


def _in_texts(df: DataFrame, marks: Sequence[tuple[str, str]]) -> DataFrame:
    texts = [c for c, kind in df.dtypes if kind == "string"]

    def changed(column: Column) -> Column:
        return reduce(lambda c, mark: F.replace(c, F.lit(mark[0]), F.lit(mark[1])), marks, column)

    return df.withColumns({c: changed(F.col(c)) for c in texts}) if texts else df


def one_line(df: DataFrame) -> DataFrame:
    """Texts without line ends, from which ``many_lines`` gives the texts back."""
    return _in_texts(df, LINE_MARKS)


def many_lines(df: DataFrame) -> DataFrame:
    """The texts that ``one_line`` was given."""
    return _in_texts(df, [(mark, sign) for sign, mark in reversed(LINE_MARKS)])


def read_feed(
    spark: SparkSession,
    folder: str,
    schema: str | StructType,
    ragged: bool = False,
    line_ends: bool = False,
    header: bool = True,
    marked_ends: bool = False,
) -> DataFrame:
    """All CSV files of a folder with an explicit schema; nothing is inferred.

    A file whose header differs from the schema is an error, and so is a line with
    too few or too many values. With ``ragged``, such lines are marked in a column
    ``_corrupt_record``, which ``typed_parse`` rescues; ``read_by_name`` keeps
    files with other headers too. With ``line_ends``, texts may hold line ends; a
    file then cannot be split between tasks. ``marked_ends`` reads what ``land_csv``
    wrote with it: every row is one line, so files are split.
    """
    reader = spark.read.options(**(CSV_OPTIONS if ragged else STRICT_OPTIONS) | {"header": str(header).lower()})
    if line_ends:
        reader = reader.option("multiLine", "true")
    if ragged:
        fields = StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))
        schema = fields.add(CORRUPT, "string")
        # with fewer columns read, Spark would not see that values are missing
        reader = reader.options(columnNameOfCorruptRecord=CORRUPT, columnPruning="false")
    rows = reader.schema(schema).csv(folder)
    return many_lines(rows) if marked_ends else rows


def land_csv(
    df: DataFrame,
    folder: str,
    mode: str = "overwrite",
    rows_per_file: int | None = None,
    partition_by: Sequence[str] = (),
    marked_ends: bool = False,
    compression: str | None = None,
) -> None:
    """Write headed CSV. Files are split by row count, never gathered into one task.

    Outer spaces, quotes and backslashes come back from ``read_feed`` as they
    were, and line ends with its ``line_ends``; an empty text comes back as
    null, as it does with any CSV file Spark reads. With ``marked_ends``, line ends
    are written as marks that ``read_feed`` takes out again, so that files can be
    split by line. Readers know a ``compression`` by the files' endings; a file
    of ``gzip`` is read by one task.
    """
    writer = (one_line(df) if marked_ends else df).write.mode(mode).options(
        header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    )
    if compression:
        writer = writer.option("compression", compression)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(folder)


def stamp_lineage(df: DataFrame, system: str, batch: str | int | None = None) -> DataFrame:
    """Where a row came from: time of ingestion, file, system and, if given, batch.

    ``df`` has to come straight from a file source, batch or stream.
    """
    stamped = df.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_source_file": F.col("_metadata.file_path"),
            "_source_system": F.lit(system),
        }
    )
    return stamped if batch is None else stamped.withColumn("source_batch_id", F.lit(batch))
