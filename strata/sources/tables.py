"""Published tables, views over them, and facts about their files."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def publish(
    df: DataFrame,
    table: str,
    comment: str | None = None,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    file_format: str = "parquet",
) -> None:
    """Replace what a name shows, its schema included, and describe it.

    The name is a view. The rows are written completely into a table of their
    own in a new folder below ``path`` (by default below the name in the
    warehouse), and then the view is pointed at it in one step: at any moment
    the name shows the old rows or the new ones. So a job that fails publishes
    nothing, and ``df`` may read the name it replaces. The replaced table is
    forgotten; its files stay for whoever still reads them.
    """
    spark = df.sparkSession
    fresh = f"{table}__{uuid.uuid4().hex}"
    base = path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{table}"
    writer = df.write.format(file_format).option("path", f"{base.rstrip('/')}/{uuid.uuid4().hex}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(fresh)
    described = "" if comment is None else f" COMMENT {_quoted(comment)}"
    shown = f"CREATE OR REPLACE VIEW {_name(table)}{described} AS SELECT * FROM {_name(fresh)}"
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        # a table that was not made here: it steps aside, and goes only when the view stands
        aside = f"{table}__before_{uuid.uuid4().hex}"
        spark.sql(f"ALTER TABLE {_name(table)} RENAME TO {_name(aside)}")
        try:
            spark.sql(shown)
        except Exception:
            spark.sql(f"ALTER TABLE {_name(aside)} RENAME TO {_name(table)}")
            raise
        spark.sql(f"DROP TABLE {_name(aside)}")
    else:
        spark.sql(shown)
    *within, last = table.split(".")
    place = f" IN {_name('.'.join(within))}" if within else ""
    for row in spark.sql(f"SHOW TABLES{place} LIKE '{last.lower()}__*'").collect():
        if re.fullmatch(rf"{re.escape(last.lower())}__[0-9a-f]{{32}}", row["tableName"]) and row["tableName"] != fresh.split(".")[-1].lower():
            spark.sql(f"DROP TABLE {_name('.'.join([*within, row['tableName']]))}")


def scan(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def create_table(spark: SparkSession, table: str, schema: str, path: str | None = None) -> None:
    """Drop and create an empty table; rows go in with ``INSERT`` or ``insertInto``."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(table)}")
    location = f" LOCATION {_quoted(path)}" if path else ""
    spark.sql(f"CREATE TABLE {_name(table)} ({schema}) USING parquet{location}")


def register_views(**frames: DataFrame) -> None:
    """Temporary views by name, for SQL text over the layers."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def consumer_view(
    spark: SparkSession, view: str, table: str, columns: Sequence[str], rule: str
) -> DataFrame:
    """Stored view with chosen columns and the rows consumers may use."""
    chosen = ", ".join(f"`{c}`" for c in columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {_name(view)} AS SELECT {chosen} FROM {_name(table)} WHERE {rule}"
    )
    return spark.table(view)


def file_stats(df: DataFrame) -> DataFrame:
    """Rows and bytes of each file behind a table. No data column is read."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count("*").alias("n_rows"), F.max("_metadata.file_size").alias("n_bytes")
    )


def table_file_stats(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Files, rows and bytes per table."""
    stats = None
    for name, df in tables.items():
        one = file_stats(df).agg(
            F.count("*").alias("n_files"),
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"),
        ).select(F.lit(name).alias("table_name"), "n_files", "n_rows", "n_bytes")
        stats = one if stats is None else stats.unionByName(one)
    return stats
