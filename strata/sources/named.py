"""CSV files of which each file's own header says where its values belong.

Deliveries change: columns come in another order, new ones are added, lines are
cut off or run over. Here every value that the schema names lands under its
name, and every other one is kept in ``_rescued_data``, a JSON object in text:

- values of columns that the schema does not name, under the column's name
  (of a name that a header repeats the second is ``name (2)`` and so on);
- a line with too few or too many values, whole, under ``_corrupt_record``.

A column that a file lacks is null there. Names are compared without outer
spaces. A file without any line has no rows.

Headers are learnt in a pass over the lines that parses nothing; the files are
then read once more, those with the same header together by one CSV reader, so
the values are parsed without Python and large files are split.
"""

from __future__ import annotations

import csv
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import batched
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.rescue import RESCUED, typed_parse
from strata.sources.files import CORRUPT, CSV_OPTIONS, stamp_lineage

#: Folder column of a delivery: files of batch 7 lie below ``source_batch_id=7``.
BATCH = "source_batch_id"
#: Different headers that one read takes; each is a scan of its own in the plan.
HEADERS = 64
LINEAGE = f"{RESCUED} STRING, _ingested_at TIMESTAMP, _source_file STRING, _source_system STRING, {BATCH} INT"


def literal_path(path: str) -> str:
    """A path in which no sign stands for other names."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def first_lines(lines: DataFrame) -> DataFrame:
    """(file_path, header) of each file: its first line that is not blank.

    ``lines`` comes straight from a text source. A file's first block lies in one
    task, which reduces it to one row before the shuffle.
    """
    told = lines.where((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
    told = told.select(F.col("_metadata.file_path").alias("file_path"), "value", F.monotonically_increasing_id().alias("at"))
    return told.groupBy("file_path").agg(F.min_by("value", "at").alias("header"))


def header_names(header: str) -> tuple[str, ...]:
    """The column names of a header line, no two equal."""
    seen: Counter[str] = Counter()
    names = []
    for name in next(csv.reader([header.removeprefix("﻿")])):
        name = name.strip()
        seen[name] += 1
        names.append(name if seen[name] == 1 else f"{name} ({seen[name]})")
    return tuple(names)


def by_header(files: Iterable[tuple[str, str]], most_files: int = 10_000) -> Iterator[list[tuple[tuple[str, ...], list[str]]]]:
    """(column names, file paths) in groups of bounded size; ``files`` are (path, header)."""
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path, header in files:
        groups[header_names(header)].append(path)
    parts = [(names, list(some)) for names in sorted(groups) for some in batched(sorted(groups[names]), most_files)]
    taken: list[tuple[tuple[str, ...], list[str]]] = []
    for names, paths in parts:
        if taken and (len(taken) == HEADERS or sum(len(p) for _, p in taken) + len(paths) > most_files):
            yield taken
            taken = []
        taken.append((names, paths))
    if taken:
        yield taken


def _same_header(spark: SparkSession, names: tuple[str, ...], paths: list[str], wanted: list[str], system: str, line_ends: bool) -> DataFrame:
    schema = StructType()
    for k in range(len(names)):
        schema = schema.add(f"_{k}", "string")
    # the header has been read; with fewer columns read, Spark would not see that values are missing
    reader = spark.read.options(**CSV_OPTIONS | {"enforceSchema": "true", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false", "multiLine": str(line_ends).lower()})
    rows = stamp_lineage(reader.schema(schema.add(CORRUPT, "string")).csv([literal_path(p) for p in paths]), system)
    at = {name: f"_{k}" for k, name in enumerate(names)}
    others = [(name, F.col(c)) for name, c in at.items() if name not in wanted] + [(CORRUPT, F.col(CORRUPT))]
    kept = F.map_filter(F.create_map(*[x for name, value in others for x in (F.lit(name), value)]), lambda _, value: value.isNotNull())
    some = reduce(lambda a, b: a | b, [value.isNotNull() for _, value in others])
    batch = F.regexp_extract("_source_file", f"/{BATCH}=([0-9]+)/", 1).try_cast("int")
    return rows.select(
        *[(F.col(at[c]) if c in at else F.lit(None).cast("string")).alias(c) for c in wanted],
        F.when(some, F.to_json(kept)).alias(RESCUED),
        "_ingested_at",
        "_source_file",
        "_source_system",
        batch.alias(BATCH),
    )


def read_by_name(
    spark: SparkSession, groups: Iterable[tuple[tuple[str, ...], list[str]]], schema: str | StructType, system: str, line_ends: bool = False
) -> DataFrame:
    """The rows of files grouped by header: the schema's columns, ``_rescued_data``, lineage and the delivery's batch.

    Texts that do not fit the type of their column are rescued too.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parts = [_same_header(spark, names, paths, fields.names, system, line_ends) for names, paths in groups]
    types = {f.name: f.dataType.simpleString() for f in fields if f.dataType.simpleString() != "string"}
    rows = reduce(DataFrame.unionByName, parts)
    return typed_parse(rows, types).select(*rows.columns) if types else rows


def headers_of(lines: DataFrame) -> list[tuple[str, str]]:
    """(path, header) of the files behind ``lines``: a row for each file, on the driver. Paths are as file listings show them."""
    found = first_lines(lines).collect()
    return [(re.sub("^([^:/]+):///", r"\1:/", unquote(r["file_path"])), r["header"]) for r in found]
