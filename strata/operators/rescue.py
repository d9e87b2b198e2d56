"""Typing of text columns that keeps what did not fit."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import readable_number, readable_time
from strata.sources.files import CORRUPT

RESCUED = "_rescued_data"


def _typed(text: Column, type_name: str) -> Column:
    if type_name == "double":
        return readable_number(text)
    if type_name == "timestamp":
        return readable_time(text)
    return text.try_cast(type_name)


def typed_parse(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Replace text columns by typed ones; values that do not fit go to ``_rescued_data``.

    ``types`` maps column to type. The rescued column is a JSON object of the
    raw texts, in the order of ``types``, or null when everything fitted. A
    missing value is not a value that failed: it stays null and is not rescued.
    A line that ``read_feed`` marked as having too few or too many values is
    rescued whole, under the name of the mark. What ``df`` holds in
    ``_rescued_data`` already, as ``read_by_name`` leaves it, stays in it.
    """
    typed = {c: _typed(F.col(c), t) for c, t in types.items()}
    misfit = {c: F.col(c).isNotNull() & typed[c].isNull() for c in types}
    if CORRUPT in df.columns:
        misfit[CORRUPT] = F.col(CORRUPT).isNotNull()
    pairs = [x for c in misfit for x in (F.lit(c), F.when(misfit[c], F.col(c)))]
    texts = F.map_filter(F.create_map(*pairs), lambda _, text: text.isNotNull())
    any_misfit = F.lit(False)
    for failed in misfit.values():
        any_misfit = any_misfit | failed
    rescued = F.when(any_misfit, F.to_json(texts))
    if RESCUED in df.columns:
        # a column that did not fit and a value without column have different names
        before = F.from_json(RESCUED, "map<string,string>")
        rescued = F.when(any_misfit & F.col(RESCUED).isNotNull(), F.to_json(F.map_concat(texts, before))).otherwise(F.coalesce(rescued, RESCUED))
    # one projection: every expression sees the raw text, and the map is built
    # only for the few rows that need it
    return df.select(
        *[typed[c].alias(c) if c in typed else F.col(c) for c in df.columns if c not in (CORRUPT, RESCUED)],
        rescued.alias(RESCUED),
    )


def drop_rescued(df: DataFrame) -> DataFrame:
    """Rows in which every value fitted, without the rescue column."""
    return df.filter(F.col(RESCUED).isNull()).drop(RESCUED)


def drop_unreadable(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows of whole lines in which the values of ``columns`` fitted; values of other columns do not matter."""
    names = F.map_keys(F.from_json(RESCUED, "map<string,string>"))
    bad = F.arrays_overlap(names, F.array(*[F.lit(c) for c in (*columns, CORRUPT)]))
    return df.filter(~F.coalesce(bad, F.lit(False))).drop(RESCUED)
