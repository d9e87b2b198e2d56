"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.fixed import IDENTIFIER_DIGIT_PREFIX, IDENTIFIER_FALLBACK, IDENTIFIER_LENGTH


def tidy_lower(text: Column) -> Column:
    return F.lower(F.trim(text))


def tidy_upper(text: Column) -> Column:
    return F.upper(F.trim(text))


def safe_identifier(
    text: Column,
    max_length: int = IDENTIFIER_LENGTH,
    fallback: str = IDENTIFIER_FALLBACK,
    digit_prefix: str = IDENTIFIER_DIGIT_PREFIX,
) -> Column:
    """Text as a name: ``[a-z0-9_]`` only, no doubled or outer ``_``, not led by a digit."""
    # a run of foreign characters and underscores becomes one underscore
    name = F.trim(F.regexp_replace(F.lower(text), "[^a-zA-Z0-9]+", "_"), F.lit("_"))
    # null text stays null: only a name that became empty takes the fallback
    name = F.regexp_replace(name, "^$", fallback)
    name = F.regexp_replace(name, "^([0-9])", digit_prefix + "$1")
    return F.substring(name, 1, max_length)


def path_prefix(path: Column) -> Column:
    """First part of a relative path."""
    return F.split_part(path, F.lit("/"), F.lit(1))
