"""Text to typed values. Text that does not fit gives null and never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def readable_number(text: Column) -> Column:
    """Double, or null when the text is no number. Very large numbers and NaN are numbers."""
    return text.try_cast("double")


def readable_time(text: Column) -> Column:
    """Timestamp, or null when the text is none. A time of day alone names no day and is none."""
    return F.when(text.rlike(r"^\s*[+-]?\d{4,}-"), text.try_cast("timestamp"))


def is_true(condition: Column) -> Column:
    """Condition with null read as false."""
    return F.coalesce(condition, F.lit(False))
