"""Column expressions. All of them are built from native Spark functions."""

from strata.functions.money import exact_sum, from_units, mean_from_units, to_units
from strata.functions.parsing import is_true, readable_number, readable_time
from strata.functions.text import path_prefix, safe_identifier, tidy_lower, tidy_upper

__all__ = [
    "exact_sum",
    "from_units",
    "is_true",
    "mean_from_units",
    "path_prefix",
    "readable_number",
    "readable_time",
    "safe_identifier",
    "tidy_lower",
    "tidy_upper",
    "to_units",
]
