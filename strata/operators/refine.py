"""From text rows to clean rows: normalise, type, flag, keep one row per key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.fixed import ORDER_STATUSES
from strata.functions import (
    is_true,
    readable_number,
    readable_time,
    tidy_lower,
    tidy_upper,
    to_units,
)
from strata.functions.money import ORDER_DIGITS


#: How to clean the columns of the order feed: result column, how, raw column.
ORDER_RULES = (
    ("amount_value", readable_number, "amount"),
    ("order_time", readable_time, "order_ts"),
    ("status_clean", tidy_lower, "status"),
    ("channel_clean", tidy_lower, "channel"),
    ("country", tidy_upper, "country"),
)


def standardise(
    feed: DataFrame, rules: Sequence[tuple[str, Callable[[Column], Column], str]] = ORDER_RULES, dates: Mapping[str, str] | None = None
) -> DataFrame:
    """Columns by rule beside the raw ones; ``dates`` maps a new date column to the time it is the day of."""
    dates = {"order_date": "order_time"} if dates is None else dates
    cleaned = feed.withColumns({new: clean(F.col(raw)) for new, clean, raw in rules})
    return cleaned.withColumns({day: F.to_date(time) for day, time in dates.items()}) if dates else cleaned


def flag_valid(
    rows: DataFrame,
    present: Sequence[str] = ("order_id", "customer_id", "order_time"),
    amount: str = "amount_value",
    status: str = "status_clean",
    allowed: Sequence[str] = ORDER_STATUSES,
) -> DataFrame:
    """``is_valid``: ``present`` columns not null, the amount a money amount, status allowed.

    A null status makes the test neither true nor false; it counts as false, so
    that valid and invalid rows together are all rows.
    """
    valid = F.col(status).isin(*allowed) & to_units(F.col(amount), ORDER_DIGITS).isNotNull()
    for column in present:
        valid = valid & F.col(column).isNotNull()
    return rows.withColumn("is_valid", is_true(valid))


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    ``order`` should separate all rows of a key; then the survivor does not
    depend on how the data is spread. Spark cuts each key to one row per task
    before the shuffle, so a key with very many copies does not load one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_order_first() -> list[Column]:
    """Latest and then largest copy of an order; raw texts settle the rest."""
    return [
        F.desc_nulls_last("order_time"),
        F.desc_nulls_last("amount_value"),
        *[
            F.asc_nulls_last(c)
            for c in ("order_ts", "amount", "status", "channel", "customer_id", "country")
        ],
    ]


def refine_orders(feed: DataFrame, allowed: Sequence[str] = ORDER_STATUSES) -> DataFrame:
    """Clean orders: one typed and flagged row per order."""
    flagged = flag_valid(standardise(feed), allowed=allowed)
    return keep_one(flagged, ["order_id"], latest_order_first())


def quarantine(rows: DataFrame, columns: Sequence[str] = ("*",)) -> DataFrame:
    """The invalid rows, by default with all their columns."""
    return rows.filter(~F.col("is_valid")).select(*columns)


def normalise_events(events: DataFrame) -> DataFrame:
    """Upper-case event types, amounts in whole cents."""
    return events.withColumns(
        {
            "event_type": tidy_upper(F.col("event_type")),
            "amount_cents": to_units(F.col("amount")),
        }
    ).drop("amount")


#: What identifies an event: the sale and its line.
EVENT_KEYS = ("sale_id", "line_no")


#: The event's keys as one text.
EVENT_ID = "sales_event_id"


def event_id() -> Column:
    return F.concat_ws("-", *[F.col(k).cast("string") for k in EVENT_KEYS])


def latest_events(events: DataFrame) -> DataFrame:
    """The latest version of each normalised event; all other columns break ties."""
    others = [c for c in events.columns if c not in (*EVENT_KEYS, "event_date")]
    order = [F.desc_nulls_last("event_date"), *[F.asc_nulls_last(c) for c in others]]
    return keep_one(events, EVENT_KEYS, order)


def refine_events(events: DataFrame) -> DataFrame:
    """Clean sales events: normalised, the latest version of each event.

    The two parts of the event id stay numbers for the shuffle; the text id is
    made from them afterwards.
    """
    return latest_events(normalise_events(events)).withColumn(EVENT_ID, event_id())
