"""Joining events with the daily lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from heliocat.schemas import INDEX_COLUMNS


def attach_indices(
    events: DataFrame,
    indices: DataFrame,
    start: str = "event_start",
    date: str = "date",
    columns: list[str] = INDEX_COLUMNS,
) -> DataFrame:
    """Left join on the day of ``start``; the lookup has one row per day.

    Adaptive execution sees the lookup's size and broadcasts it or shuffles both sides,
    and then splits the days that hold too much.
    """
    daily = indices.select(F.col(date).alias("_date"), *columns)
    return events.join(daily, F.to_date(events[start]) == daily["_date"], "left").drop("_date")
