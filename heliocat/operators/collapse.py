"""Several status rows of an event to one row."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from heliocat.constants import MIN_STATUS_ROWS, STATUS_END, STATUS_PEAK, STATUS_START
from heliocat.functions.solar import add_sun_position
from heliocat.functions.times import from_offset_seconds


@dataclass(frozen=True)
class StatusColumns:
    """Names in a status-row frame.

    ``seq`` orders the rows of an event as they arrived. ``by`` names further grouping
    columns; with ``("file",)`` each file's events are collapsed on their own, as they
    must be when files repeat each other.
    """

    id: str = "flare_id"
    status: str = "status"
    time: str = "time"
    flux: str = "xrsb_flux"
    integrated: str = "integrated_flux"
    magnitude: str | None = "flare_class"
    seq: str = "pos"
    by: tuple = ()


def group_events(rows: DataFrame, names: StatusColumns = StatusColumns()) -> DataFrame:
    """One row per id with what the first row of each status holds.

    One shuffle by id, after a partial aggregate. Values are picked by the plain
    ``seq`` column, one pick per field, so the numeric fields fit a hash aggregate.
    """
    n = names

    def first(status: str, column: str) -> Column:
        here = F.col(n.status) == status
        return F.min_by(F.when(here, F.col(column)), F.when(here, F.col(n.seq)))

    picks = {
        "start_offset": first(STATUS_START, n.time),
        "peak_offset": first(STATUS_PEAK, n.time),
        "end_offset": first(STATUS_END, n.time),
        "xrsb_flux_peak": first(STATUS_PEAK, n.flux),
        "integrated_flux": first(STATUS_END, n.integrated),
    }
    if n.magnitude:
        picks["magnitude"] = first(STATUS_PEAK, n.magnitude)
    seen = {
        f"has_{label}": F.count_if(F.col(n.status) == status) > 0
        for label, status in [("start", STATUS_START), ("peak", STATUS_PEAK), ("end", STATUS_END)]
    }
    return rows.groupBy(*n.by, F.col(n.id).alias("event_id")).agg(
        F.count("*").alias("n_rows"),
        F.min(n.seq).alias("seq"),
        *[c.alias(k) for k, c in seen.items()],
        *[c.alias(k) for k, c in picks.items()],
    )


def is_whole(min_rows: int = MIN_STATUS_ROWS) -> Column:
    """An event is kept if it has enough rows, all three statuses, usable times and an id."""
    return (
        F.col("event_id").isNotNull()
        & (F.col("n_rows") >= min_rows)
        & F.col("has_start")
        & F.col("has_peak")
        & F.col("has_end")
        & from_offset_seconds(F.col("start_offset")).isNotNull()
        & from_offset_seconds(F.col("peak_offset")).isNotNull()
        & from_offset_seconds(F.col("end_offset")).isNotNull()
    )


def collapse_events(
    rows: DataFrame,
    names: StatusColumns = StatusColumns(),
    min_rows: int = MIN_STATUS_ROWS,
    **site,
) -> DataFrame:
    """Collapsed events with UTC times and the sun's position at the peak.

    ``seq`` is the place of the event's first row: the order in which events arrive.
    """
    whole = group_events(rows, names).filter(is_whole(min_rows))
    timed = whole.select(
        *names.by,
        "event_id",
        "seq",
        from_offset_seconds(F.col("start_offset")).alias("event_start"),
        from_offset_seconds(F.col("peak_offset")).alias("event_peak"),
        from_offset_seconds(F.col("end_offset")).alias("event_end"),
        *(["magnitude"] if names.magnitude else []),
        "xrsb_flux_peak",
        "integrated_flux",
    )
    return add_sun_position(timed, "event_peak", **site)


def collapse_counters(
    rows: DataFrame, names: StatusColumns = StatusColumns(), min_rows: int = MIN_STATUS_ROWS
) -> DataFrame:
    """One row: ids detected, events processed, ids discarded."""
    return group_events(rows, replace(names, magnitude=None)).agg(
        F.count("*").alias("detected"),
        F.count_if(is_whole(min_rows)).alias("processed"),
        F.count_if(~is_whole(min_rows)).alias("discarded"),
    )


def distinct_ids(rows: DataFrame, id: str = "flare_id") -> DataFrame:
    return rows.select(id).distinct()
