"""Filters of the load and read queries."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from heliocat.constants import CATALOG_START
from heliocat.functions.times import utc


def all_of(predicates: list[Column]) -> Column:
    """Conjunction; true if there is none."""
    return reduce(and_, predicates, F.lit(True))


def moment(value) -> Column:
    """A bound as a timestamp; a date means its midnight."""
    return F.lit(str(value).replace("T", " ")).cast("timestamp_ntz")


def between(column: str, lower=None, upper=None) -> list[Column]:
    """Closed range; an absent or empty bound does not filter."""
    out = []
    if lower:
        out.append(F.col(column) >= moment(lower))
    if upper:
        out.append(F.col(column) <= moment(upper))
    return out


def days_between(column: str, lower=None, upper=None) -> list[Column]:
    """Closed range over a date column; a bound with a time compares as a moment."""
    out = []
    if lower:
        out.append(F.col(column).cast("timestamp_ntz") >= moment(lower) if _has_time(lower)
                   else F.col(column) >= F.lit(str(lower)).cast("date"))
    if upper:
        out.append(F.col(column).cast("timestamp_ntz") <= moment(upper) if _has_time(upper)
                   else F.col(column) <= F.lit(str(upper)).cast("date"))
    return out


def _has_time(value) -> bool:
    return ":" in str(value)


def magnitude_prefix(
    column: str, prefix: str, like: bool = False, ignore_case: bool = False
) -> Column:
    """Prefix match; ``like`` gives ``%`` and ``_`` their wildcard meaning."""
    text = F.col(column)
    if like:
        return text.ilike(f"{prefix}%") if ignore_case else text.like(f"{prefix}%")
    if ignore_case:
        return F.lower(text).startswith(prefix.lower())
    return text.startswith(prefix)


def flare_predicates(
    date_from=None,
    date_to=None,
    class_: str | None = None,
    source: str | None = None,
    instrument: str | None = None,
    like: bool = False,
    ignore_case: bool = False,
) -> list[Column]:
    """Filters of the event list; an absent or empty argument does not filter."""
    out = between("event_start", date_from, date_to)
    if class_:
        out.append(magnitude_prefix("magnitude", class_, like, ignore_case))
    if source:
        out.append(F.col("source") == source)
    if instrument:
        out.append(F.col("instrument") == instrument)
    return out


def open_window(df: DataFrame, column: str, after, before) -> DataFrame:
    """Rows strictly inside a time window."""
    return df.filter((F.col(column) > moment(after)) & (F.col(column) < moment(before)))


def from_catalog_start(df: DataFrame, column: str = "event_peak", start: str = CATALOG_START) -> DataFrame:
    """Lower era bound; rows with a null time drop out."""
    return df.filter(F.col(column) >= utc(start))


def with_status(df: DataFrame, value: str, column: str, status: str = "status") -> DataFrame:
    """One column, as double, of the rows with a status."""
    return df.filter(F.col(status) == value).select(F.col(column).cast("double").alias(column))


def head(df: DataFrame, *order: str, n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, *order: str, n: int = 5) -> DataFrame:
    """The last ``n`` rows by ``order``, last first."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)
