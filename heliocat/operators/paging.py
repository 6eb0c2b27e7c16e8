"""Pages of a descending list, also far down a very long one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from heliocat.constants import DEFAULT_PAGE_SIZE, MAX_PAGE_SIZE
from heliocat.functions.times import exact_seconds_since, seconds_since, utc

#: rows among which a page is cut in the end; ranges of equal keys may hold more
TOP_ROWS = 4000
_BUCKETS = 1024
_EARLIEST = "0001-01-01 00:00:00"
_IDS = 1 << 64


def page_offset(page: int = 1, page_size: int = DEFAULT_PAGE_SIZE) -> int:
    if page < 1:
        raise ValueError("page must be at least 1")
    if not 1 <= page_size <= MAX_PAGE_SIZE:
        raise ValueError(f"page_size must be between 1 and {MAX_PAGE_SIZE}")
    return (page - 1) * page_size


def newest_first(
    df: DataFrame,
    offset: int,
    size: int,
    time: str = "event_start",
    tie: str = "id",
    top_rows: int = TOP_ROWS,
) -> DataFrame:
    """Rows ``offset .. offset + size`` by ``time``, then ``tie``, both descending, nulls last.

    Down to row ``top_rows`` each task keeps that many rows. Further down counts per range of the
    sort key, round by round, find a range of at most ``top_rows``
    rows (or one page and the rows equal to its ends) that holds the page at any depth; only
    these rows are sorted. The key is the second; if rows of one second are too many, the
    time and the tie as one number.
    """
    most = max(top_rows, size)
    if offset + size <= most:
        return df.orderBy(F.desc(time), F.desc(tie)).offset(offset).limit(size)
    for place, one in ((_second(time), F.lit), (_place(time, tie), _decimal)):
        found = _reach(df.select(place.alias("place")), one, offset, size, most)
        if not found.held:  # the list ends above the page
            return df.limit(0)
        if found.lower is not None:
            df = df.filter((place >= one(found.lower)) & (place <= one(found.upper)))
            if one is F.lit and found.lower > 0:
                # for the scan: files outside these times are not read
                first, last = (F.timestamp_add("SECOND", F.lit(n), utc(_EARLIEST)) for n in (found.lower - 1, found.upper))
                df = df.filter((F.col(time) >= first) & (F.col(time) <= last))
        offset -= found.skipped
        if found.held <= most:
            break
    return df.orderBy(F.desc(time), F.desc(tie)).offset(offset).limit(size)


def _second(time: str) -> Column:
    """The second of the time as a whole number above 0; 0 for a null."""
    return F.coalesce(seconds_since(F.col(time), _EARLIEST) + 1, F.lit(0))


def _place(time: str, tie: str) -> Column:
    """Time and tie as one whole number that sorts as they do; a null is below all values."""
    micros = (exact_seconds_since(F.col(time), _EARLIEST) * 1_000_000).cast("decimal(18,0)")
    later = F.coalesce(micros + F.lit(Decimal(1)), F.lit(Decimal(0))).cast("decimal(18,0)")
    ids = F.col(tie).cast("decimal(20,0)") + F.lit(Decimal(_IDS // 2))
    ids = F.coalesce(ids + F.lit(Decimal(1)), F.lit(Decimal(0))).cast("decimal(20,0)")
    # 2 ** 65 leaves room for the null below 2 ** 64 ids
    return (later * F.lit(Decimal(2 * _IDS)) + ids).cast("decimal(38,0)")


def _decimal(n: int) -> Column:
    return F.lit(Decimal(n)).cast("decimal(38,0)")


@dataclass(frozen=True)
class _Reach:
    """``held`` rows from ``upper`` down to ``lower`` (None: all rows) with ``skipped`` above."""

    lower: int | None
    upper: int | None
    skipped: int
    held: int


def _reach(rows: DataFrame, one: Callable, offset: int, size: int, most: int) -> _Reach:
    """A range of ``place`` that holds the wanted rows; ``one`` writes a place as a literal.

    Each round splits the range in buckets and keeps those from the one of the first wanted
    row to the one of the last; only the counts of 1,024 buckets reach the driver.
    """
    lower, upper, total = rows.agg(F.min("place"), F.max("place"), F.count("*")).first()
    if total <= most or offset >= total:
        return _Reach(None, None, 0, total if offset < total else 0)
    lower, upper, skipped, held = int(lower), int(upper), 0, total
    last = min(offset + size, total)
    while held > most and upper > lower:
        width = (upper - lower) // _BUCKETS + 1
        bucket = F.call_function("div", one(upper) - F.col("place"), one(width))
        counts = (
            rows.filter((F.col("place") >= one(lower)) & (F.col("place") <= one(upper)))
            .groupBy(bucket.alias("bucket"))
            .count()
            .orderBy("bucket")
            .collect()
        )
        above, wanted = skipped, []
        for number, n in counts:
            if above + n > offset and above < last:
                wanted.append((number, above, n))
            above += n
        first, end = wanted[0], wanted[-1]
        narrowed = (max(lower, upper - (end[0] + 1) * width + 1), upper - first[0] * width)
        held, skipped = end[1] + end[2] - first[1], first[1]
        if narrowed == (lower, upper):  # its ends are single values
            break
        lower, upper = narrowed
    return _Reach(lower, upper, skipped, held)
