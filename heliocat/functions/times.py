"""Timestamps: all results are ``timestamp_ntz`` in UTC, whatever the session zone is."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from heliocat.constants import TIME_BASE
from heliocat.functions.numeric import truncate_int

# Fixed pattern: a date and a time, then an offset.
_ZONED = (
    r"^\s*[+-]?\d{4,}-[^:]*:\d\d(?::\d\d)?(?:\.\d+)?"
    r"\s*(?:Z|UTC|GMT|[+-]\d\d(?::?\d\d)?)\s*$"
)

#: Formats of times beside ISO, tried in this order.
TIME_FORMATS = (
    "yyyy/M/d H:mm[:ss]",
    "yyyyMMdd'T'HHmm[ss]",
    "d-MMM-yyyy H:mm[:ss]",
    "MMM d yyyy H:mm[:ss]",
)


def utc(text: str) -> Column:
    """A literal timestamp, written as UTC."""
    return F.lit(text).cast("timestamp_ntz")


_EPOCH = "1970-01-01 00:00:00"


#: earliest time of all: differences to it are positive, so cutting them rounds down
_EARLIEST = "0001-01-01 00:00:00"


def seconds_since(ts: Column, base: str = TIME_BASE) -> Column:
    """Whole seconds from ``base`` to ``ts``, a ``timestamp_ntz``.

    The difference is taken as an interval: ``timestamp_diff`` would go through the
    session zone, where some wall-clock times do not exist.
    """
    return (ts - utc(base)).cast("interval second").cast("bigint")


def exact_seconds_since(ts: Column, base: str = TIME_BASE) -> Column:
    """Seconds with six decimals from ``base`` to ``ts``."""
    return (ts - utc(base)).cast("interval second").cast("decimal(20,6)")


def truncate(ts: Column, unit: str) -> Column:
    """Start of the ``SECOND``, ``MINUTE``, ``HOUR`` or ``DAY`` of ``ts``."""
    whole = (ts - utc(_EARLIEST)).cast(f"interval {unit.lower()}").cast("bigint")
    return F.timestamp_add(unit, whole, utc(_EARLIEST))


def from_offset_seconds(seconds: Column, base: str = TIME_BASE) -> Column:
    """``base`` plus ``seconds``, the fraction dropped; null if out of range."""
    whole = truncate_int(seconds)
    # the bound keeps the sum inside years 0-9999
    safe = F.when(F.abs(whole) < 60_000_000_000, whole)
    return F.timestamp_add("SECOND", safe, utc(base))


def parse_utc(text: Column, formats: tuple = TIME_FORMATS) -> Column:
    """Text to UTC: an offset at the end is applied, text without one is UTC already.

    ISO texts in whole seconds are told by their shape. Other ISO texts take patterns, and
    what is no ISO text is tried against ``formats`` in turn; that part is a lambda, which
    keeps it out of the generated code of the common case.
    """
    iso = text.like("____-__-__T__:__:__Z") | text.like("____-__-__T__:__:__") | text.like("____-__-__ __:__:__")
    shaped = F.substring(text, 1, 19).try_cast("timestamp_ntz")
    other = F.get(F.transform(F.array(text), lambda t: _parse_any(t, formats)), F.lit(0))
    return F.when(iso, shaped).otherwise(other)


def _parse_any(text: Column, formats: tuple) -> Column:
    # a time with an offset needs its seconds, so they are added where the first cast fails
    full = F.regexp_replace(text, r"([T ]\d\d:\d\d)(?=\s*(?:Z|UTC|GMT|[+-]))", "$1:00")
    instant = F.coalesce(text.try_cast("timestamp"), full.try_cast("timestamp"))
    iso = F.when(text.rlike(_ZONED), _wall(instant)).otherwise(text.try_cast("timestamp_ntz"))
    bare = F.concat(F.regexp_replace(text, r"^\s+|\s*(?:Z|UTC|GMT)?\s*$", ""), F.lit("Z"))
    return F.coalesce(iso, *[_wall(F.try_to_timestamp(bare, F.lit(f"{f}X"))) for f in formats])


def _wall(instant: Column) -> Column:
    """The UTC wall time of an instant, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), utc(_EPOCH))


def date_of_text(text: Column) -> Column:
    """Date part of an ISO date or date-time as written; null if unparsable."""
    return F.when(parse_utc(text).isNotNull(), text.try_cast("date"))


def date_of_parts(y: Column, m: Column, d: Column) -> Column:
    """Date from its parts; null for dates that do not exist."""
    zero = F.lit(0)
    return F.to_date(F.try_make_timestamp_ntz(y, m, d, zero, zero, zero))


def iso_text(ts: Column, zone: str = "") -> Column:
    """ISO text in whole seconds, plus ``zone`` (such as ``+00:00``)."""
    text = F.replace(F.substring(ts.cast("string"), 1, 19), F.lit(" "), F.lit("T"))
    return F.concat(text, F.lit(zone)) if zone else text


def whole_second(ts: Column) -> Column:
    """Nearest whole second, halves up, as a column without fraction stores it."""
    half_later = F.timestamp_add("MICROSECOND", F.lit(500_000), ts.cast("timestamp_ntz"))
    return truncate(half_later, "SECOND")
