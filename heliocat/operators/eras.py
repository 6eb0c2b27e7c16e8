"""Trimming overlapping eras and uniting them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from heliocat.constants import GOES_19_START
from heliocat.functions.times import utc


def before(df: DataFrame, end: str, column: str = "event_start") -> DataFrame:
    """Rows that start before ``end``; null starts drop out."""
    return df.filter(F.col(column) < utc(end))


def trim_counts(df: DataFrame, end: str, column: str = "event_start") -> DataFrame:
    """One row: rows kept and removed by ``before``."""
    kept = F.coalesce(F.col(column) < utc(end), F.lit(False))
    return df.agg(F.count_if(kept).alias("kept"), F.count_if(~kept).alias("removed"))


def union_sources(*frames: DataFrame, rank: str | None = "source_rank") -> DataFrame:
    """Union by column name; ``rank`` numbers the sources in the order given."""
    if rank:
        frames = tuple(df.withColumn(rank, F.lit(i)) for i, df in enumerate(frames))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_eras(
    catalog: DataFrame,
    middle: DataFrame,
    last: DataFrame,
    last_start: str = GOES_19_START,
    rank: str | None = "source_rank",
) -> DataFrame:
    """Catalog (already cut), the middle era up to the last one's start, and the last era."""
    return union_sources(catalog, before(middle, last_start), last, rank=rank)


def bounds(df: DataFrame, *by: str, column: str = "event_start") -> DataFrame:
    """Earliest and latest time, overall or per group."""
    return df.groupBy(*by).agg(F.min(column).alias("from"), F.max(column).alias("to"))
