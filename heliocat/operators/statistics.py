"""Counts by class, year and instrument, and the range of times, in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from heliocat.functions.times import iso_text


def _finest(flares: DataFrame) -> DataFrame:
    """Counts per class, year and instrument together: the only pass over the rows.

    All later totals add up these few groups, so rows are not multiplied per total.
    """
    return flares.groupBy(
        F.substring("magnitude", 1, 1).alias("class"),
        F.year("event_start").alias("year"),
        "instrument",
    ).agg(
        F.count("*").alias("cnt"),
        F.min("event_start").alias("from"),
        F.max("event_start").alias("to"),
    )


def _rolled_up(flares: DataFrame) -> DataFrame:
    names = ["class", "year", "instrument"]
    fine = _finest(flares)
    sets = [[], *[[fine[n]] for n in names]]
    rolled = fine.groupingSets(sets, *[fine[n] for n in names]).agg(
        F.sum("cnt").alias("cnt"),
        F.min("from").alias("from"),
        F.max("to").alias("to"),
        F.grouping_id().alias("gid"),
    )
    kind = (
        F.when(F.col("gid") == 7, "total")
        .when(F.col("gid") == 3, "class")
        .when(F.col("gid") == 5, "year")
        .otherwise("instrument")
    )
    key = F.coalesce("class", F.col("year").cast("string"), "instrument")
    return rolled.select(kind.alias("kind"), key.alias("key"), "cnt", "from", "to").filter(
        # rows without a magnitude count everywhere but in the classes
        (F.col("kind") != "class") | F.col("key").isNotNull()
    )


def stats_long(flares: DataFrame) -> DataFrame:
    """``kind, key, cnt``: the total and the counts of each kind, one row each."""
    return _rolled_up(flares).select("kind", "key", "cnt")


def _as_map(kind: str, newest: Column | None = None) -> Column:
    """Counts of one kind as a map in the order of its keys, or of ``newest``."""
    entry = F.struct(
        (newest if newest is not None else F.lit(0)).alias("rank"),
        F.coalesce("key", F.lit("null")).alias("key"),
        F.col("cnt").alias("value"),
    )
    entries = F.array_sort(F.collect_list(F.when(F.col("kind") == kind, entry)))
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], e["value"])))


def stats(flares: DataFrame) -> DataFrame:
    """All statistics as one row: total, three maps and the range of starts.

    The maps hold one entry per class, year or instrument. An empty table gives a
    total of 0, empty maps and null bounds.
    """
    total = F.col("kind") == "total"
    return _rolled_up(flares).agg(
        F.coalesce(F.max(F.when(total, F.col("cnt"))), F.lit(0)).alias("total_flares"),
        _as_map("class").alias("by_class"),
        _as_map("year").alias("by_year"),
        _as_map("instrument", -F.col("cnt")).alias("by_instrument"),
        F.struct(
            iso_text(F.max(F.when(total, F.col("from")))).alias("from"),
            iso_text(F.max(F.when(total, F.col("to")))).alias("to"),
        ).alias("date_range"),
    )


def count_by_class(flares: DataFrame, magnitude: str = "magnitude") -> DataFrame:
    """Rows without a magnitude count nowhere."""
    return (
        flares.groupBy(F.substring(magnitude, 1, 1).alias("class"))
        .agg(F.count(magnitude).alias("cnt"))
        .filter("cnt > 0")
        .orderBy("class")
    )


def count_by_year(flares: DataFrame, start: str = "event_start") -> DataFrame:
    return (
        flares.groupBy(F.year(start).alias("year")).agg(F.count("*").alias("cnt")).orderBy("year")
    )


def count_by_instrument(flares: DataFrame, instrument: str = "instrument") -> DataFrame:
    """Most frequent first."""
    return (
        flares.groupBy(instrument)
        .agg(F.count("*").alias("cnt"))
        .orderBy(F.desc("cnt"), instrument)
    )


def total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("cnt"))
