"""Daily lookup feeds: sunspot number, F10.7 flux and Kp.

Each reader returns ``date``, the feed's own columns and ``seq``, the order of
arrival, which decides when a date comes twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heliocat.functions.numeric import null_if_nan, round_to_int
from heliocat.functions.texts import trim_blank
from heliocat.functions.times import date_of_parts, date_of_text
from heliocat.operators.daily import daily_kp
from heliocat.schemas import F10_7_FEED, KP_FEED

SUNSPOT_LABEL = "SILSO"


def _arrival() -> Column:
    """Increases along a file: file, then block, then place in the block."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_sunspots(spark: SparkSession, path: str) -> DataFrame:
    return parse_sunspots(spark.read.text(path).withColumn("seq", _arrival()))


def parse_sunspots(lines: DataFrame) -> DataFrame:
    """``value`` lines ``Y;M;D;decimal;number;...`` to ``date, sunspot_number, source, seq``.

    Blank lines, comments, short lines, unparsable fields, days that do not exist and
    negative numbers (no data) are skipped.
    """
    part = F.split("value", ";")
    field = lambda i: trim_blank(F.get(part, F.lit(i)))
    return (
        lines.filter((F.col("value") != "") & ~F.col("value").startswith("#"))
        .filter(F.size(part) >= 5)
        .select(
            date_of_parts(*[field(i).try_cast("int") for i in range(3)]).alias("date"),
            null_if_nan(field(4).try_cast("double")).alias("number"),
            "seq",
        )
        .filter(F.col("date").isNotNull() & (F.col("number") >= 0))
        .select(
            "date",
            round_to_int(F.col("number")).alias("sunspot_number"),
            F.lit(SUNSPOT_LABEL).alias("source"),
            "seq",
        )
    )


def read_f10_7(spark: SparkSession, path: str) -> DataFrame:
    records = spark.read.schema(F10_7_FEED).option("multiLine", True).json(path)
    return parse_f10_7(records.withColumn("seq", _arrival()))


def parse_f10_7(records: DataFrame) -> DataFrame:
    """``time_tag, flux`` records to ``date, f10_7_flux, seq``; a record with a gap is skipped."""
    return records.select(
        date_of_text(F.col("time_tag")).alias("date"),
        null_if_nan(F.col("flux").try_cast("double")).alias("f10_7_flux"),
        "seq",
    ).filter("date IS NOT NULL AND f10_7_flux IS NOT NULL")


def read_kp(spark: SparkSession, path: str) -> DataFrame:
    """Daily ``date, kp_index, ap_index`` of a 3-hour feed."""
    return parse_kp(spark.read.schema(KP_FEED).option("multiLine", True).json(path))


def parse_kp(records: DataFrame) -> DataFrame:
    usable = records.select(
        date_of_text(F.col("time_tag")).alias("date"),
        null_if_nan(F.col("Kp").try_cast("double")).alias("kp"),
    ).filter("date IS NOT NULL AND kp IS NOT NULL")
    # one row per date is left, so any constant order does
    return daily_kp(usable, "date", "kp").withColumn("seq", F.lit(0))
