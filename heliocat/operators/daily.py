"""Daily means of a feed with several values per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from heliocat.functions.geomag import kp_to_ap
from heliocat.functions.numeric import round2

#: sums are exact in this type, so the mean does not depend on the order of rows
EXACT = "decimal(20,10)"


def exact_mean(value: Column) -> Column:
    """Mean over the values present, rounded once."""
    exact = value.try_cast(EXACT)
    return F.sum(exact).cast("double") / F.count(exact)


def daily_mean(df: DataFrame, date: str, value: str, name: str = "mean") -> DataFrame:
    return df.groupBy(F.col(date).alias("date")).agg(exact_mean(F.col(value)).alias(name))


def daily_kp(df: DataFrame, date: str = "date", kp: str = "kp") -> DataFrame:
    """``date, kp_index, ap_index``: Ap is taken from the mean before it is rounded."""
    return daily_mean(df, date, kp, "_mean").select(
        "date",
        round2(F.col("_mean")).alias("kp_index"),
        kp_to_ap(F.col("_mean")).alias("ap_index"),
    )
