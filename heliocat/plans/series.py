"""Series behind the report charts: projections of the rows, in no order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from heliocat.constants import CLASS_LEVELS
from heliocat.functions.flux import calibrate


def flux_series(events: DataFrame, *by: str) -> DataFrame:
    """Peak flux over time."""
    return events.select(*by, "event_peak", "xrsb_flux_peak")


def calibration_series(renamed: DataFrame) -> DataFrame:
    """Corrected and raw flux over time, on the same rows."""
    return renamed.select(
        "event_peak", calibrate(F.col("raw_flux")).alias("corrected_flux"), "raw_flux"
    )


def level_series(events: DataFrame) -> DataFrame:
    """Peak flux over time with the reference levels of the letter scale."""
    return events.select(
        "event_peak",
        "xrsb_flux_peak",
        *[F.lit(level).alias(name) for name, level in CLASS_LEVELS],
    )
