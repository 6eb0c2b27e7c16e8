"""Flux calibration and the letter scale."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from heliocat.constants import FLUX_CLASSES, LEGACY_CORRECTION_FACTOR
from heliocat.functions.numeric import float_text, round2


def calibrate(flux: Column, factor: float = LEGACY_CORRECTION_FACTOR) -> Column:
    """Legacy flux on the scale of the newer instruments."""
    return flux / F.lit(factor)


def _by_class(flux: Column, pick) -> Column:
    """``pick(letter, multiplier)`` for the first class whose bound exceeds the flux."""
    *bounded, last = FLUX_CLASSES
    known = flux.isNotNull() & ~F.isnan(flux)
    return reduce(
        lambda rest, c: F.when(flux < c[1] * 10, pick(c[0], c[2])).otherwise(rest),
        reversed(bounded),
        F.when(known, pick(last[0], last[2])),
    )


def class_letter(flux: Column) -> Column:
    """Letter of the class; null for a null or NaN flux."""
    return _by_class(flux, lambda letter, _: F.lit(letter))


def class_number(flux: Column) -> Column:
    """Number inside the class, two decimals; the letter is chosen before rounding."""
    return round2(flux * _by_class(flux, lambda _, multiplier: F.lit(multiplier)))


def classify_flux(flux: Column) -> Column:
    """``struct(letter, sub)``."""
    return F.struct(class_letter(flux).alias("letter"), class_number(flux).alias("sub"))


def magnitude(flux: Column) -> Column:
    """Magnitude text such as ``C5.7``; null for a null or NaN flux."""
    return F.concat(class_letter(flux), _number_text(flux, class_number(flux)))


def _number_text(flux: Column, number: Column) -> Column:
    # below this flux no multiplier takes the number to 1e7
    return float_text(number, small=F.abs(flux) < 0.05)


def add_magnitude(df: DataFrame, flux: str, name: str = "magnitude") -> DataFrame:
    """``magnitude`` as a column of its own, in steps: one expression would repeat
    the flux some hundred times."""
    scaled = F.col(flux) * _by_class(F.col(flux), lambda _, multiplier: F.lit(multiplier))
    text = F.concat(class_letter(F.col(flux)), _number_text(F.col(flux), F.col("_number")))
    return (
        df.withColumn("_scaled", scaled)
        .withColumn("_number", round2(F.col("_scaled")))
        .withColumn(name, text)
        .drop("_scaled", "_number")
    )
