"""Rounding, casting and null rules for numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round2(x: Column) -> Column:
    """Two decimals, exact ties to even, judged on the true binary value as Python's ``round`` does.

    ``x * 100`` is itself rounded. That matters only where the product lands on a
    half: there its error says on which side ``x`` lies. With 100 = 64 + 32 + 4 every
    step of the error is exact, as scaling by powers of two is, and so are
    differences of numbers within a factor of two.
    """
    product = x * 100.0
    error = ((x * 64.0 - product) + x * 32.0) + x * 4.0
    on_half = F.abs(product - F.rint(product)) == 0.5
    whole = F.when(on_half, F.rint(product + F.signum(error) * 0.25)).otherwise(F.rint(product))
    return whole / 100.0


def round_half_up(x: Column, digits: int) -> Column:
    """``floor(x * 10^digits + 0.5) / 10^digits``; the same IEEE steps in every engine."""
    scale = F.lit(float(10**digits))
    return F.floor(x * scale + 0.5).cast("double") / scale


def round_to_int(x: Column) -> Column:
    """Nearest integer, halves away from zero; null if it does not fit."""
    whole = F.signum(x) * F.floor(F.abs(x) + 0.5)
    return whole.try_cast("int")


def truncate_int(x: Column) -> Column:
    """Drop the fraction; null if it does not fit a long."""
    return x.try_cast("long")


def null_if_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def fill_masked(x: Column, fill) -> Column:
    """Masked cells take their fill value."""
    return F.coalesce(x, F.lit(fill))


def float_text(x: Column, small: Column | None = None) -> Column:
    """Decimal text of a double rounded to two places: ``5.7``, ``12.0``.

    ``small`` may stand in for the test that ``x`` is below 1e7, from where on a cast
    gives an exponent.
    """
    small = F.abs(x) < 1e7 if small is None else small
    long_text = F.regexp_replace(x.try_cast("decimal(38,2)").cast("string"), "0$", "")
    return F.when(small, x.cast("string")).otherwise(long_text)
