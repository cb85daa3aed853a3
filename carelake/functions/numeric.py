"""Numeric column helpers.

The reference workload computes ratios in exact decimal arithmetic and
rounds half away from zero.  Doubles carry binary noise (2.345 is stored
as 2.34499...), so rounding them directly can fall on the wrong side of a
tie.  ``round_half`` first snaps the double to 10 decimals (far below any
output precision used here, far above double noise for these magnitudes)
and then rounds the decimal, which gives the decimal answer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half(x: Column, digits: int) -> Column:
    """Round half away from zero, as exact decimal arithmetic would; DOUBLE out."""
    snapped = x.cast("double").cast("decimal(38,10)")
    return F.round(snapped, digits).cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)`` computed in DOUBLE; NULL for a zero or NULL denominator."""
    return F.try_divide(num.cast("double"), F.nullif(den.cast("double"), F.lit(0.0)))


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage share ``part / NULLIF(whole, 0) * 100`` rounded to ``digits``."""
    return round_half(safe_div(part, whole) * F.lit(100.0), digits)


def money(x: Column) -> Column:
    """Monetary output column: exact, with 2 decimals."""
    return x.cast("decimal(38,2)")
