"""Regression and correlation from mergeable moments.

A day's (n, sum x, sum y, sum xy, sum x*x, sum y*y) say all that REGR_* and CORR need, and those of
days add up to those of any range.  Stored once a day, they answer a range, a month or a
moving year without its rows.  Sums are decimals: they are the same however they are merged, and the
differences of large sums keep their digits.  x and y are taken to 4 places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAMES = ("n", "sx", "sy", "sxy", "sxx", "syy")
_EXACT = "decimal(38,8)"


def moments(df: DataFrame, x: Column, y: Column, by: Sequence[str | Column] = ()) -> DataFrame:
    """One row per ``by`` with the moments of the rows whose x and y are both known."""
    both = x.isNotNull() & y.isNotNull()
    d = lambda c: F.when(both, c.cast("decimal(18,4)"))
    zero = F.lit(0).cast(_EXACT)
    s = lambda c: F.coalesce(F.sum(c).cast(_EXACT), zero)
    return df.groupBy(*by).agg(F.count_if(both).alias("n"), s(d(x)).alias("sx"), s(d(y)).alias("sy"), s(d(x) * d(y)).alias("sxy"),
                               s(d(x) * d(x)).alias("sxx"), s(d(y) * d(y)).alias("syy"))


def merged(stored: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Moments of coarser groups from those of finer ones."""
    return stored.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(stored.schema[c].dataType).alias(c) for c in NAMES])


def regression() -> dict[str, Column]:
    """slope, intercept, r, r2 and the means from the moment columns; NULL where SQL's functions are NULL.

    Centred sums are ``(n * sum x*y - sum x * sum y) / n``, exact in decimals; where those products outgrow
    32 digits (NULL from the try functions) ``sum x*y - sum x * mean y`` with 14 places of the mean, which loses
    nothing that matters beside sums of that size.
    """
    n = F.nullif(F.col("n"), F.lit(0)).cast("decimal(18,0)")
    total = lambda c: F.col(c).cast("decimal(28,4)")
    mean = lambda c: total(c) / n

    def centred(ab: str, a: str, b: str) -> Column:
        exact = F.try_subtract(F.try_multiply(n, F.col(ab)), F.try_multiply(total(a), total(b))).cast("double")
        return F.coalesce(exact / n.cast("double"), (F.col(ab) - total(a) * mean(b)).cast("double"))

    ssx, ssy, sxy = centred("sxx", "sx", "sx"), centred("syy", "sy", "sy"), centred("sxy", "sx", "sy")
    nz = lambda c: F.nullif(c, F.lit(0.0))
    slope = F.try_divide(sxy, nz(ssx))
    mean_x, mean_y = mean("sx").cast("double"), mean("sy").cast("double")
    r = F.try_divide(sxy, nz(F.sqrt(ssx) * F.sqrt(ssy)))
    return {"slope": slope, "intercept": mean_y - slope * mean_x, "r": r, "r2": r * r, "mean_x": mean_x, "mean_y": mean_y}
