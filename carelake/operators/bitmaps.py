"""Exact distinct counts that roll up.

``COUNT(DISTINCT x)`` cannot be added up: a coarser level needs the values again.  Here a set of integer
keys is held as bitmaps, one for each bucket of 32768 neighbouring keys (Spark's built-in bitmap
aggregates), which merge by OR.  The rows are read and shuffled once, at the finest level; every coarser
level, and any later question on stored bitmaps, works on bitmaps only and is exact.

A group's bitmaps are split by bucket, so no group, however large, is held by one task, and
one pass gives as many counted sets (all patients, those still in a bed) as there are conditions.  A
bitmap has 4 KB whether it is full or not: keys should be dense, or ``by`` coarse, as in counts of
persons per department; for sparse sets ``distinct()`` and a count need less.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_sets(df: DataFrame, value: str, by: Sequence[str], sets: dict[str, Column | None] | None = None) -> DataFrame:
    """``(by..., bucket, one bitmap per set)``: store it, or hand it to ``distinct_counts``.

    ``sets`` names conditions on the rows (None: all of them).  ``value`` is an integer column; NULLs
    count nowhere, and a bitmap is NULL where no row of its set fell into the bucket.
    """
    sets = sets or {"n": None}
    rows = df.where(F.col(value).isNotNull())
    at = F.bitmap_bit_position(F.col(value))
    return rows.groupBy(*by, F.bitmap_bucket_number(F.col(value)).alias("bucket")).agg(*[
        F.bitmap_construct_agg(at if cond is None else F.when(cond, at)).alias(name) for name, cond in sets.items()])


def distinct_counts(sets: DataFrame, levels: Sequence[Sequence[str]], by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``(by..., level, one count per set)`` for each of ``levels`` (subsets of ``by``), as GROUPING SETS would.

    ``level`` is GROUPING_ID(by): its bits, from the left, mark the columns that a row sums over.
    """
    cols = [F.col(c) for c in by]
    merged = sets.groupingSets([[F.col(c) for c in (*lv, "bucket")] for lv in levels], *cols, F.col("bucket")).agg(
        F.grouping_id().alias("_id"), *[F.bitmap_or_agg(F.coalesce(F.col(n), F.lit(b"").cast("binary"))).alias(n) for n in names])
    # the bucket is the last bit of the id and never summed over
    level = F.shiftright(F.col("_id"), 1).cast("int").alias("level")
    return merged.groupBy(*by, level).agg(*[F.sum(F.bitmap_count(n)).cast("bigint").alias(n) for n in names])


def rollup_levels(by: Sequence[str]) -> list[list[str]]:
    """The levels of ROLLUP(by)."""
    return [list(by[:i]) for i in range(len(by), -1, -1)]
