"""Interval joins that emit their pairs.

``following`` pairs every left row with the right rows of its key inside a time span after it, the
textbook self join ``r.t > l.t AND r.t <= l.t + span``.  Joined on the key alone, a hot key
would compare all its rows with each other in one task.  Here time is part of the key: a left row
belongs to the one block of ``span / slices`` that holds it, and a right row is copied to its own block
and the ``slices`` before it, so that each pair meets in exactly one (key, block).  The join is an
equi-join on both with the exact bounds in its ON clause, so left rows without a partner stay
(LEFT JOIN), a hot key is spread over its blocks, and AQE splits a block that is hot by itself.

More ``slices`` compare fewer pairs outside the span (1 + 1/slices times the pairs of the answer
on even data) for more copies of right rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def following(left: DataFrame, right: DataFrame, key: str, left_t: str, right_t: str, span_seconds: int,
              slices: int = 2, outer: bool = True) -> DataFrame:
    """Left rows with the right rows of their key for which ``left_t < right_t <= left_t + span_seconds``.

    Times are timestamps, compared to the microsecond.  Columns are those of ``left``, then those of
    ``right`` without its key; their names must differ.  With ``outer`` a left row without a partner
    stays with NULLs.  A NULL key or time pairs with nothing; such left rows don't pass through the
    join at all, so they can't pile up in one of its partitions.
    """
    span = int(span_seconds) * 1_000_000
    width = max(1, -(-span // slices))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    usable = F.col(key).isNotNull() & F.col(left_t).isNotNull()
    r = right.where(F.col(key).isNotNull() & F.col(right_t).isNotNull()).withColumnsRenamed({key: "_rkey"}).withColumn(
        "_rt", micros(right_t))
    own = F.floor(F.col("_rt") / width)
    r = r.withColumn("_rblock", F.explode(F.sequence(own - slices, own)))
    lt = left.where(usable).withColumn("_lt", micros(left_t))
    lt = lt.withColumn("_lblock", F.floor(F.col("_lt") / width))
    on: Column = ((F.col(key) == F.col("_rkey")) & (F.col("_lblock") == F.col("_rblock"))
                  & (F.col("_rt") > F.col("_lt")) & (F.col("_rt") <= F.col("_lt") + span))
    names = [c for c in right.columns if c != key]
    pairs = lt.join(r, on, "left" if outer else "inner").select(*left.columns, *names)
    if not outer:
        return pairs
    rest = left.where(~usable).select(*left.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in names])
    return pairs.unionByName(rest)
