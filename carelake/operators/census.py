"""Occupancy census from stay intervals.

The daily number of occupied beds is a running sum of +1 on the admission
day and -1 on the day after discharge.  Stays are never expanded into
their days (an open stay can last years); the per-day deltas are
pre-aggregated map-side and only the few thousand distinct days meet in
the final running-sum window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions.dates import as_of_lit


def daily_census(admission: DataFrame, as_of) -> DataFrame:
    """``(day, in_house)``: admissions in a bed at any time that day, for days up to
    ``as_of`` with at least one.

    A stay occupies its admission day through its discharge day; open stays
    run to ``as_of``.  Only admissions with a bed count.
    """
    stays = admission.filter(F.col("bed_id").isNotNull()).select(
        F.to_date("admission_date").alias("start"),
        F.coalesce(F.col("discharge_date"), as_of_lit(as_of)).alias("end"))
    stays = stays.filter(F.col("start") <= as_of_lit(as_of))
    deltas = (stays.select(F.col("start").alias("day"), F.lit(1).alias("d"))
              .unionByName(stays.select(F.date_add("end", 1).alias("day"), F.lit(-1).alias("d")))
              .groupBy("day").agg(F.sum("d").alias("d")))
    # Calendar spine from the first stay to as_of: one row per day, bounded
    # by the calendar span, so days without events still get their count.
    first = stays.select(F.min("start")).scalar()
    spine = admission.sparkSession.range(1).select(
        F.explode(F.sequence(first, as_of_lit(as_of))).alias("day"))
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    daily = spine.join(deltas, "day", "left").select(
        "day", F.sum(F.coalesce("d", F.lit(0))).over(w).cast("bigint").alias("in_house"))
    return daily.filter(F.col("in_house") > 0)
