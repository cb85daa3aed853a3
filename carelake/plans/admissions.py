"""Admission-flow questions: Q2, Q3, Q7, Q9, Q12, Q13, Q19 and the census.

Windows without PARTITION BY appear only after an aggregation to one row
per day or month, where the row count is bounded by the calendar span.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions.dates import (as_of_lit, day_of, days_between, epoch_seconds,
                                      midnight, month_start)
from carelake.functions.numeric import money, pct, round_half, safe_div
from carelake.operators.census import daily_census
from carelake.operators.ranking import percentile_cont
from carelake.operators.sequence import first_after
from carelake.plans.common import attended_admissions, bills, doctors_with_staff
from carelake.sources.roles import Hospital


def _monthly_counts(h: Hospital, count_name: str) -> DataFrame:
    return (h.admission.select(month_start(F.col("admission_date")).alias("month"))
            .groupBy("month").agg(F.count(F.lit(1)).alias(count_name)))


def monthly_admissions(h: Hospital) -> DataFrame:
    """Q2: admissions per month, running total and 3-month moving average."""
    w = Window.orderBy("month")
    m = _monthly_counts(h, "admissions_this_month")
    return m.select(
        "month", "admissions_this_month",
        F.sum("admissions_this_month").over(w.rowsBetween(Window.unboundedPreceding, 0))
        .cast("bigint").alias("cumulative_admissions"),
        F.avg("admissions_this_month").over(w.rowsBetween(-2, 0)).alias("three_month_moving_avg")).orderBy("month")


def daily_occupancy(h: Hospital, calendar_days: bool = False) -> DataFrame:
    """Q3: admissions per admission day over the bed count, with a 7-row rolling mean.

    As written this is admissions *that day* per bed (D6), and the rolling mean
    spans 7 rows, not 7 calendar days (D7); ``calendar_days=True`` gives the
    RANGE variant over the 7 calendar days ending on each date.  The bed count
    is one uncorrelated scalar subquery.
    """
    total_beds = h.bed.select(F.count(F.lit(1))).scalar()
    a = h.admission
    day = day_of(F.col("admission_date"))
    daily = (a.filter(F.col("discharge_date").isNull() | (F.col("discharge_date") >= day))
             .groupBy(day.alias("date")).agg(F.count(F.lit(1)).alias("admissions")))
    daily = daily.select("date", "admissions", total_beds.cast("bigint").alias("total_beds"),
                         pct(F.col("admissions"), total_beds).alias("occupancy_rate"))
    if calendar_days:
        w = Window.orderBy(F.unix_date("date")).rangeBetween(-6, 0)
    else:
        w = Window.orderBy("date").rowsBetween(-6, 0)
    return daily.select("*", round_half(F.avg("occupancy_rate").over(w), 2).alias("rolling_7day_avg")) \
        .orderBy(F.col("date").desc())


def patient_admission_pivot(h: Hospital) -> DataFrame:
    """Q7: per patient with 2+ admissions, counts and costs pivoted by admission type."""
    a = h.admission.select("admission_id", "patient_id", "admission_type", "admission_date", "discharge_date")
    j = a.join(bills(h, "total_cost"), "admission_id", "left")
    emerg, planned = F.col("admission_type") == "Emergency", F.col("admission_type") == "Planned"
    los = F.when(F.col("discharge_date").isNotNull(),
                 days_between(F.col("discharge_date"), day_of(F.col("admission_date"))))
    per = j.groupBy("patient_id").agg(
        F.count(F.when(emerg, 1)).alias("emergency_admissions"),
        F.count(F.when(planned, 1)).alias("planned_admissions"),
        F.count(F.lit(1)).alias("total_admissions"),
        F.sum(F.when(emerg, F.col("total_cost"))).alias("_ec"),
        F.sum(F.when(planned, F.col("total_cost"))).alias("_pc"),
        F.sum(los).alias("_los"), F.count(los).alias("_n_los"))
    per = per.filter(F.col("total_admissions") > 1)
    out = h.patient.select("patient_id", "full_name").join(per, "patient_id").select(
        "patient_id", "full_name", "emergency_admissions", "planned_admissions", "total_admissions",
        money(F.col("_ec")).alias("emergency_costs"),
        money(F.col("_pc")).alias("planned_costs"),
        round_half(safe_div(F.col("_los"), F.col("_n_los")), 1).alias("avg_length_of_stay_days"))
    return out.orderBy(F.col("total_admissions").desc())


def latest_admissions_per_doctor(h: Hospital, k: int = 3) -> DataFrame:
    """Q9: each doctor's ``k`` most recent admissions (LATERAL ... LIMIT k).

    ROW_NUMBER <= k is planned as a WindowGroupLimit that already trims each
    doctor to k rows before the shuffle, so a busy doctor costs k rows per
    map task.  Patient names are joined after the cut: patient_id is a
    NOT NULL foreign key, so the inner join inside the lateral never drops a
    row.  Ties on the timestamp break by admission id.
    """
    a = attended_admissions(h, "admission_id", "patient_id", "admission_date", "admission_type",
                            "primary_diagnosis")
    w = Window.partitionBy("doctor_id").orderBy(F.col("admission_date").desc(), F.col("admission_id").desc())
    top = a.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
    out = (top.join(h.patient.select("patient_id", F.col("full_name").alias("patient_name")), "patient_id")
           .join(doctors_with_staff(h, "full_name").withColumnRenamed("full_name", "doctor_name"),
                 "doctor_id")
           .select("doctor_name", "patient_name", "admission_date", "admission_type", "primary_diagnosis"))
    return out.orderBy("doctor_name", F.col("admission_date").desc())


def cost_stay_percentiles(h: Hospital, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Q12: cost and length-of-stay distribution per admission type.

    Percentiles are exact by default.  ``exact=False`` switches, explicitly, to
    ``percentile_approx`` sketches (rank error about 1/``accuracy``), the cheap
    large-data variant; the two are never mixed.
    """
    # The largest join runs once: its result is reduced to one row per (type, cost, stay) with
    # a count, and the statistics and both distributions are read from those rows.
    rows = (h.admission.filter(F.col("discharge_date").isNotNull())
            .select("admission_id", "admission_type",
                    days_between(F.col("discharge_date"), day_of(F.col("admission_date"))).alias("length_of_stay"))
            .join(bills(h, "total_cost"), "admission_id", "left"))
    m = rows.groupBy("admission_type", "total_cost", "length_of_stay").agg(F.count(F.lit(1)).alias("_k"))
    cost = F.col("total_cost").cast("double")
    long = m.select("admission_type", "_k", F.explode(F.array(
        F.struct(F.lit("cost").alias("metric"), cost.alias("v"), F.col("total_cost").alias("_c")),
        F.struct(F.lit("los").alias("metric"), F.col("length_of_stay").cast("double").alias("v"),
                 F.lit(None).cast("decimal(10,2)").alias("_c")))).alias("_m"))
    # one row per (type, metric, value): all later steps start from this exchange
    long = long.groupBy("admission_type", "_m.metric", "_m.v", "_m._c").agg(F.sum("_k").alias("n"))
    is_cost = F.col("metric") == "cost"
    stats = long.groupBy("admission_type").agg(
        F.sum(F.when(is_cost, F.col("n"))).alias("total_admissions"),
        F.sum(F.when(is_cost, F.col("_c") * F.col("n"))).alias("_s"),
        F.sum(F.when(is_cost & F.col("v").isNotNull(), F.col("n"))).alias("_n"),
        F.sum(F.when(~is_cost, F.col("v") * F.col("n"))).alias("_los"))
    mean = stats.select(F.col("admission_type").alias("_t"), (F.col("_s").cast("double") / F.col("_n")).alias("_avg"))
    off = F.col("v") - F.col("_avg")
    spread = (long.filter(is_cost & F.col("v").isNotNull()).join(F.broadcast(mean), F.col("admission_type") == F.col("_t"))
              .groupBy("admission_type").agg(F.sum(off * off * F.col("n")).alias("_ss")))
    stats = stats.join(spread, "admission_type", "left").select(
        "admission_type", "total_admissions", (F.col("_s").cast("double") / F.col("_n")).alias("_avg"),
        F.sqrt(F.try_divide(F.col("_ss"), F.nullif(F.col("_n") - 1, F.lit(0)))).alias("_sd"),
        (F.col("_los") / F.col("total_admissions")).alias("_avg_los"))
    fractions = {"_p25": 0.25, "_p50": 0.50, "_p75": 0.75, "_p90": 0.90}
    if exact:
        pc = percentile_cont(long, "v", ["admission_type", "metric"], fractions, weight="n", few_groups=True)
    else:
        ps = lambda c: F.percentile_approx(c, list(fractions.values()), accuracy)
        both = rows.groupBy("admission_type").agg(F.array(
            F.struct(F.lit("cost").alias("metric"), ps(F.col("total_cost").cast("double")).alias("ps")),
            F.struct(F.lit("los").alias("metric"), ps(F.col("length_of_stay").cast("double")).alias("ps"))).alias("_b"))
        pc = both.select("admission_type", F.explode("_b").alias("_b")).select(
            "admission_type", "_b.metric", *[F.col("_b.ps")[i].alias(n) for i, n in enumerate(fractions)])
    pick = lambda metric, c: F.max(F.when(F.col("metric") == metric, F.col(c)))
    wide = pc.groupBy("admission_type").agg(
        pick("cost", "_p25").alias("_p25"), pick("cost", "_p50").alias("_p50"),
        pick("cost", "_p75").alias("_p75"), pick("cost", "_p90").alias("_p90"),
        pick("los", "_p50").alias("_los50"))
    j = stats.join(wide, "admission_type", "left")
    return j.select(
        "admission_type", "total_admissions",
        round_half(F.col("_avg"), 2).alias("avg_cost"),
        round_half(F.col("_sd"), 2).alias("stddev_cost"),
        round_half(F.col("_p25"), 2).alias("cost_25th_percentile"),
        round_half(F.col("_p50"), 2).alias("cost_median"),
        round_half(F.col("_p75"), 2).alias("cost_75th_percentile"),
        round_half(F.col("_p90"), 2).alias("cost_90th_percentile"),
        round_half(F.col("_avg_los"), 1).alias("avg_length_of_stay"),
        round_half(F.col("_los50"), 1).alias("median_length_of_stay"))


READMISSION_LABELS = {  # fixed values: bucket labels and their sort rank
    None: ("No readmission within 30 days", 4),
    7: ("Readmitted within 7 days", 1),
    14: ("Readmitted within 14 days", 2),
    30: ("Readmitted within 30 days", 3),
}


def readmission_cohorts(h: Hospital, horizon_days: int = 30) -> DataFrame:
    """Q13: discharges bucketed by days to the first readmission within 30 days.

    Only each discharge's *first* readmission counts (ROW_NUMBER = 1), so the
    written self range join is replaced by ``first_after``, which never pairs
    admissions.  Days are whole days from the discharge date to the next
    admission (D1).
    """
    a = h.admission.select("patient_id", "admission_id", "admission_date", "discharge_date")
    anchors = a.filter(F.col("discharge_date").isNotNull()).select(
        "patient_id", "admission_id", "discharge_date", midnight(F.col("discharge_date")).alias("_dts"))
    events = a.select("patient_id", "admission_date")
    nxt = first_after(anchors, events, "patient_id", "_dts", "admission_date", horizon_days * 86400)
    days = days_between(day_of(F.col("next_t")), F.col("discharge_date"))
    label = (F.when(days.isNull(), F.lit(READMISSION_LABELS[None][0]))
             .when(days <= 7, F.lit(READMISSION_LABELS[7][0]))
             .when(days <= 14, F.lit(READMISSION_LABELS[14][0]))
             .otherwise(F.lit(READMISSION_LABELS[30][0])))
    rank = (F.when(days.isNull(), F.lit(4)).when(days <= 7, F.lit(1))
            .when(days <= 14, F.lit(2)).otherwise(F.lit(3)))
    b = nxt.select(label.alias("readmission_timeframe"), rank.alias("_rank"), "patient_id", "admission_id")
    # one distinct count: (bucket, patient) first, then count per bucket
    pats = (b.select("readmission_timeframe", "patient_id").distinct()
            .groupBy("readmission_timeframe").agg(F.count(F.lit(1)).alias("patient_count")))
    disc = b.groupBy("readmission_timeframe").agg(
        F.count("admission_id").alias("total_discharges"), F.min("_rank").alias("_rank"))
    out = disc.join(pats, "readmission_timeframe").select(
        "readmission_timeframe", "patient_count", "total_discharges",
        pct(F.col("patient_count"), F.col("total_discharges")).alias("readmission_rate"), "_rank")
    return out.orderBy("_rank").drop("_rank")


def trend_forecast(h: Hospital, as_of, months: int = 12) -> DataFrame:
    """Q19: linear trend of monthly admissions and a forecast for as_of + 1 month.

    The regression runs as a window over the monthly table (one row per month,
    bounded by the calendar), so no cross join with a one-row stats table.
    """
    m = _monthly_counts(h, "actual_admissions").withColumn("_x", epoch_seconds(F.col("month")))
    w = Window.partitionBy()
    slope = F.regr_slope("actual_admissions", "_x").over(w)
    icept = F.regr_intercept("actual_admissions", "_x").over(w)
    corr = F.corr("actual_admissions", "_x").over(w)
    nan_null = lambda c: F.when(~F.isnan(c), c)
    target = epoch_seconds(F.add_months(as_of_lit(as_of), 1))
    out = m.select(
        "month", F.col("actual_admissions").cast("bigint").alias("actual_admissions"),
        round_half(nan_null(slope * F.col("_x") + icept), 2).alias("predicted_admissions"),
        round_half(nan_null(corr), 4).alias("correlation_coefficient"),
        round_half(nan_null(slope * target + icept), 0).alias("next_month_forecast"))
    return out.orderBy(F.col("month").desc()).limit(months)


def bed_census(h: Hospital, as_of) -> DataFrame:
    """O-A8 census: beds in use per calendar day (stays as intervals, D6's intent)."""
    return daily_census(h.admission, as_of).orderBy("day")
