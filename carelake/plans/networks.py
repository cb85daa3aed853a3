"""Queries that the workload only sketches: recursion without a depth, all readmission pairs, row frames
over all payments, histories in chunks, distinct counts and regressions from mergeable parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions.dates import day_of, days_between, midnight
from carelake.functions.json import iso_timestamp, json_object
from carelake.functions.numeric import money, round_half, safe_div
from carelake.operators import moments as mm
from carelake.operators.band_join import following
from carelake.operators.bitmaps import distinct_counts, distinct_sets, rollup_levels
from carelake.operators.chunks import ordered_chunks
from carelake.operators.frames import Frames, numbered
from carelake.operators.recursion import walk
from carelake.plans.common import attended_admissions, bills, doctors_with_staff
from carelake.sources.roles import Hospital

#: patients below it were referred by nobody; every other one by a patient of a third of its number
FIRST_PATIENTS = 4
#: every so many patients also referred the patient three steps above them, which closes a cycle
CYCLE_EVERY = 97


def referrals(h: Hospital) -> tuple[DataFrame, DataFrame]:
    """(roots, edges) of who referred whom: a tree as deep as the logarithm of the patients, with cycles."""
    p = h.patient.select(F.col("patient_id").alias("p"))
    by = lambda steps: F.call_function("div", F.col("p"), F.lit(3 ** steps))
    tree = p.where(F.col("p") >= FIRST_PATIENTS).select(by(1).alias("parent"), F.col("p").alias("child"))
    back = p.where((F.col("p") % CYCLE_EVERY == 0) & (by(2) >= FIRST_PATIENTS)).select(
        F.col("p").alias("parent"), by(3).alias("child"))
    return p.where(F.col("p") < FIRST_PATIENTS).select(F.col("p").alias("node")), tree.unionByName(back)


def referral_network(h: Hospital, folder: str | None = None) -> DataFrame:
    """O-U3, O-C2: everybody that the first patients' referrals reach, with path, level and cycle mark."""
    roots, edges = referrals(h)
    found = walk(roots, edges, folder)
    return found.select(
        F.col("node").alias("patient_id"), F.col("root").alias("root_patient"), F.col("parent").alias("referred_by"),
        F.col("level").cast("int").alias("level"), F.array_join(F.transform("path", lambda x: x.cast("string")), " > ").alias("path"),
        "is_cycle")


def readmission_pairs(h: Hospital, horizon_days: int = 30) -> DataFrame:
    """O-J5: each discharge with every readmission within 30 days after it, numbered; one row with NULLs if none.

    The first CTE of Q13 as it stands: later admissions of the patient after the
    discharge day's midnight and at most 30 days after it.
    """
    a = h.admission
    discharges = a.where(F.col("discharge_date").isNotNull()).select(
        "patient_id", F.col("admission_id").alias("first_admission"), F.col("discharge_date").alias("first_discharge"),
        midnight(F.col("discharge_date")).alias("_from"))
    later = a.select("patient_id", F.col("admission_id").alias("next_admission"),
                     F.col("admission_date").alias("next_admission_date"))
    pairs = following(discharges, later, "patient_id", "_from", "next_admission_date", horizon_days * 86400)
    order = Window.partitionBy("first_admission").orderBy("next_admission_date", "next_admission")
    return pairs.select(
        "patient_id", "first_admission", "first_discharge", "next_admission", "next_admission_date",
        days_between(day_of(F.col("next_admission_date")), F.col("first_discharge")).alias("days_until_readmission"),
        F.row_number().over(order).cast("bigint").alias("readmission_sequence"))


def payment_frames(h: Hospital, block: int = 100_000) -> DataFrame:
    """O-W9 to O-W11, O-W7 on rows: all payments by date with running total, means of 3 and 7 rows, and change."""
    paid = h.payment.select("payment_id", "payment_date", "payment_amount")
    rows = numbered(paid, ["payment_date", "payment_id"], place="payment_number")
    x = F.col("payment_amount")
    f = Frames(rows, place="payment_number", block=block).running_sum("_total", "payment_amount")
    f.lag("_previous", "payment_amount")
    for k in (3, 7):
        f.moving(f"_sum{k}", F.sum(x), k - 1).moving(f"_n{k}", F.count(x), k - 1)
    return f.result().select(
        "payment_id", "payment_date", "payment_number", money(x).alias("payment_amount"),
        money(F.col("_total")).alias("running_total"),
        *[safe_div(F.col(f"_sum{k}"), F.col(f"_n{k}")).alias(f"moving_avg_{k}") for k in (3, 7)],
        money(F.col("_previous")).alias("previous_amount"), money(x - F.col("_previous")).alias("change"))


def history_chunks(h: Hospital, size: int = 4) -> DataFrame:
    """O-A27 for patients of any history: the admissions of a patient by time, ``size`` to a JSON value."""
    a = h.admission.select("patient_id", "admission_id", "admission_date", "discharge_date", "admission_type", "primary_diagnosis")
    item = json_object(admission_date=iso_timestamp(F.col("admission_date")), type=F.col("admission_type"),
                       diagnosis=F.col("primary_diagnosis"))
    return ordered_chunks(a, "patient_id", ["admission_date", "admission_id"], item, size, [
        F.min("admission_date").alias("first_admission"), F.max("admission_date").alias("last_admission"),
        F.count("discharge_date").alias("discharges")]).withColumnRenamed("items", "history")


def distinct_patients(h: Hospital) -> DataFrame:
    """O-A5, O-A6 at every level of ROLLUP(department, type): different patients, and those not discharged, in one pass."""
    a = attended_admissions(h, "patient_id", "admission_type", "discharge_date").join(
        doctors_with_staff(h, "dept_name"), "doctor_id")
    by = ["dept_name", "admission_type"]
    sets = distinct_sets(a, "patient_id", by, {"patients": None, "patients_in_house": F.col("discharge_date").isNull()})
    return distinct_counts(sets, rollup_levels(by), by, ["patients", "patients_in_house"])


def stay_moments(h: Hospital) -> DataFrame:
    """Moments of (length of stay, cost) per admission type and day: what O-A22 to O-A24 need for any range."""
    a = h.admission.select("admission_id", "admission_type", "admission_date", "discharge_date").join(
        bills(h, "total_cost"), "admission_id")
    stay = days_between(F.col("discharge_date"), day_of(F.col("admission_date")))
    return mm.moments(a, stay, F.col("total_cost"), ["admission_type", day_of(F.col("admission_date")).alias("day")])


def cost_by_stay(h: Hospital) -> DataFrame:
    """O-A22, O-A23 from stored moments: cost on length of stay per admission type and quarter, and for all of each type."""
    stored = stay_moments(h)
    quarter = F.date_trunc("quarter", F.col("day").cast("timestamp_ntz")).cast("timestamp_ntz")
    per_quarter = mm.merged(stored, ["admission_type", quarter.alias("quarter")])
    whole = mm.merged(per_quarter, ["admission_type"]).withColumn("quarter", F.lit(None).cast("timestamp_ntz"))
    r = mm.regression()
    return per_quarter.unionByName(whole).select(
        "admission_type", "quarter", F.col("n").cast("bigint").alias("stays"), round_half(r["slope"], 6).alias("cost_per_day"),
        round_half(r["intercept"], 4).alias("base_cost"), round_half(r["r"], 8).alias("correlation"),
        round_half(r["mean_x"], 6).alias("mean_stay"), round_half(r["mean_y"], 4).alias("mean_cost"))
