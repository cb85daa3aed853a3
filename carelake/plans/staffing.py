"""Staffing questions: Q1, Q4, Q8, Q10, Q14.

The as-written SQL joins Doctor with DoctorSpecialty *and* Admission in
one FROM clause, so every admission row is repeated once per specialty
and COUNT(DISTINCT ...) / SUM(...) then work on the multiplied rows.  Here
each branch is aggregated per doctor on its own and the per-doctor rows
are joined one-to-one; where the written SUM depends on the multiplication
(Q14) the multiplicity is applied arithmetically.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions.dates import as_of_lit, day_of, days_between
from carelake.functions.json import json_object, to_json_text
from carelake.functions.numeric import pct, round_half, safe_div
from carelake.operators.ranking import bucket_of, default_buckets
from carelake.plans.common import attended_admissions, doctors_with_staff, per_department, specialty_counts
from carelake.sources.roles import Hospital


def salary_ranking(h: Hospital) -> DataFrame:
    """Q1: doctors' salary rank within department (dense) and overall, vs department mean.

    Doctors are counted once per (department, salary).  Those rows are cut into salary
    ranges by an approximate sketch and dealt by range, so both ranks are running counts
    inside a range plus what the ranges above hold; no task has a whole department.  The
    table of ranges has departments x ranges rows and also gives the department means.
    The doctors are joined once.
    """
    docs = doctors_with_staff(h, "full_name", "dept_name", "salary")
    values = docs.groupBy("dept_name", "salary").agg(F.count(F.lit(1)).alias("n"))
    parts = default_buckets(docs)
    if parts > 1:
        cuts = values.select(F.percentile_approx(
            F.col("salary").cast("double"), [i / parts for i in range(1, parts)], 20 * parts)).scalar()
        values = values.withColumns({"_cuts": cuts, "_pay": F.col("salary").cast("double")})
        part = bucket_of("_cuts", "_pay", parts - 1)
    else:
        part = F.lit(0)
    dealt = values.withColumn("part", part).drop("_cuts", "_pay").repartition("part")
    totals = dealt.groupBy("part", "dept_name").agg(
        F.count(F.lit(1)).alias("d"), F.sum("n").alias("n"), F.sum(F.col("salary") * F.col("n")).alias("s"))
    above = Window.partitionBy("dept_name").orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    dept = Window.partitionBy("dept_name")
    upto = Window.orderBy(F.desc("part"))  # departments x ranges rows; a range's rows are peers
    ranges = totals.select(
        F.col("part").alias("_p"), F.col("dept_name").alias("_d"), F.coalesce(F.sum("d").over(above), F.lit(0)).alias("_above"),
        (F.sum("n").over(upto) - F.sum("n").over(Window.partitionBy("part"))).alias("_all_above"),
        (F.sum("s").over(dept).cast("double") / F.sum("n").over(dept)).alias("_avg"))
    here = Window.partitionBy("part", "dept_name").orderBy(F.desc("salary"))
    higher = (F.sum("n").over(Window.partitionBy("part").orderBy(F.desc("salary")))
              - F.sum("n").over(Window.partitionBy("part", "salary")))
    local = dealt.select("part", "dept_name", "salary", F.row_number().over(here).alias("_r"), higher.alias("_higher"))
    ranks = local.join(ranges, (F.col("part") == F.col("_p")) & F.col("dept_name").eqNullSafe(F.col("_d"))).select(
        F.col("dept_name").alias("_dept"), F.col("salary").alias("_salary"), "_avg",
        (F.col("_above") + F.col("_r")).cast("bigint").alias("salary_rank_in_dept"),
        (F.col("_all_above") + F.col("_higher") + 1).cast("bigint").alias("overall_salary_rank"))
    out = docs.join(ranks, F.col("dept_name").eqNullSafe(F.col("_dept")) & (F.col("salary") == F.col("_salary"))).select(
        F.col("full_name").alias("doctor_name"), "dept_name", "salary",
        "salary_rank_in_dept", "overall_salary_rank",
        round_half(F.col("_avg"), 2).alias("dept_avg_salary"),
        (F.col("salary").cast("double") - F.col("_avg")).alias("salary_vs_dept_avg"))
    return out.orderBy(F.col("dept_name").asc_nulls_last(), F.col("salary_rank_in_dept").asc())


def _doctor_admission_counts(h: Hospital) -> DataFrame:
    # admission_id is the Admission key (rule O-D2 checks it), so counting
    # ids per doctor equals COUNT(DISTINCT admission_id).
    return attended_admissions(h, "admission_id", "discharge_date").groupBy("doctor_id").agg(
        F.count("admission_id").alias("total_admissions"),
        F.count(F.when(F.col("discharge_date").isNull(), F.col("admission_id"))).alias("active_patients"))


def doctor_department_stats(h: Hospital) -> DataFrame:
    """Q4: per-doctor specialty/admission counts with department totals and share."""
    ds = (doctors_with_staff(h, "full_name", "dept_name")
          .join(specialty_counts(h), "doctor_id", "left")
          .join(_doctor_admission_counts(h), "doctor_id", "left")
          .select("doctor_id", "full_name", "dept_name",
                  F.coalesce("specialty_count", F.lit(0)).cast("bigint").alias("specialty_count"),
                  F.coalesce("total_admissions", F.lit(0)).cast("bigint").alias("total_admissions"),
                  F.coalesce("active_patients", F.lit(0)).cast("bigint").alias("active_patients")))
    dept = ds.filter(F.col("dept_name").isNotNull()).groupBy("dept_name").agg(
        F.avg("specialty_count").alias("_avg_spec"),
        F.sum("total_admissions").alias("dept_total_admissions"))
    out = ds.join(per_department(h, dept), "dept_name").select(
        "doctor_id", "full_name", "dept_name", "specialty_count", "total_admissions",
        "active_patients", F.col("_avg_spec").alias("dept_avg_specialties"),
        F.col("dept_total_admissions").cast("bigint").alias("dept_total_admissions"),
        pct(F.col("total_admissions"), F.col("dept_total_admissions")).alias("pct_of_dept_admissions"))
    return out.orderBy(F.col("dept_name").asc_nulls_last(), F.col("total_admissions").desc_nulls_first())


def _patients_per_doctor(h: Hospital) -> DataFrame:
    """Distinct patients per doctor, as a two-level aggregate (no Expand)."""
    pairs = attended_admissions(h, "patient_id").select("doctor_id", "patient_id").distinct()
    return pairs.groupBy("doctor_id").agg(F.count(F.lit(1)).alias("patient_count"))


def above_department_average(h: Hospital) -> DataFrame:
    """Q8: doctors treating more distinct patients than their department's average.

    Decorrelated: the average is over doctors *with* admissions (inner joins of
    the subquery); the compared count includes doctors without any (left join).
    A NULL department matches no average, so its doctors never qualify.
    """
    per_doc = _patients_per_doctor(h)
    staff = doctors_with_staff(h, "full_name", "dept_name")
    main = staff.join(per_doc, "doctor_id", "left").select(
        "doctor_id", "full_name", "dept_name",
        F.coalesce("patient_count", F.lit(0)).cast("bigint").alias("patients_treated"))
    dept_avg = (per_doc.join(staff.select("doctor_id", "dept_name"), "doctor_id")
                .filter(F.col("dept_name").isNotNull())
                .groupBy("dept_name").agg(F.avg("patient_count").alias("_avg")))
    out = (main.join(per_department(h, dept_avg), "dept_name")
           .filter(F.col("patients_treated") > F.col("_avg"))
           .select("full_name", "dept_name", "patients_treated",
                   round_half(F.col("_avg"), 2).alias("dept_avg_patients")))
    return out.orderBy(F.col("patients_treated").desc())


def doctor_profiles(h: Hospital) -> DataFrame:
    """Q10: one JSON profile per doctor.

    ``specialties`` holds each distinct specialty once, primary first then by
    name (the written JSON_AGG(DISTINCT ... ORDER BY) is not valid SQL; this is
    its intent).  A doctor without specialties gets one all-null entry, as the
    written LEFT JOIN produces.
    """
    spec = h.doctorspecialty.select(
        "doctor_id",
        F.struct(
            F.when(F.col("is_primary_specialty").isNull(), F.lit(-1))
            .when(F.col("is_primary_specialty"), F.lit(0)).otherwise(F.lit(1)).alias("k"),
            F.col("specialty_name").alias("name"),
            F.col("proficiency_level").alias("proficiency"),
            F.col("is_primary_specialty").alias("is_primary")).alias("s"))
    spec = spec.groupBy("doctor_id").agg(F.sort_array(F.collect_set("s")).alias("_specs"))
    entry = lambda s: F.struct(s["name"].alias("name"), s["proficiency"].alias("proficiency"),
                               s["is_primary"].alias("is_primary"))
    empty = F.array(F.struct(F.lit(None).cast("string").alias("name"),
                             F.lit(None).cast("string").alias("proficiency"),
                             F.lit(None).cast("boolean").alias("is_primary")))
    adm = attended_admissions(h, "admission_id", "patient_id", "discharge_date")
    pairs = adm.groupBy("doctor_id", "patient_id").agg(
        F.count(F.when(F.col("discharge_date").isNull(), F.col("admission_id"))).alias("_open"))
    counts = pairs.groupBy("doctor_id").agg(
        F.sum("_open").alias("active_patients"), F.count(F.lit(1)).alias("total_patients_treated"))
    base = (doctors_with_staff(h, "full_name", "dept_name", "salary", "email", "mobile",
                               doctor_cols=("medical_license_number",))
            .join(spec, "doctor_id", "left").join(counts, "doctor_id", "left"))
    profile = json_object(
        specialties=F.coalesce(F.transform("_specs", entry), empty),
        active_patients=F.coalesce("active_patients", F.lit(0)).cast("bigint"),
        total_patients_treated=F.coalesce("total_patients_treated", F.lit(0)).cast("bigint"),
        contact=json_object(email=F.col("email"), mobile=F.col("mobile")))
    out = base.select(F.col("full_name").alias("doctor_name"), "dept_name",
                      "salary", "medical_license_number",
                      to_json_text(profile).alias("doctor_profile"))
    return out.orderBy("doctor_name")


def workload_balance(h: Hospital, as_of) -> DataFrame:
    """Q14: current patients per doctor against department mean +/- one stddev.

    The written SUM of active patient-days runs over Admission x DoctorSpecialty
    rows, i.e. is multiplied by max(1, specialty count); kept as written.
    """
    adm = attended_admissions(h, "patient_id", "admission_date", "discharge_date")
    open_ = F.col("discharge_date").isNull()
    days = days_between(as_of_lit(as_of), day_of(F.col("admission_date")))
    pairs = adm.groupBy("doctor_id", "patient_id").agg(
        F.max(open_.cast("int")).alias("_open"), F.sum(F.when(open_, days)).alias("_days"))
    per_doc = pairs.groupBy("doctor_id").agg(
        F.sum("_open").alias("current_patients"), F.sum("_days").alias("_days"))
    spec = specialty_counts(h)
    dw = (doctors_with_staff(h, "full_name", "dept_name")
          .join(per_doc, "doctor_id", "left").join(spec, "doctor_id", "left")
          .select("doctor_id", "full_name", "dept_name",
                  F.coalesce("current_patients", F.lit(0)).cast("bigint").alias("current_patients"),
                  F.coalesce(F.col("_days") * F.greatest(F.coalesce("specialty_count", F.lit(0)), F.lit(1)),
                             F.lit(0)).cast("bigint").alias("active_patient_days"),
                  F.coalesce("specialty_count", F.lit(0)).cast("bigint").alias("specialty_count")))
    bench = dw.filter(F.col("dept_name").isNotNull()).groupBy("dept_name").agg(
        F.avg("current_patients").alias("_avg"), F.stddev_samp("current_patients").alias("_sd"))
    j = dw.join(per_department(h, bench), "dept_name")
    over = F.col("current_patients") > F.col("_avg") + F.col("_sd")
    under = F.col("current_patients") < F.col("_avg") - F.col("_sd")
    out = j.select(
        "full_name", "dept_name", "current_patients",
        round_half(F.col("_avg"), 2).alias("dept_avg_patients"),
        (F.col("current_patients") - F.col("_avg")).alias("variance_from_avg"),
        F.when(over, F.lit("OVERLOADED")).when(under, F.lit("UNDERUTILIZED"))
        .otherwise(F.lit("NORMAL")).alias("workload_status"),
        "active_patient_days",
        round_half(safe_div(F.col("active_patient_days"), F.col("current_patients")), 1)
        .alias("avg_days_per_patient"),
        "specialty_count",
        F.when(over, 1).when(under, 3).otherwise(2).alias("_bucket"))
    return out.orderBy("_bucket", F.col("current_patients").desc()).drop("_bucket")
