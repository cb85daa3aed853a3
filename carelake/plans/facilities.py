"""Departments, wards and beds: Q5, Q16, Q20 and the headcount refresh (O-S7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions.dates import day_of, days_between
from carelake.functions.numeric import money, pct, round_half, safe_div
from carelake.operators.hierarchy import expand_levels
from carelake.plans.common import attended_admissions, bills
from carelake.sources.roles import Hospital


def department_hierarchy(h: Hospital, max_depth: int = 1) -> DataFrame:
    """Q5: departments under the 24-hour department, depth-capped recursion.

    Every department reports to the departments that keep 24 hours, so the parent
    key is the hours those keep.
    """
    hours = F.col("operating_hours")
    reports_to = F.when(F.col("dept_name").isNotNull(), F.lit("24 Hours"))
    out = expand_levels(h.department, "dept_name", hours, reports_to, hours == "24 Hours", max_depth)
    return out.select("dept_name", F.col("root_dept_name").alias("root_dept"),
                      F.col("level").cast("int").alias("level"), "path")


def ward_utilisation(h: Hospital) -> DataFrame:
    """Q16: beds, staff and open admissions per ward, with occupancy percent rank.

    The written query joins Ward x Bed x Staff(department) x open Admission,
    i.e. beds x staff x admissions rows per ward.  Each side is aggregated on
    its own key instead; with m = max(1, open admissions of a bed) and
    S = max(1, department staff), the written measures are
    AVG(bed_cost) = sum(cost*m)/sum(m) and SUM(bed_cost) = sum(cost*m)*S,
    and the distinct counts are plain counts.  A bedless ward gets NULL
    occupancy (the written division by zero).
    """
    open_adm = (h.admission.filter(F.col("discharge_date").isNull() & F.col("bed_id").isNotNull())
                .groupBy("bed_id").agg(F.count("admission_id").alias("_open")))
    beds = h.bed.select("bed_id", "ward_id", "bed_cost", "bed_status").join(open_adm, "bed_id", "left")
    m = F.greatest(F.coalesce("_open", F.lit(0)), F.lit(1)).cast("decimal(20,0)")
    per_ward = beds.groupBy("ward_id").agg(
        F.count("bed_id").alias("total_beds"),
        F.count(F.when(F.col("bed_status") == "Occupied", F.col("bed_id"))).alias("occupied_beds"),
        F.coalesce(F.sum("_open"), F.lit(0)).alias("current_admissions"),
        F.sum(F.col("bed_cost") * m).alias("_cm"), F.sum(m).alias("_m"))
    staff = (h.staff.filter(F.col("dept_name").isNotNull())
             .groupBy("dept_name").agg(F.count("staff_id").alias("staff_assigned")))
    w = (h.ward.join(h.department.select("dept_name"), "dept_name")
         .join(per_ward, "ward_id", "left").join(staff, "dept_name", "left"))
    n_beds = F.coalesce("total_beds", F.lit(0))
    n_staff = F.coalesce("staff_assigned", F.lit(0))
    ratio = safe_div(F.coalesce("occupied_beds", F.lit(0)), n_beds)
    out = w.select(
        "ward_name", "ward_type", "dept_name",
        n_beds.cast("bigint").alias("total_beds"),
        F.coalesce("occupied_beds", F.lit(0)).cast("bigint").alias("occupied_beds"),
        round_half(ratio * 100, 2).alias("occupancy_rate"),
        n_staff.cast("bigint").alias("staff_assigned"),
        F.coalesce("current_admissions", F.lit(0)).cast("bigint").alias("current_admissions"),
        round_half(safe_div(F.coalesce("current_admissions", F.lit(0)), n_staff), 2)
        .alias("patients_per_staff_member"),
        round_half(safe_div(F.col("_cm"), F.col("_m")), 2).alias("avg_bed_cost"),
        money(F.col("_cm") * F.greatest(n_staff, F.lit(1))).alias("total_bed_inventory_value"),
        ratio.alias("_ratio"))
    # One row per ward: the unpartitioned window sees at most the ward count.
    pr = F.percent_rank().over(Window.orderBy(F.col("_ratio").asc_nulls_last()))
    out = out.select("*", pr.alias("occupancy_percentile")).drop("_ratio")
    return out.orderBy(F.col("occupancy_rate").desc_nulls_first())


def department_dashboard(h: Hospital) -> DataFrame:
    """Q20: staff, beds, admissions, revenue and ranks per department.

    Department x Staff x Doctor x Admission x Bill has one row per admission
    (plus one per non-doctor staff), so sums need no weights; admissions are
    aggregated per doctor first and rolled up to departments.
    """
    los = days_between(F.col("discharge_date"), day_of(F.col("admission_date")))
    per_doc = (attended_admissions(h, "admission_id", "admission_date", "discharge_date")
               .join(bills(h, "total_cost"), "admission_id", "left")
               .groupBy("doctor_id").agg(
                   F.count("admission_id").alias("_adm"),
                   F.count(F.when(F.col("discharge_date").isNull(), F.col("admission_id"))).alias("_act"),
                   F.sum("total_cost").alias("_rev"), F.sum(los).alias("_los"), F.count(los).alias("_nlos")))
    staff = h.staff.filter(F.col("dept_name").isNotNull())
    dept_adm = (h.doctor.select("doctor_id")
                .join(staff.select("staff_id", "dept_name"), F.col("doctor_id") == F.col("staff_id"))
                .join(per_doc, "doctor_id")
                .groupBy("dept_name").agg(*[F.sum(c).alias(c) for c in ("_adm", "_act", "_rev", "_los", "_nlos")]))
    counts = staff.groupBy("dept_name").agg(
        F.count("staff_id").alias("total_staff"),
        F.count(F.when(F.col("staff_type") == "Doctor", F.col("staff_id"))).alias("doctors"),
        F.count(F.when(F.col("staff_type") == "Nurse", F.col("staff_id"))).alias("nurses"))
    per_ward = h.bed.groupBy("ward_id").agg(
        F.count("bed_id").alias("_b"),
        F.count(F.when(F.col("bed_status") == "Available", 1)).alias("_av"),
        F.count(F.when(F.col("bed_status") == "Occupied", 1)).alias("_oc"))
    beds = (h.ward.select("ward_id", "dept_name").join(per_ward, "ward_id")
            .groupBy("dept_name").agg(F.sum("_b").alias("_b"), F.sum("_av").alias("_av"), F.sum("_oc").alias("_oc")))
    d = (h.department.select("dept_name").join(counts, "dept_name", "left")
         .join(dept_adm, "dept_name", "left").join(beds, "dept_name", "left"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    occ = pct(z("_oc"), z("_b"))
    rev = F.coalesce(F.col("_rev"), F.lit(0).cast("decimal(20,2)"))
    out = d.select(
        "dept_name", z("total_staff").alias("total_staff"), z("doctors").alias("doctors"),
        z("nurses").alias("nurses"), z("_b").alias("total_beds"), z("_av").alias("available_beds"),
        occ.alias("occupancy_rate"), z("_adm").alias("total_admissions"),
        z("_act").alias("active_admissions"),
        round_half(safe_div(z("_act"), z("doctors")), 2).alias("patients_per_doctor"),
        round_half(safe_div(z("_act"), z("nurses")), 2).alias("patients_per_nurse"),
        money(rev).alias("total_revenue"),
        round_half(safe_div(rev, z("_adm")), 2).alias("revenue_per_admission"),
        round_half(F.coalesce(safe_div(F.col("_los"), F.col("_nlos")), F.lit(0.0)), 1).alias("avg_length_of_stay"),
        F.when(occ > 90, F.lit("HIGH UTILIZATION")).when(occ > 70, F.lit("OPTIMAL"))
        .when(occ > 50, F.lit("MODERATE")).otherwise(F.lit("LOW UTILIZATION")).alias("utilization_status"),
        rev.alias("_rev_key"))
    # One row per department: ranking windows over the department count.
    out = out.select(
        "*",
        F.rank().over(Window.orderBy(F.col("_rev_key").desc())).cast("bigint").alias("revenue_rank"),
        F.rank().over(Window.orderBy(F.col("total_admissions").desc())).cast("bigint").alias("admission_rank"))
    return out.orderBy(F.col("_rev_key").desc()).drop("_rev_key")


def refresh_headcount(h: Hospital) -> DataFrame:
    """O-S7: Department with staff_headcount recomputed as staff per department."""
    n = h.staff.filter(F.col("dept_name").isNotNull()).groupBy("dept_name").agg(F.count(F.lit(1)).alias("_n"))
    return (h.department.drop("staff_headcount").join(n, "dept_name", "left")
            .select("dept_name", "operating_hours",
                    F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("staff_headcount")))
