"""Billing questions: Q6 (ROLLUP, plus CUBE / GROUPING SETS), Q11, Q15."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions.dates import as_of_lit, day_of, days_between, month_start
from carelake.functions.json import iso_timestamp, json_object, to_json_text
from carelake.functions.numeric import money, pct, round_half, safe_div
from carelake.operators.chunks import joined_arrays
from carelake.operators.joins import left_join_salted_nulls
from carelake.plans.common import attended_admissions, bills, doctors_with_staff
from carelake.sources.roles import Hospital


def _revenue_by_doctor_type(h: Hospital) -> DataFrame:
    """Admissions x bill (0..1) pre-aggregated per (doctor, type), then tagged with department.

    The grouping-set expansion then runs over one row per (doctor, type)
    instead of one per admission.
    """
    a = attended_admissions(h, "admission_id", "admission_type")
    per = (a.join(bills(h, "total_cost"), "admission_id", "left")
           .groupBy("doctor_id", "admission_type")
           .agg(F.count("admission_id").alias("_n"), F.sum("total_cost").alias("_s"),
                F.count("total_cost").alias("_c")))
    return per.join(doctors_with_staff(h, "dept_name"), "doctor_id")


def _revenue_cube(grouped) -> DataFrame:
    r = grouped.agg(
        F.sum("_n").alias("_n"), F.sum("_s").alias("_s"), F.sum("_c").alias("_c"),
        F.grouping("dept_name").cast("int").alias("dept_grouping_level"),
        F.grouping("admission_type").cast("int").alias("type_grouping_level"))
    return r.select(
        F.coalesce(F.col("dept_name"), F.lit("ALL DEPARTMENTS")).alias("department"),
        F.coalesce(F.col("admission_type"), F.lit("ALL TYPES")).alias("admission_type"),
        F.col("_n").cast("bigint").alias("total_admissions"),
        round_half(safe_div(F.col("_s"), F.col("_c")), 2).alias("avg_cost"),
        money(F.col("_s")).alias("total_revenue"),
        "dept_grouping_level", "type_grouping_level")


def revenue_rollup(h: Hospital) -> DataFrame:
    """Q6: admissions and revenue by ROLLUP(department, admission type).

    Labels follow the written COALESCE, so a real NULL department on a leaf row
    also reads 'ALL DEPARTMENTS'; the grouping columns tell them apart.
    """
    out = _revenue_cube(_revenue_by_doctor_type(h).rollup("dept_name", "admission_type"))
    return out.orderBy("dept_grouping_level", "type_grouping_level", "department", "admission_type")


def revenue_cube(h: Hospital) -> DataFrame:
    """Q6 variant: the same measures by CUBE(department, admission type)."""
    out = _revenue_cube(_revenue_by_doctor_type(h).cube("dept_name", "admission_type"))
    return out.orderBy("dept_grouping_level", "type_grouping_level", "department", "admission_type")


def revenue_grouping_sets(h: Hospital) -> DataFrame:
    """Q6 variant: GROUPING SETS ((department), (admission type), ())."""
    base = _revenue_by_doctor_type(h)
    keys = [F.col("dept_name"), F.col("admission_type")]
    out = _revenue_cube(base.groupingSets([[keys[0]], [keys[1]], []], *keys))
    return out.orderBy("dept_grouping_level", "type_grouping_level", "department", "admission_type")


def patient_summary(h: Hospital, as_of) -> DataFrame:
    """Q11: every patient with admission types, doctors seen, charges and a JSON history.

    Admissions with no doctor are spread over shuffle partitions by a salt
    (``left_join_salted_nulls``) rather than piling into one, in a single
    pass.  Histories are put together by month and then by patient, whose text is the one
    thing that must fit a task (``networks.history_chunks`` gives histories in pieces).  A patient without admissions has NULL
    types, doctors and history (aggregates over no rows), 0 visits and charges.
    """
    names = doctors_with_staff(h, "full_name").withColumnRenamed("full_name", "doctor")
    a = h.admission.select("admission_id", "patient_id", "admission_type", "admission_date",
                           "discharge_date", "primary_diagnosis", "doctor_id")
    a = left_join_salted_nulls(a, names.withColumnRenamed("doctor_id", "_doc_id"), "doctor_id", "_doc_id")
    a = a.join(bills(h, "total_cost", "insurance_covered_amount", "remaining_balance"), "admission_id", "left")
    stay = days_between(F.coalesce(F.col("discharge_date"), as_of_lit(as_of)), day_of(F.col("admission_date")))
    item = F.struct(
        F.col("admission_date").alias("_t"), F.col("admission_id").alias("_id"),
        json_object(admission_date=iso_timestamp(F.col("admission_date")),
                    type=F.col("admission_type"), diagnosis=F.col("primary_diagnosis"),
                    doctor=F.col("doctor"), length_of_stay=stay).alias("_v"))
    # a patient's rows meet by month first: a long history is spread over as many groups, and what
    # comes together for a patient are sums, short lists and the texts of months
    newest_first = F.transform(F.sort_array(F.collect_list(item), asc=False), lambda x: x["_v"])
    months = a.groupBy("patient_id", month_start(F.col("admission_date")).alias("_month")).agg(
        F.collect_set("admission_type").alias("_types"), F.collect_set("doctor").alias("_names"),
        F.count("admission_id").alias("_n"), F.sum("total_cost").alias("_c"),
        F.sum("insurance_covered_amount").alias("_i"), F.sum("remaining_balance").alias("_b"),
        to_json_text(newest_first).alias("_text"))
    every = lambda c: F.sort_array(F.array_distinct(F.flatten(F.collect_list(c))))
    per = months.groupBy("patient_id").agg(
        every("_types").alias("admission_types"), every("_names").alias("_docs"), F.sum("_n").alias("total_visits"),
        F.sum("_c").alias("_tc"), F.sum("_i").alias("_ic"), F.sum("_b").alias("_rb"),
        joined_arrays("_month", "_text", descending=True).alias("_hist"))
    p = h.patient.select("patient_id", "full_name", "blood_type", "allergies").join(per, "patient_id", "left")
    out = p.select(
        "patient_id", "full_name", "blood_type", "allergies",
        F.when(F.size("admission_types") > 0, F.col("admission_types")).alias("admission_types"),
        F.when(F.size("_docs") > 0, F.array_join("_docs", ", ")).alias("doctors_seen"),
        F.coalesce("total_visits", F.lit(0)).cast("bigint").alias("total_visits"),
        money(F.coalesce(F.col("_tc"), F.lit(0))).alias("lifetime_charges"),
        money(F.coalesce(F.col("_ic"), F.lit(0))).alias("insurance_paid"),
        money(F.coalesce(F.col("_rb"), F.lit(0))).alias("patient_owes"),
        F.col("_hist").alias("admission_history"))
    return out.orderBy(F.col("total_visits").desc(), "full_name")


def monthly_revenue(h: Hospital) -> DataFrame:
    """Q15: revenue, collections and month-over-month growth per department.

    The written FROM clause repeats each bill once per (invoice, completed
    payment) row, so SUM(total_cost) counts a bill m times with
    m = sum over its invoices of max(1, completed payments) (1 with no
    invoice).  m is computed per bill and applied as a weight: no row is
    multiplied, and every stage stays a per-key aggregate.
    """
    paid = (h.payment.filter(F.col("payment_status") == "Completed")
            .groupBy("invoice_id").agg(F.count(F.lit(1)).alias("_np"), F.sum("payment_amount").alias("_ps")))
    inv = (h.invoice.select("invoice_id", "billing_id").join(paid, "invoice_id", "left")
           .groupBy("billing_id").agg(F.sum(F.greatest(F.coalesce("_np", F.lit(0)), F.lit(1))).alias("_m"),
                                      F.sum("_ps").alias("_paid")))
    # per (doctor, month) first: doctors and departments are joined to those sums
    b = (h.billingstatement.select("billing_id", "admission_id", "discharge_date", "total_cost",
                                   "insurance_covered_amount", "remaining_balance")
         .join(attended_admissions(h, "admission_id"), "admission_id").join(inv, "billing_id", "left")
         .withColumn("_m", F.coalesce("_m", F.lit(1)).cast("decimal(10,0)")))
    names = ("bills_issued", "_billed", "_ins", "_owed", "_recv")
    per_doc = b.groupBy("doctor_id", month_start(F.col("discharge_date")).alias("billing_month")).agg(
        F.count("billing_id").alias("bills_issued"),
        F.sum(F.col("total_cost") * F.col("_m")).alias("_billed"),
        F.sum(F.col("insurance_covered_amount") * F.col("_m")).alias("_ins"),
        F.sum(F.col("remaining_balance") * F.col("_m")).alias("_owed"),
        F.coalesce(F.sum("_paid"), F.lit(0).cast("decimal(10,2)")).alias("_recv"))
    s = per_doc.join(doctors_with_staff(h, "dept_name"), "doctor_id").groupBy("billing_month", "dept_name").agg(
        *[F.sum(c).alias(c) for c in names])
    w = Window.partitionBy("dept_name").orderBy("billing_month")
    prev = F.lag("_billed").over(w)
    out = s.select(
        "billing_month", "dept_name", F.col("bills_issued").cast("bigint").alias("bills_issued"),
        money(F.col("_billed")).alias("total_billed"),
        money(F.col("_ins")).alias("insurance_collected"),
        money(F.col("_owed")).alias("patient_owed"),
        money(F.col("_recv")).alias("payments_received"),
        money(F.col("_owed") - F.col("_recv")).alias("outstanding_balance"),
        pct(F.col("_recv"), F.col("_owed")).alias("collection_rate_pct"),
        round_half(safe_div(F.col("_billed"), F.col("bills_issued")), 2).alias("avg_bill_amount"),
        money(prev).alias("previous_month_revenue"),
        money(F.col("_billed") - prev).alias("month_over_month_change"),
        pct(F.col("_billed") - prev, prev).alias("mom_growth_pct"))
    return out.orderBy(F.col("billing_month").desc(), F.col("dept_name").asc_nulls_last())
