"""Audit questions: Q17 (data-quality scoreboard) and Q18 (activity feed)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions.dates import as_of_lit, midnight
from carelake.plans.common import attended_admissions, doctors_with_staff
from carelake.sources.catalog import since
from carelake.sources.roles import Hospital


def _count_issue(df: DataFrame, issue: str, table: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("issue_count")).select(
        F.lit(issue).alias("issue_type"), "issue_count", F.lit(table).alias("table_name"))


def data_quality_scoreboard(h: Hospital, as_of) -> DataFrame:
    """Q17: eight data-quality counts, one global aggregate each, unioned.

    NOT EXISTS becomes a left-anti join; the correlated COUNT(*) > 5 becomes a
    per-doctor count semi-joined to Doctor.
    """
    today = as_of_lit(as_of)
    # Anti-join build sides are de-duplicated first: a bed or doctor that
    # appears in many rows costs one row after map-side aggregation.
    active_beds = h.admission.filter(F.col("discharge_date").isNull() & F.col("bed_id").isNotNull()) \
        .select("bed_id").distinct()
    many = (h.doctorspecialty.groupBy("doctor_id").agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > 5))
    parts = [
        _count_issue(h.staff.filter(F.col("email").isNull()), "Missing Email", "Staff"),
        _count_issue(h.doctor.filter(F.col("license_expiry_date") < today),
                     "Expired Medical License", "Doctor"),
        _count_issue(h.nurse.filter((F.col("wwcc_clearance") == F.lit(True))
                                    & (F.col("wwcc_expiry_date") < today)), "Expired WWCC", "Nurse"),
        _count_issue(h.admission.filter(F.col("discharge_date").isNull()
                                        & (F.col("admission_date") < midnight(F.date_sub(today, 30)))),
                     "Admission without Discharge after 30 days", "Admission"),
        _count_issue(h.bed.filter(F.col("bed_status") == "Occupied").join(active_beds, "bed_id", "left_anti"),
                     "Bed Occupied but No Active Admission", "Bed"),
        _count_issue(h.invoice.filter((F.col("payment_status") == "Unpaid")
                                      & (F.col("due_date") < F.date_sub(today, 60))),
                     "Invoice Overdue >60 days", "Invoice"),
        _count_issue(h.doctor.join(h.doctorspecialty.select("doctor_id").distinct(), "doctor_id", "left_anti"),
                     "Doctor with No Specialties", "Doctor"),
        _count_issue(h.doctor.join(many, "doctor_id", "left_semi"), "Doctor with >5 Specialties", "Doctor"),
    ]
    out = reduce(DataFrame.unionByName, parts)
    return out.select("issue_type", F.col("issue_count").cast("bigint").alias("issue_count"), "table_name") \
        .orderBy(F.col("issue_count").desc())


def activity_feed(h: Hospital, as_of, limit: int = 50) -> DataFrame:
    """Q18: admissions, discharges and payments of the last 7 days, newest 50.

    Date filters sit on the scans (pushed to Parquet), so only the recent
    slice reaches the joins (and, on tables landed by week, only its partitions are read); ORDER BY + LIMIT is a per-partition top-k then a
    merge.  Ties break by activity and record id.
    """
    week_ago = F.date_sub(as_of_lit(as_of), 7)
    names = doctors_with_staff(h, "full_name").withColumnRenamed("full_name", "performed_by")
    patients = h.patient.select("patient_id", F.col("full_name").alias("related_to"))
    adm = attended_admissions(h, "admission_id", "patient_id", "discharge_date")
    recent_adm = (since(h, "admission", week_ago).filter(F.col("doctor_id").isNotNull())
                  .select("doctor_id", "admission_id", "patient_id", "admission_date").join(patients, "patient_id").join(names, "doctor_id")
                  .select(F.lit("Recent Admissions").alias("activity"),
                          F.col("admission_id").alias("record_id"), "related_to",
                          F.col("admission_date").alias("activity_date"),
                          F.lit("Created").alias("action"), "performed_by"))
    recent_dis = (adm.filter(F.col("discharge_date") >= week_ago)
                  .join(patients, "patient_id").join(names, "doctor_id")
                  .select(F.lit("Recent Discharges").alias("activity"),
                          F.col("admission_id").alias("record_id"), "related_to",
                          midnight(F.col("discharge_date")).alias("activity_date"),
                          F.lit("Discharged").alias("action"), "performed_by"))
    recent_pay = (since(h, "payment", week_ago).select("payment_id", "invoice_id", "payment_date")
                  .join(h.invoice.select("invoice_id", "billing_id"), "invoice_id")
                  .join(h.billingstatement.select("billing_id", "admission_id"), "billing_id")
                  .join(h.admission.select("admission_id", "patient_id"), "admission_id")
                  .join(patients, "patient_id")
                  .select(F.lit("Recent Payments").alias("activity"),
                          F.col("payment_id").alias("record_id"), "related_to",
                          midnight(F.col("payment_date")).alias("activity_date"),
                          F.lit("Payment Received").alias("action"), F.lit("System").alias("performed_by")))
    feed = recent_adm.unionByName(recent_dis).unionByName(recent_pay)
    return feed.orderBy(F.col("activity_date").desc(), F.col("activity").asc(), F.col("record_id").asc()) \
        .limit(limit)
