"""Building blocks shared by several queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.sources.roles import Hospital


def doctors_with_staff(h: Hospital, *cols: str, doctor_cols: tuple[str, ...] = ()) -> DataFrame:
    """``Doctor JOIN Staff ON doctor_id = staff_id`` keeping ``doctor_id``, ``doctor_cols`` and staff ``cols``."""
    staff = h.staff.select("staff_id", *cols)
    return (h.doctor.select("doctor_id", *doctor_cols)
            .join(staff, F.col("doctor_id") == F.col("staff_id")).drop("staff_id"))


def attended_admissions(h: Hospital, *cols: str) -> DataFrame:
    """Admissions with a doctor (a NULL doctor never matches an inner join)."""
    return h.admission.filter(F.col("doctor_id").isNotNull()).select("doctor_id", *cols)


def bills(h: Hospital, *cols: str) -> DataFrame:
    return h.billingstatement.select("admission_id", *cols)


SMALL_BYTES = 10 << 20


def per_department(h: Hospital, stats: DataFrame) -> DataFrame:
    """``stats`` (one row per department) as the broadcast side of a join, as long as the
    Department table, by its files' size, is small; beyond that the planner chooses.

    Without the hint both sides are shuffled on the few department names before the
    planner learns how small this one is.
    """
    size = int(h.department._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(stats) if size <= SMALL_BYTES else stats


def specialty_counts(h: Hospital) -> DataFrame:
    """Distinct specialties per doctor."""
    return h.doctorspecialty.groupBy("doctor_id").agg(
        F.countDistinct("specialty_name").alias("specialty_count"))
