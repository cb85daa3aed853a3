"""Typed schemas of the fifteen hospital tables.

Ids are LongType throughout (the driver's keys are BIGINT); ``ward_id``
is an INT like the nation key it comes from.  Nullability follows the
NOT NULL / PRIMARY KEY declarations of the workload's DDL.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I = T.StringType(), T.LongType(), T.IntegerType()
D, B, TS = T.DateType(), T.BooleanType(), T.TimestampNTZType()
DEC52, DEC102 = T.DecimalType(5, 2), T.DecimalType(10, 2)

#: partition column of tables landed by week; not part of a schema, kept where a file has it
WEEK = "_week"


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


SCHEMAS: dict[str, T.StructType] = {
    "department": _schema(
        ("dept_name", S, False), ("operating_hours", S, False), ("staff_headcount", I, True)),
    "ward": _schema(
        ("ward_id", I, False), ("ward_name", S, False), ("dept_name", S, False),
        ("ward_type", S, False), ("bed_capacity", I, True)),
    "bed": _schema(
        ("bed_id", L, False), ("ward_id", I, False), ("bed_length", DEC52, False),
        ("bed_width", DEC52, False), ("mattress_thickness", DEC52, False),
        ("comfort_level", S, True), ("bed_cost", DEC102, False), ("bed_status", S, True)),
    "staff": _schema(
        ("staff_id", L, False), ("full_name", S, False), ("email", S, True), ("mobile", S, False),
        ("address", S, False), ("salary", DEC102, False), ("dept_name", S, True),
        ("staff_type", S, False)),
    "doctor": _schema(
        ("doctor_id", L, False), ("medical_license_number", S, True),
        ("license_expiry_date", D, True), ("license_state", S, True)),
    "specialty": _schema(
        ("specialty_name", S, False), ("specialty_category", S, False),
        ("certification_required", B, True), ("min_years_training", I, False),
        ("description", S, True)),
    "doctorspecialty": _schema(
        ("doctor_id", L, False), ("specialty_name", S, False), ("training_date", D, False),
        ("proficiency_level", S, False), ("is_primary_specialty", B, True)),
    "nurse": _schema(
        ("nurse_id", L, False), ("wwcc_clearance", B, True), ("wwcc_expiry_date", D, True)),
    "patient": _schema(
        ("patient_id", L, False), ("full_name", S, False), ("email", S, False),
        ("address", S, False), ("date_of_birth", D, False), ("mobile", S, False),
        ("emergency_contact_name", S, False), ("emergency_contact_phone", S, False),
        ("insurance_number", S, False), ("blood_type", S, True), ("allergies", S, True)),
    "admission": _schema(
        ("admission_id", L, False), ("patient_id", L, False), ("admission_date", TS, False),
        ("admission_type", S, False), ("nurse_id", L, True), ("doctor_id", L, True),
        ("bed_id", L, True), ("discharge_date", D, True), ("primary_diagnosis", S, True),
        ("discharge_summary", S, True), ("discharge_disposition", S, True)),
    "plannedadmission": _schema(
        ("admission_id", L, False), ("referring_practitioner", S, False),
        ("reference_number", S, False)),
    "emergencyadmission": _schema(
        ("admission_id", L, False), ("triage_nurse_id", L, True),
        ("patient_condition", S, True), ("severity_level", S, True)),
    "billingstatement": _schema(
        ("billing_id", L, False), ("admission_id", L, False), ("discharge_date", D, False),
        ("services_description", S, True), ("total_cost", DEC102, False),
        ("insurance_covered_amount", DEC102, False), ("remaining_balance", DEC102, True)),
    "invoice": _schema(
        ("invoice_id", L, False), ("billing_id", L, False), ("issue_date", D, False),
        ("due_date", D, True), ("amount_due", DEC102, False), ("payment_status", S, True)),
    "payment": _schema(
        ("payment_id", L, False), ("invoice_id", L, False), ("payment_method", S, False),
        ("cardholder_name", S, True), ("card_last_four", S, True), ("card_type", S, True),
        ("payment_processor", S, True), ("transaction_id", S, True), ("payment_token", S, True),
        ("payment_date", D, False), ("payment_amount", DEC102, False), ("payment_status", S, True)),
}

TABLES = tuple(SCHEMAS)

# The value domains (CHECK ... IN lists) of the workload's DDL.
DOMAINS: dict[tuple[str, str], tuple[str, ...]] = {
    ("ward", "ward_type"): ("General", "ICU"),
    ("bed", "bed_status"): ("Available", "Occupied", "Maintenance", "Reserved"),
    ("staff", "staff_type"): ("Doctor", "Nurse", "Allied Health"),
    ("specialty", "specialty_category"): (
        "Surgical", "Medical", "Diagnostic", "Emergency", "Pediatric", "Other"),
    ("doctorspecialty", "proficiency_level"): ("Beginner", "Intermediate", "Advanced", "Expert"),
    ("patient", "blood_type"): ("A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-", "Unknown"),
    ("admission", "admission_type"): ("Planned", "Emergency"),
    ("admission", "discharge_disposition"): ("Home", "Transfer", "Deceased", "Against Medical Advice"),
    ("emergencyadmission", "severity_level"): ("Critical", "High", "Medium", "Low"),
    ("invoice", "payment_status"): ("Unpaid", "Partially Paid", "Paid", "Overdue", "Cancelled"),
    ("payment", "payment_method"): ("Credit Card", "Debit Card", "Insurance", "Cash", "Bank Transfer"),
    ("payment", "card_type"): ("Visa", "Mastercard", "Amex", "Discover", "Other"),
    ("payment", "payment_status"): ("Pending", "Completed", "Failed", "Refunded"),
}

# Column defaults of the DDL (applied when a field is absent).
DEFAULTS: dict[tuple[str, str], object] = {
    ("department", "staff_headcount"): 0,
    ("bed", "bed_status"): "Available",
    ("specialty", "certification_required"): True,
    ("doctorspecialty", "is_primary_specialty"): False,
    ("nurse", "wwcc_clearance"): False,
    ("invoice", "payment_status"): "Unpaid",
    ("payment", "payment_status"): "Completed",
}
# Dates defaulting to CURRENT_DATE (invoice.issue_date, payment.payment_date)
# take the loader's ``as_of`` instead.
DATE_DEFAULTS = (("invoice", "issue_date"), ("payment", "payment_date"))

# VARCHAR(n) limits of the DDL, checked as string-length rules.
MAX_LENGTHS: dict[tuple[str, str], int] = {
    ("department", "dept_name"): 100, ("department", "operating_hours"): 100,
    ("ward", "ward_name"): 100, ("ward", "dept_name"): 100, ("ward", "ward_type"): 20,
    ("bed", "comfort_level"): 50, ("bed", "bed_status"): 20,
    ("staff", "full_name"): 255, ("staff", "email"): 255, ("staff", "mobile"): 20,
    ("staff", "address"): 255, ("staff", "dept_name"): 100, ("staff", "staff_type"): 20,
    ("doctor", "medical_license_number"): 50, ("doctor", "license_state"): 50,
    ("specialty", "specialty_name"): 100, ("specialty", "specialty_category"): 50,
    ("doctorspecialty", "specialty_name"): 100, ("doctorspecialty", "proficiency_level"): 50,
    ("patient", "full_name"): 255, ("patient", "email"): 255, ("patient", "address"): 255,
    ("patient", "mobile"): 20, ("patient", "emergency_contact_name"): 255,
    ("patient", "emergency_contact_phone"): 20, ("patient", "insurance_number"): 100,
    ("patient", "blood_type"): 5,
    ("admission", "admission_type"): 20, ("admission", "primary_diagnosis"): 255,
    ("admission", "discharge_disposition"): 50,
    ("plannedadmission", "referring_practitioner"): 255, ("plannedadmission", "reference_number"): 100,
    ("emergencyadmission", "patient_condition"): 500, ("emergencyadmission", "severity_level"): 20,
    ("invoice", "payment_status"): 20,
    ("payment", "payment_method"): 50, ("payment", "cardholder_name"): 255, ("payment", "card_last_four"): 4,
    ("payment", "card_type"): 20, ("payment", "payment_processor"): 50, ("payment", "transaction_id"): 100,
    ("payment", "payment_token"): 255, ("payment", "payment_status"): 20,
}
