"""The schema rules as DuckDB SQL, written out by hand.

Nothing here is derived from ``rules.py``: a rule that is missing or wrong there shows
as a difference.  Fixed values throughout: the columns, limits, domains and keys that
the schema declares, table by table.
"""

from __future__ import annotations

from carelake.sources.roles_sql import DRIVER_AS_OF_SQL as TODAY
from carelake.sources.roles_sql import with_roles

#: primary key, then the other columns that must not be NULL
REQUIRED = """
department: dept_name / operating_hours
ward: ward_id / ward_name dept_name ward_type
bed: bed_id / ward_id bed_length bed_width mattress_thickness bed_cost
staff: staff_id / full_name mobile address salary staff_type
doctor: doctor_id /
specialty: specialty_name / specialty_category min_years_training
doctorspecialty: doctor_id specialty_name / training_date proficiency_level
nurse: nurse_id /
patient: patient_id / full_name email address date_of_birth mobile emergency_contact_name emergency_contact_phone insurance_number
admission: admission_id / patient_id admission_date admission_type
plannedadmission: admission_id / referring_practitioner reference_number
emergencyadmission: admission_id /
billingstatement: billing_id / admission_id discharge_date total_cost insurance_covered_amount
invoice: invoice_id / billing_id issue_date amount_due
payment: payment_id / invoice_id payment_method payment_date payment_amount
"""

LONGEST = """
department: dept_name 100 operating_hours 100
ward: ward_name 100 dept_name 100 ward_type 20
bed: comfort_level 50 bed_status 20
staff: full_name 255 email 255 mobile 20 address 255 dept_name 100 staff_type 20
doctor: medical_license_number 50 license_state 50
specialty: specialty_name 100 specialty_category 50
doctorspecialty: specialty_name 100 proficiency_level 50
patient: full_name 255 email 255 address 255 mobile 20 emergency_contact_name 255 emergency_contact_phone 20 insurance_number 100 blood_type 5
admission: admission_type 20 primary_diagnosis 255 discharge_disposition 50
plannedadmission: referring_practitioner 255 reference_number 100
emergencyadmission: patient_condition 500 severity_level 20
invoice: payment_status 20
payment: payment_method 50 cardholder_name 255 card_last_four 4 card_type 20 payment_processor 50 transaction_id 100 payment_token 255 payment_status 20
"""

ALLOWED = """
ward.ward_type: General, ICU
bed.bed_status: Available, Occupied, Maintenance, Reserved
staff.staff_type: Doctor, Nurse, Allied Health
specialty.specialty_category: Surgical, Medical, Diagnostic, Emergency, Pediatric, Other
doctorspecialty.proficiency_level: Beginner, Intermediate, Advanced, Expert
patient.blood_type: A+, A-, B+, B-, AB+, AB-, O+, O-, Unknown
admission.admission_type: Planned, Emergency
admission.discharge_disposition: Home, Transfer, Deceased, Against Medical Advice
emergencyadmission.severity_level: Critical, High, Medium, Low
invoice.payment_status: Unpaid, Partially Paid, Paid, Overdue, Cancelled
payment.payment_method: Credit Card, Debit Card, Insurance, Cash, Bank Transfer
payment.card_type: Visa, Mastercard, Amex, Discover, Other
payment.payment_status: Pending, Completed, Failed, Refunded
"""

#: family, column and what a violating row fulfils
BROKEN = f"""
range department.staff_headcount: staff_headcount < 0
range ward.bed_capacity: bed_capacity <= 0
range bed.bed_length: bed_length <= 0 OR bed_length > 2.13
range bed.bed_width: bed_width <= 0 OR bed_width > 1.27
range bed.mattress_thickness: mattress_thickness < 15.24 OR mattress_thickness > 17.78
range bed.bed_cost: bed_cost < 0
range staff.salary: salary <= 0
range specialty.min_years_training: min_years_training < 0
range billingstatement.total_cost: total_cost <= 0 OR total_cost > 50000
range billingstatement.insurance_covered_amount: insurance_covered_amount < 0
range invoice.amount_due: amount_due < 0
range payment.payment_amount: payment_amount <= 0
cross_column admission.discharge_date: discharge_date < CAST(admission_date AS DATE)
cross_column billingstatement.insurance_covered_amount: insurance_covered_amount > total_cost
cross_column invoice.due_date: due_date < issue_date
"""

REFERENCES = """
ward.dept_name department.dept_name
bed.ward_id ward.ward_id
staff.dept_name department.dept_name
doctor.doctor_id staff.staff_id
doctorspecialty.doctor_id doctor.doctor_id
doctorspecialty.specialty_name specialty.specialty_name
nurse.nurse_id staff.staff_id
admission.patient_id patient.patient_id
admission.nurse_id nurse.nurse_id
admission.doctor_id doctor.doctor_id
admission.bed_id bed.bed_id
plannedadmission.admission_id admission.admission_id
emergencyadmission.admission_id admission.admission_id
emergencyadmission.triage_nurse_id nurse.nurse_id
billingstatement.admission_id admission.admission_id
invoice.billing_id billingstatement.billing_id
payment.invoice_id invoice.invoice_id
"""

UNIQUE = "staff.email doctor.medical_license_number plannedadmission.reference_number billingstatement.admission_id payment.transaction_id"


def _lines(text: str) -> list[tuple[str, str]]:
    return [tuple(x.strip() for x in line.split(":", 1)) for line in text.strip().split("\n")]


KEYS = {t: rest.split("/")[0].split() for t, rest in _lines(REQUIRED)}


def _rules() -> list[tuple[str, str, str, str, str]]:
    """(rule_id, family, table, column, condition of violating rows of the table as t)."""
    out = []
    for t, rest in _lines(REQUIRED):
        for c in rest.replace("/", " ").split():
            out.append((f"not_null.{t}.{c}", "not_null", t, c, f"t.{c} IS NULL"))
        same = " AND ".join(f"o.{k} = t.{k}" for k in KEYS[t])
        out.append((f"primary_key.{t}", "unique", t, ",".join(KEYS[t]), f"(SELECT COUNT(*) FROM {t} o WHERE {same}) > 1"))
    for t, rest in _lines(LONGEST):
        w = rest.split()
        for c, n in zip(w[::2], w[1::2], strict=True):
            out.append((f"length.{t}.{c}", "length", t, c, f"length(t.{c}) > {n}"))
    for tc, rest in _lines(ALLOWED):
        t, c = tc.split(".")
        listed = ", ".join(f"'{v.strip()}'" for v in rest.split(","))
        out.append((f"domain.{tc}", "domain", t, c, f"t.{c} NOT IN ({listed})"))
    for what, condition in _lines(BROKEN):
        family, tc = what.split()
        out.append((f"{family}.{tc}", family, *tc.split("."), condition))
    for line in REFERENCES.strip().split("\n"):
        tc, ref = line.split()
        (t, c), (rt, rc) = tc.split("."), ref.split(".")
        out.append((f"foreign_key.{tc}", "foreign_key", t, c, f"t.{c} IS NOT NULL AND t.{c} NOT IN (SELECT {rc} FROM {rt})"))
    for tc in UNIQUE.split():
        t, c = tc.split(".")
        out.append((f"unique.{tc}", "unique", t, c, f"t.{c} IN (SELECT {c} FROM {t} GROUP BY {c} HAVING COUNT(*) > 1)"))
    out.append(("validity.doctor.license", "validity", "doctor", "license_expiry_date",
                f"medical_license_number IS NOT NULL AND (license_expiry_date IS NULL OR license_expiry_date <= {TODAY})"))
    out.append(("validity.nurse.wwcc", "validity", "nurse", "wwcc_expiry_date",
                f"wwcc_clearance AND (wwcc_expiry_date IS NULL OR wwcc_expiry_date <= {TODAY})"))
    out.append(("cardinality.doctor.specialties", "cardinality", "doctor", "doctor_id",
                "(SELECT COUNT(*) FROM doctorspecialty s WHERE s.doctor_id = t.doctor_id) NOT BETWEEN 1 AND 5"))
    return out


def _head(r: tuple) -> str:
    return f"SELECT '{r[0]}' AS rule_id, '{r[1]}' AS family, '{r[2]}' AS table_name, '{r[3]}' AS column_name"


def _key(t: str) -> str:
    return " || '|' || ".join(f"COALESCE(CAST(t.{k} AS VARCHAR), '')" for k in KEYS[t])


VIOLATIONS = with_roles("\nUNION ALL\n".join(
    f"{_head(r)}, {_key(r[2])} AS record_key FROM {r[2]} t WHERE {r[4]}" for r in _rules()))
COUNTS = with_roles("\nUNION ALL\n".join(
    f"{_head(r)}, (SELECT COUNT(*) FROM {r[2]} t WHERE {r[4]}) AS violations" for r in _rules()))
SPECIALTY_COUNTS = with_roles("""
SELECT doctor_id, COUNT(specialty_name) AS specialty_count
FROM doctor LEFT JOIN doctorspecialty USING (doctor_id)
GROUP BY doctor_id HAVING COUNT(specialty_name) NOT BETWEEN 1 AND 5""")
