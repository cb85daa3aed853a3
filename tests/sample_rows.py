"""A small hospital of our own, with the edge cases the queries have to settle.

Evaluated at 2001-08-01, like the driver's tables.  Ties, NULL departments, doctors, beds
and bills, open stays, transfers, a readmission at each boundary, invoices with none, one and
several payments.
"""

import datetime as dt
from decimal import Decimal as D

AS_OF = "2001-08-01"
d, ts = dt.date.fromisoformat, dt.datetime.fromisoformat


def _staff(n, name, kind, salary, dept, email=True):
    return dict(staff_id=n, full_name=name, email=f"s{n}@ward.example" if email else None, mobile=f"07{n}",
                address=f"{n} Quay", salary=D(salary), dept_name=dept, staff_type=kind)


def _stay(n, patient, start, end=None, doctor=None, nurse=None, bed=None, kind="Planned", why="Dx-a"):
    return dict(admission_id=n, patient_id=patient, admission_date=ts(start), admission_type=kind, nurse_id=nurse,
                doctor_id=doctor, bed_id=bed, discharge_date=d(end) if end else None, primary_diagnosis=why,
                discharge_disposition="Home" if end else None)


SAMPLE = {
    "department": [dict(dept_name="Renal", operating_hours="07:00 - 19:00"), dict(dept_name="Trauma", operating_hours="24 Hours"),
                   dict(dept_name="Sleep", operating_hours="19:00 - 07:00")],
    "ward": [dict(ward_id=1, ward_name="North", dept_name="Renal", ward_type="General", bed_capacity=3),
             dict(ward_id=2, ward_name="Bay", dept_name="Trauma", ward_type="ICU", bed_capacity=2),
             dict(ward_id=3, ward_name="Attic", dept_name="Sleep", ward_type="General", bed_capacity=1)],
    "bed": [dict(bed_id=n, ward_id=w, bed_length=D("2.00"), bed_width=D("1.00"), mattress_thickness=D("16.00"),
                 bed_cost=D(cost), bed_status=status)
            for n, w, cost, status in ((1, 1, "80.00", "Available"), (2, 1, "95.50", "Occupied"), (3, 1, "80.00", "Maintenance"),
                                       (4, 2, "310.25", "Occupied"), (5, 2, "300.00", "Available"))],
    "staff": [_staff(1, "Ada Quist", "Doctor", "210000.00", "Renal"), _staff(2, "Bo Lindt", "Doctor", "190000.50", "Renal"),
              _staff(3, "Cyd Marr", "Doctor", "210000.00", "Trauma"), _staff(4, "Dov Neri", "Doctor", "99000.00", None),
              _staff(5, "Eli Okoro", "Nurse", "80000.00", "Renal"), _staff(6, "Fay Pryce", "Nurse", "82000.00", "Trauma", False),
              _staff(7, "Gus Rao", "Allied Health", "70000.00", "Sleep")],
    "doctor": [dict(doctor_id=n, medical_license_number=f"L{n}", license_expiry_date=d(when), license_state="X")
               for n, when in ((1, "2003-01-01"), (2, "2002-05-05"), (3, "2001-09-09"), (4, "2004-02-29"))],
    "nurse": [dict(nurse_id=5, wwcc_clearance=True, wwcc_expiry_date=d("2002-12-31")), dict(nurse_id=6)],
    "specialty": [dict(specialty_name=s, specialty_category="Medical", min_years_training=4, description=None)
                  for s in ("Dialysis", "Grafts", "Burns")],
    "doctorspecialty": [dict(doctor_id=n, specialty_name=s, training_date=d("1995-06-01"), proficiency_level=level,
                             is_primary_specialty=first)
                        for n, s, level, first in ((1, "Grafts", "Expert", True), (1, "Dialysis", "Advanced", False),
                                                   (2, "Dialysis", "Beginner", None), (3, "Burns", "Expert", True),
                                                   (4, "Burns", "Beginner", False))],
    "patient": [dict(patient_id=n, full_name=name, email=f"p{n}@home.example", address=f"{n} Lane", date_of_birth=d("1970-01-01"),
                     mobile=f"08{n}", emergency_contact_name="Kin", emergency_contact_phone="09", insurance_number=f"I{n}",
                     blood_type="O+", allergies=a)
                for n, name, a in ((1, "Hana Sato", None), (2, "Ivo Tran", "Nuts"), (3, "Joy Ueda", "None"), (4, "Kit Vane", None))],
    "admission": [
        _stay(1, 1, "2001-05-01T08:00:00", "2001-05-04", doctor=1, nurse=5, bed=1),
        _stay(2, 1, "2001-05-11T23:59:59.999999", "2001-05-20", doctor=1, bed=2, kind="Emergency"),  # 7 days later
        _stay(3, 1, "2001-06-03T00:00:00", "2001-06-03", doctor=2, bed=1),                            # day 14, same-day stay
        _stay(4, 2, "2001-06-03T10:00:00", "2001-06-10", doctor=3, nurse=6, bed=4, kind="Emergency", why="Dx-b"),
        _stay(5, 2, "2001-07-10T00:00:00", "2001-07-15", doctor=3, bed=5),                            # exactly 30 days
        _stay(6, 2, "2001-07-27T06:30:00.5", doctor=3, bed=4, kind="Emergency", why=None),            # open
        _stay(7, 3, "2001-06-20T12:00:00", doctor=2, bed=2),                                          # open for over a month
        _stay(8, 3, "2001-07-30T09:00:00", doctor=None, bed=None),                                    # no doctor, no bed
        _stay(9, 1, "2001-07-26T09:00:00", "2001-07-31", doctor=4, bed=3, kind="Emergency")],
    "plannedadmission": [dict(admission_id=n, referring_practitioner="R", reference_number=f"N{n}") for n in (1, 3, 5, 7, 8)],
    "emergencyadmission": [dict(admission_id=n, triage_nurse_id=6, patient_condition="c", severity_level="High") for n in (2, 4, 6, 9)],
    "billingstatement": [dict(billing_id=n, admission_id=a, discharge_date=d(when), total_cost=D(cost), insurance_covered_amount=D(paid))
                         for n, a, when, cost, paid in ((1, 1, "2001-05-04", "1200.10", "1000.00"), (2, 2, "2001-05-20", "800.00", "0.00"),
                                                        (3, 3, "2001-06-03", "150.05", "150.05"), (4, 4, "2001-06-10", "9000.00", "7000.01"),
                                                        (5, 9, "2001-07-31", "40.00", "10.00"))],
    "invoice": [dict(invoice_id=n, billing_id=b, issue_date=d(when), due_date=d(due) if due else None, amount_due=D(owed),
                     payment_status=status)
                for n, b, when, due, owed, status in ((1, 1, "2001-05-05", "2001-05-20", "200.10", "Unpaid"),
                                                      (2, 2, "2001-05-21", None, "400.00", "Paid"),
                                                      (3, 2, "2001-05-22", "2001-07-01", "400.00", "Partially Paid"),
                                                      (4, 4, "2001-06-11", "2001-08-11", "1999.99", "Unpaid"))],
    "payment": [dict(payment_id=n, invoice_id=i, payment_method="Cash", payment_date=d(when), payment_amount=D(a), payment_status=status)
                for n, i, when, a, status in ((1, 2, "2001-06-01", "100.00", "Completed"), (2, 2, "2001-07-28", "300.00", "Completed"),
                                              (3, 3, "2001-07-29", "50.00", "Failed"), (4, 4, "2001-07-30", "500.00", "Completed"))],
}
