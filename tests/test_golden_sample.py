"""Every query on a small hospital of our own: against its SQL over the same rows, and against
values worked out by hand where the question leaves something to settle."""

import copy
import datetime as dt
import json

import duckdb
import pytest

from carelake.checks import rules
from carelake.plans import admissions, audit, facilities, finance, staffing
from carelake.plans.registry import PLANS
from carelake.sources.fixtures import hospital_from_rows
from carelake.sources.roles_sql import ROLE_CTES
from carelake.sources.schemas import SCHEMAS
from oracle_compare import compare
from sample_rows import AS_OF, SAMPLE


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


@pytest.fixture(scope="module")
def con(sample):
    """The sample as DuckDB tables."""
    con = duckdb.connect()
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP"}
    for name, schema in SCHEMAS.items():
        cols = ", ".join(f"{f.name} {kinds.get(f.dataType.simpleString(), f.dataType.simpleString())}" for f in schema.fields)
        con.execute(f"CREATE TABLE {name} ({cols})")
        data = [tuple(r) for r in getattr(sample, name).collect()]
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(schema.fields))})", data)
    return con


def over_tables(sql: str) -> str:
    """An oracle text without the role tables' definitions."""
    for cte in ROLE_CTES:
        sql = sql.replace(cte + ",\n", "").replace(cte, "")
    head, _, rest = sql.partition("WITH ")
    return rest if rest.lstrip().startswith("SELECT") else sql


@pytest.mark.parametrize("name", sorted(n for n in PLANS if n != "t2_bed_status_stream"))
def test_query_matches_its_sql(sample, con, name):
    plan, sql = PLANS[name]
    r = compare(plan(sample), con, over_tables(sql))
    assert r["values_match"], r


def test_loader_applies_trigger_defaults_and_generated_column(sample):
    assert rows(sample.bed.orderBy("bed_id"), "bed_id", "bed_status") == [
        (1, "Available"), (2, "Occupied"), (3, "Available"), (4, "Occupied"), (5, "Available")]
    assert [str(b) for (b,) in rows(sample.billingstatement.orderBy("billing_id"), "remaining_balance")] == [
        "200.10", "800.00", "0.00", "1999.99", "30.00"]
    assert rows(sample.nurse.orderBy("nurse_id"), "wwcc_clearance") == [(True,), (False,)]
    assert rows(facilities.refresh_headcount(sample).orderBy("dept_name"), "dept_name", "staff_headcount") == [
        ("Renal", 3), ("Sleep", 1), ("Trauma", 2)]


def test_q01_ties_and_a_doctor_without_department(sample):
    got = {r["doctor_name"]: r for r in staffing.salary_ranking(sample).collect()}
    assert {n: (r["salary_rank_in_dept"], r["overall_salary_rank"]) for n, r in got.items()} == {
        "Ada Quist": (1, 1), "Cyd Marr": (1, 1), "Bo Lindt": (2, 3), "Dov Neri": (1, 4)}
    assert got["Bo Lindt"]["dept_avg_salary"] == 200000.25 and got["Bo Lindt"]["salary_vs_dept_avg"] == -9999.75


def test_q02_months(sample):
    assert rows(admissions.monthly_admissions(sample), "month", "admissions_this_month", "cumulative_admissions",
                "three_month_moving_avg") == [(dt.datetime(2001, 5, 1), 2, 2, 2.0), (dt.datetime(2001, 6, 1), 3, 5, 2.5),
                                              (dt.datetime(2001, 7, 1), 4, 9, 3.0)]


def test_q05_one_level_below_the_root(sample):
    assert sorted(rows(facilities.department_hierarchy(sample), "dept_name", "root_dept", "level", "path")) == [
        ("Renal", "Trauma", 1, "Trauma > Renal"), ("Sleep", "Trauma", 1, "Trauma > Sleep"), ("Trauma", "Trauma", 0, "Trauma")]


def test_q06_total_line(sample):
    last = finance.revenue_rollup(sample).collect()[-1]
    assert (last["department"], last["total_admissions"], str(last["total_revenue"])) == ("ALL DEPARTMENTS", 8, "11190.15")


def test_q08_only_above_average(sample):
    # Renal: Ada 1, Bo 2 patients (mean 1.5); Trauma: Cyd 1 (mean 1)
    assert rows(staffing.above_department_average(sample), "full_name", "patients_treated", "dept_avg_patients") == [
        ("Bo Lindt", 2, 1.5)]


def test_q11_history_keeps_fractions_and_nulls(sample):
    got = {r["full_name"]: r for r in finance.patient_summary(sample, AS_OF).collect()}
    ivo = json.loads(got["Ivo Tran"]["admission_history"])
    assert ivo[0] == {"admission_date": "2001-07-27T06:30:00.5", "type": "Emergency", "diagnosis": None, "doctor": "Cyd Marr",
                      "length_of_stay": 5}
    assert json.loads(got["Joy Ueda"]["admission_history"])[0]["doctor"] is None
    assert got["Kit Vane"]["admission_history"] is None and got["Kit Vane"]["total_visits"] == 0
    assert str(got["Hana Sato"]["lifetime_charges"]) == "2190.15" and got["Hana Sato"]["doctors_seen"] == "Ada Quist, Bo Lindt, Dov Neri"


def test_q13_boundaries(sample):
    assert rows(admissions.readmission_cohorts(sample), "readmission_timeframe", "patient_count", "total_discharges") == [
        ("Readmitted within 7 days", 1, 1), ("Readmitted within 14 days", 2, 2),
        ("Readmitted within 30 days", 1, 1), ("No readmission within 30 days", 1, 2)]


def test_q15_bill_counted_once_per_invoice_payment(sample):
    got = {(r["billing_month"].month, r["dept_name"]): r for r in finance.monthly_revenue(sample).collect()}
    may = got[(5, "Renal")]  # bill 1 once; bill 2 three times: two payments, one invoice without
    assert (may["bills_issued"], str(may["total_billed"]), str(may["payments_received"])) == (2, "3600.10", "400.00")
    june = got[(6, "Renal")]
    assert str(june["previous_month_revenue"]) == "3600.10" and str(june["month_over_month_change"]) == "-3450.05"


def test_q17_counts(sample):
    got = dict(rows(audit.data_quality_scoreboard(sample, AS_OF), "issue_type", "issue_count"))
    assert {k for k, v in got.items() if v} == {"Missing Email", "Admission without Discharge after 30 days", "Invoice Overdue >60 days"}
    assert set(got.values()) == {0, 1} and len(got) == 8


def test_q18_newest_first(sample):
    got = rows(audit.activity_feed(sample, AS_OF), "activity", "record_id", "performed_by")
    assert got == [("Recent Discharges", 9, "Dov Neri"), ("Recent Payments", 4, "System"), ("Recent Payments", 3, "System"),
                   ("Recent Payments", 2, "System"), ("Recent Admissions", 6, "Cyd Marr"), ("Recent Admissions", 9, "Dov Neri")]


def test_rules_find_planted_records(spark):
    bad = copy.deepcopy(SAMPLE)
    bad["staff"][0]["email"] = bad["staff"][1]["email"]                   # unique
    bad["staff"][6]["staff_type"] = "Porter"                              # domain
    bad["bed"][0]["bed_length"] = __import__("decimal").Decimal("3.00")   # range
    bad["admission"][5]["doctor_id"] = 99                                 # foreign key
    bad["admission"][0]["discharge_date"] = dt.date(2001, 4, 30)          # cross-column
    bad["doctorspecialty"] = [r for r in bad["doctorspecialty"] if r["doctor_id"] != 3]  # cardinality
    bad["payment"][0]["card_last_four"] = "901234"                        # length
    bad["patient"][0]["full_name"] = None                                 # not null
    bad["doctor"][0]["license_expiry_date"] = dt.date(2000, 1, 1)         # validity
    bad["department"].append(dict(bad["department"][2]))                  # primary key
    h = hospital_from_rows(spark, bad, AS_OF)
    want = {("unique.staff.email", "1"), ("unique.staff.email", "2"), ("domain.staff.staff_type", "7"),
            ("range.bed.bed_length", "1"), ("foreign_key.admission.doctor_id", "6"),
            ("cross_column.admission.discharge_date", "1"), ("cardinality.doctor.specialties", "3"),
            ("length.payment.card_last_four", "1"), ("not_null.patient.full_name", "1"), ("validity.doctor.license", "1"),
            ("primary_key.department", "Sleep")}
    found = rows(rules.rule_violations(h, AS_OF), "rule_id", "record_key")
    assert set(found) == want and len(found) == 12  # both rows of the repeated department
    fired = {r["rule_id"]: r["violations"] for r in rules.rule_counts(h, AS_OF).collect() if r["violations"]}
    assert fired == {k: sum(1 for r, _ in found if r == k) for k, _ in want}


def test_sample_breaks_no_rule(sample):
    assert rules.rule_violations(sample, AS_OF).count() == 0
    assert rules.rule_counts(sample, AS_OF).count() == 169


def test_repeated_keys_come_once_per_record(spark, monkeypatch):
    """A primary key's copies are counted, not looked up; other repeated keys name their records."""
    monkeypatch.setattr(rules, "COPIES_AT_ONCE", 3)  # several arrays for the seven copies
    bad = copy.deepcopy(SAMPLE)
    bad["department"] += [dict(bad["department"][2]) for _ in range(6)]
    pair = bad["doctorspecialty"][0]
    bad["doctorspecialty"] += [dict(pair), dict(pair)]
    bad["staff"][0]["email"] = bad["staff"][1]["email"]
    h = hospital_from_rows(spark, bad, AS_OF)
    found = sorted(r for r in rows(rules.rule_violations(h, AS_OF), "rule_id", "record_key") if ".doctor.specialties" not in r[0])
    both = f"{pair['doctor_id']}|{pair['specialty_name']}"
    assert found == sorted([("primary_key.department", "Sleep")] * 7 + [("primary_key.doctorspecialty", both)] * 3
                           + [("unique.staff.email", "1"), ("unique.staff.email", "2")])
    fired = {r["rule_id"]: r["violations"] for r in rules.rule_counts(h, AS_OF).collect()}
    assert (fired["primary_key.department"], fired["primary_key.doctorspecialty"], fired["unique.staff.email"]) == (7, 3, 2)
    assert len(fired) == 169
