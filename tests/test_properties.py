"""Whole-result properties on driver data, and readmission edge cases."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from carelake.plans import admissions, facilities, finance
from carelake.sources.fixtures import hospital_from_rows
from carelake.sources.roles import Hospital, from_driver_tables

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def h(spark):
    return from_driver_tables(spark, SF)


@needs_data
def test_running_total_ends_at_admission_count(h):
    last = admissions.monthly_admissions(h).orderBy(F.col("month").desc()).first()
    assert last["cumulative_admissions"] == h.admission.count()


@needs_data
def test_rollup_grand_total_is_sum_of_leaves(h):
    r = finance.revenue_rollup(h)
    leaves = r.filter("dept_grouping_level = 0 AND type_grouping_level = 0").agg(
        F.sum("total_admissions"), F.sum("total_revenue")).first()
    total = r.filter("dept_grouping_level = 1").first()
    assert total["total_admissions"] == leaves[0]
    assert total["total_revenue"] == pytest.approx(leaves[1])


@needs_data
def test_readmission_buckets_cover_all_discharges(h):
    got = admissions.readmission_cohorts(h).agg(F.sum("total_discharges")).first()[0]
    assert got == h.admission.filter(F.col("discharge_date").isNotNull()).count()


@needs_data
def test_ward_beds_add_up(h):
    got = facilities.ward_utilisation(h).agg(F.sum("total_beds")).first()[0]
    assert got == h.bed.join(h.ward, "ward_id", "left_semi").count()


@needs_data
def test_results_do_not_depend_on_input_partitioning(spark, h):
    shuffled = Hospital({name: (lambda _, n=name: getattr(h, n).repartition(7, F.rand(3)))
                         for name in h.tables()}, spark)
    for plan in (admissions.readmission_cohorts, facilities.ward_utilisation, finance.monthly_revenue):
        a = sorted(map(tuple, plan(h).collect()))
        b = sorted(map(tuple, plan(shuffled).collect()))
        assert a == b


def test_readmission_boundaries(spark):
    """Discharge on 2024-01-01; the next admission falls at each bucket boundary."""
    base = dt.datetime(2024, 1, 1)
    offsets = {  # patient -> next admission after discharge midnight
        1: dt.timedelta(0),                      # same instant: not "after"
        2: dt.timedelta(seconds=1),              # day 0 -> within 7
        3: dt.timedelta(days=7, hours=23),       # day 7 -> within 7
        4: dt.timedelta(days=8),                 # day 8 -> within 14
        5: dt.timedelta(days=14, hours=5),       # day 14 -> within 14
        6: dt.timedelta(days=15),                # day 15 -> within 30
        7: dt.timedelta(days=30),                # exactly +30 days -> within 30
        8: dt.timedelta(days=30, seconds=1),     # past the horizon
    }
    rows, aid = [], 1
    for p, off in offsets.items():
        rows.append(dict(admission_id=aid, patient_id=p, admission_date=base - dt.timedelta(days=3),
                         admission_type="Planned", discharge_date=base.date()))
        rows.append(dict(admission_id=aid + 1, patient_id=p, admission_date=base + off,
                         admission_type="Planned", discharge_date=None))
        aid += 2
    h = hospital_from_rows(spark, {"admission": rows}, apply_bed_trigger=False)
    got = {r["readmission_timeframe"]: (r["patient_count"], r["total_discharges"])
           for r in admissions.readmission_cohorts(h).collect()}
    assert got == {"Readmitted within 7 days": (2, 2), "Readmitted within 14 days": (2, 2),
                   "Readmitted within 30 days": (2, 2), "No readmission within 30 days": (2, 2)}


@needs_data
def test_approximate_percentiles_are_close_to_exact(h):
    exact = {r["admission_type"]: r for r in admissions.cost_stay_percentiles(h).collect()}
    approx = {r["admission_type"]: r for r in admissions.cost_stay_percentiles(h, exact=False).collect()}
    for t in exact:
        for c in ("cost_25th_percentile", "cost_median", "cost_75th_percentile", "cost_90th_percentile"):
            assert approx[t][c] == pytest.approx(exact[t][c], rel=0.05)


def test_dashboard_utilisation_thresholds(spark):
    """Occupancy 95 / 80 / 60 / 50 / 90 % -> HIGH / OPTIMAL / MODERATE / LOW / OPTIMAL (bounds are strict)."""
    from decimal import Decimal
    occupied = {"A": 19, "B": 16, "C": 12, "D": 10, "E": 18}    # out of 20 beds each
    depts = [dict(dept_name=d, operating_hours="24 Hours") for d in occupied]
    wards = [dict(ward_id=i + 1, ward_name=f"W{d}", dept_name=d, ward_type="General", bed_capacity=20)
             for i, d in enumerate(occupied)]
    beds = [dict(ward_id=i + 1, bed_length=Decimal("2.00"), bed_width=Decimal("1.00"),
                 mattress_thickness=Decimal("16.00"), bed_cost=Decimal("10.00"),
                 bed_status="Occupied" if k < n else "Available")
            for i, (d, n) in enumerate(occupied.items()) for k in range(20)]
    h = hospital_from_rows(spark, {"department": depts, "ward": wards, "bed": beds}, apply_bed_trigger=False)
    got = {r["dept_name"]: (r["occupancy_rate"], r["utilization_status"])
           for r in facilities.department_dashboard(h).collect()}
    assert got == {"A": (95.0, "HIGH UTILIZATION"), "B": (80.0, "OPTIMAL"), "C": (60.0, "MODERATE"),
                   "D": (50.0, "LOW UTILIZATION"), "E": (90.0, "OPTIMAL")}
