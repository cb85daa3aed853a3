"""Landed tables give the same answers, and time filters reach the Parquet scan."""

import os
import re

import pytest
from pyspark.sql import functions as F

from carelake.functions.dates import as_of_lit
from carelake.plans import audit, finance
from carelake.sources.catalog import WEEK, from_parquet_tables, land, since
from carelake.sources.roles import DRIVER_AS_OF, from_driver_tables
from oracle_compare import _rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def landed(spark):
    derived = from_driver_tables(spark, SF)
    return derived, from_parquet_tables(spark, land(derived, files_per_table=4))


@pytest.mark.parametrize("plan", [
    lambda h: audit.activity_feed(h, DRIVER_AS_OF),
    lambda h: finance.monthly_revenue(h),
    lambda h: audit.data_quality_scoreboard(h, DRIVER_AS_OF),
])
def test_landed_tables_answer_the_same(landed, plan):
    derived, stored = landed
    a, b = plan(derived), plan(stored)
    assert _rows(a.columns, [tuple(r) for r in a.collect()]) == _rows(b.columns, [tuple(r) for r in b.collect()])


def test_time_filter_is_pushed_to_the_scan(landed):
    _, stored = landed
    plan = audit.activity_feed(stored, DRIVER_AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(admission_date" in plan
    assert "GreaterThanOrEqual(payment_date" in plan


@pytest.fixture(scope="module")
def by_week(spark):
    derived = from_driver_tables(spark, SF)
    return derived, from_parquet_tables(spark, land(derived, files_per_table=4, weekly=True))


def test_only_the_partitions_of_the_week_are_read(by_week):
    derived, stored = by_week
    feed = audit.activity_feed(stored, DRIVER_AS_OF)
    a = audit.activity_feed(derived, DRIVER_AS_OF)
    assert _rows(a.columns, [tuple(r) for r in a.collect()]) == _rows(feed.columns, [tuple(r) for r in feed.collect()])
    plan = feed._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert sum("_week" in f and ">=" in f for f in filters) >= 2  # admissions and payments
    recent = since(stored, "admission", as_of_lit(DRIVER_AS_OF) - F.expr("INTERVAL 7 DAYS"))
    folders = {f.split("_week=")[1].split("/")[0] for f in
               [r[0] for r in recent.select(F.input_file_name()).distinct().collect()]}
    everything = {r[0] for r in stored.admission.select(WEEK).distinct().collect()}
    assert len(folders) <= 2 < len(everything)


def test_a_calendar_prunes_partitions_at_run_time(by_week, spark):
    _, stored = by_week
    calendar = stored.admission.select(F.col(WEEK).alias("week")).distinct().withColumn("day", F.dayofyear("week"))
    calendar.write.mode("overwrite").parquet(os.path.join(spark.conf.get("spark.checkpoint.dir"), "calendar"))
    calendar = spark.read.parquet(os.path.join(spark.conf.get("spark.checkpoint.dir"), "calendar"))
    quiet = stored.admission.join(calendar.where("day < 30"), F.col(WEEK) == F.col("week"))
    assert "dynamicpruning" in quiet._jdf.queryExecution().executedPlan().toString()
    want = stored.admission.where(F.dayofyear(WEEK) < 30).count()
    assert quiet.count() == want > 0


def test_bucketed_admission_bill_join_needs_no_shuffle(spark):
    from carelake.plans import admissions
    derived = from_driver_tables(spark, SF)
    path = land(derived, buckets=4, database="carelake_bucketed_test")
    stored = from_parquet_tables(spark, path, database="carelake_bucketed_test")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the sort-merge path
    try:
        df = admissions.patient_admission_pivot(stored)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(admission_id" not in plan
        a, b = admissions.patient_admission_pivot(derived), df
        assert _rows(a.columns, [tuple(r) for r in a.collect()]) == _rows(b.columns, [tuple(r) for r in b.collect()])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_defaults_and_generated_column_at_a_file_load(spark, tmp_path):
    derived = from_driver_tables(spark, SF)
    path = str(tmp_path)
    for name, df in derived.tables().items():
        lacking = {"bed": ["bed_status"], "invoice": ["issue_date", "payment_status"], "payment": ["payment_date"],
                   "department": ["staff_headcount"], "billingstatement": ["remaining_balance"],
                   "nurse": ["wwcc_clearance"], "patient": ["allergies"]}.get(name, [])
        df.drop(*lacking).limit(5).write.parquet(f"{path}/{name}")
    stored = from_parquet_tables(spark, path, as_of="2024-05-06")
    one = lambda t, c: {r[0] for r in getattr(stored, t).select(c).collect()}
    assert one("bed", "bed_status") == {"Available"} and one("invoice", "payment_status") == {"Unpaid"}
    assert {str(d) for d in one("invoice", "issue_date") | one("payment", "payment_date")} == {"2024-05-06"}
    assert one("department", "staff_headcount") == {0} and one("nurse", "wwcc_clearance") == {False}
    assert one("patient", "allergies") == {None}
    assert all(r.remaining_balance == r.total_cost - r.insurance_covered_amount
               for r in stored.billingstatement.collect())
    derived.staff.drop("full_name").limit(1).write.parquet(f"{path}/broken/staff")
    with pytest.raises(ValueError, match="staff.full_name"):
        from_parquet_tables(spark, f"{path}/broken").staff.count()
