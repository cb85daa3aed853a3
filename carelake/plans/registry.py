"""Name -> (Spark plan, oracle SQL) for every registered query.

Keys carry the workload's query number (q01..q20) or the inventory ID of
the operator they exercise (a08 census, a20 cube / grouping sets, s07
headcount, t1/t2 bed status, d rules).  Every plan reads the driver's
tables through the role mapping, so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carelake.checks import rules, rules_sql
from carelake.plans import admissions, audit, facilities, finance, networks, oracle, staffing
from carelake.streaming import bed_status, headcount, specialty_rule
from carelake.sources.roles import DRIVER_AS_OF, Hospital, from_driver_tables

Plan = Callable[[Hospital], DataFrame]

PLANS: dict[str, tuple[Plan, str | None]] = {
    "q01_salary_ranking": (staffing.salary_ranking, oracle.Q1),
    "q02_monthly_admissions": (admissions.monthly_admissions, oracle.Q2),
    "q03_daily_occupancy": (admissions.daily_occupancy, oracle.Q3),
    "q04_doctor_department_stats": (staffing.doctor_department_stats, oracle.Q4),
    "q05_department_hierarchy": (facilities.department_hierarchy, oracle.Q5),
    "q06_revenue_rollup": (finance.revenue_rollup, oracle.Q6),
    "q07_patient_admission_pivot": (admissions.patient_admission_pivot, oracle.Q7),
    "q08_above_department_average": (staffing.above_department_average, oracle.Q8),
    "q09_latest_admissions_per_doctor": (admissions.latest_admissions_per_doctor, oracle.Q9),
    "q10_doctor_profiles": (staffing.doctor_profiles, oracle.Q10),
    "q11_patient_summary": (lambda h: finance.patient_summary(h, DRIVER_AS_OF), oracle.Q11),
    "q12_cost_stay_percentiles": (admissions.cost_stay_percentiles, oracle.Q12),
    "q13_readmission_cohorts": (admissions.readmission_cohorts, oracle.Q13),
    "q14_workload_balance": (lambda h: staffing.workload_balance(h, DRIVER_AS_OF), oracle.Q14),
    "q15_monthly_revenue": (finance.monthly_revenue, oracle.Q15),
    "q16_ward_utilisation": (facilities.ward_utilisation, oracle.Q16),
    "q17_data_quality_scoreboard": (lambda h: audit.data_quality_scoreboard(h, DRIVER_AS_OF), oracle.Q17),
    "q18_activity_feed": (lambda h: audit.activity_feed(h, DRIVER_AS_OF), oracle.Q18),
    "q19_trend_forecast": (lambda h: admissions.trend_forecast(h, DRIVER_AS_OF), oracle.Q19),
    "q20_department_dashboard": (facilities.department_dashboard, oracle.Q20),
    "w11_daily_occupancy_calendar_window": (lambda h: admissions.daily_occupancy(h, calendar_days=True),
                                            oracle.Q3_CALENDAR),
    "a08_bed_census": (lambda h: admissions.bed_census(h, DRIVER_AS_OF), oracle.CENSUS),
    "a20_revenue_cube": (finance.revenue_cube, oracle.Q6_CUBE),
    "a20_revenue_grouping_sets": (finance.revenue_grouping_sets, oracle.Q6_SETS),
    "u03_referral_network": (networks.referral_network, oracle.REFERRALS),
    "j05_readmission_pairs": (networks.readmission_pairs, oracle.READMISSION_PAIRS),
    "w09_payment_frames": (networks.payment_frames, oracle.PAYMENT_FRAMES),
    "a27_history_chunks": (networks.history_chunks, oracle.HISTORY_CHUNKS),
    "a05_distinct_patients_rollup": (networks.distinct_patients, oracle.DISTINCT_PATIENTS),
    "a22_cost_by_stay_moments": (networks.cost_by_stay, oracle.COST_BY_STAY),
    "s07_headcount_refresh": (facilities.refresh_headcount, oracle.HEADCOUNT),
    "s07_headcount_stream": (headcount.headcount_stream, oracle.HEADCOUNT),
    "d08_specialty_rule_stream": (specialty_rule.specialty_rule_stream, rules_sql.SPECIALTY_COUNTS),
    "t1_bed_status_batch": (bed_status.bed_status_batch, oracle.BED_STATUS),
    "t2_bed_status_stream": (bed_status.bed_status_stream, oracle.BED_STATUS),
    "d01_d09_rule_counts": (lambda h: rules.rule_counts(h, DRIVER_AS_OF), rules_sql.COUNTS),
    "d10_rule_violations": (lambda h: rules.rule_violations(h, DRIVER_AS_OF), rules_sql.VIOLATIONS),
    "d08_specialty_count_violations": (rules.specialty_count_violations, rules_sql.SPECIALTY_COUNTS),
}


_HOSPITALS: dict[tuple[str, str, str], Hospital] = {}


def hospital(spark: SparkSession, sf_dir: str) -> Hospital:
    """One lazily built Hospital per (application, session, data folder), shared by all queries.

    DataFrames are immutable plans, so sharing them only saves driver-side work: schema
    reads and analysis of the role tables.  No counts are held.
    """
    key = (spark.sparkContext.applicationId, spark._jsparkSession.sessionUUID(), sf_dir)
    if key not in _HOSPITALS:
        _HOSPITALS[key] = from_driver_tables(spark, sf_dir)
    return _HOSPITALS[key]


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    plan = PLANS[name][0]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan(hospital(spark, sf_dir))

    run.__name__ = name
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: runner(name) for name in PLANS}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in PLANS.items() if sql is not None}
