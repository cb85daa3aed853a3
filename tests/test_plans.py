"""Plan-shape guarantees for every registered query (planning only, no execution)."""

import os
import re
import sys

import pytest

import __spark_entry__ as entry

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from audit_plans import audit  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

NAMES = sorted(n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n))  # those have tests of their own


@pytest.mark.parametrize("name", NAMES)
def test_no_pair_explosion_operators(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Generate explode\(Subquery", plan)  # a cross join in another shape
    shape = audit(plan)
    assert shape["nested_loop_or_cartesian"] == 0, shape


def test_top_k_per_doctor_is_trimmed_before_the_shuffle(spark):
    plan = entry.queries()["q09_latest_admissions_per_doctor"](spark, SF)._jdf.queryExecution() \
        .executedPlan().toString()
    assert audit(plan)["window_group_limit"] >= 2  # partial (pre-shuffle) + final


def _final_plan(spark, name):
    df = entry.queries()[name](spark, SF)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_salary_ranking_needs_few_shuffles(spark):
    assert audit(_final_plan(spark, "q01_salary_ranking"))["shuffle"] < 10


@pytest.mark.parametrize("name", ["q04_doctor_department_stats", "q08_above_department_average", "q14_workload_balance"])
def test_doctors_are_not_shuffled_on_department_names(spark, name):
    plan = _final_plan(spark, name)
    joins = [ln for ln in plan.split("\n") if re.search(r"Exchange hashpartitioning\(dept_name#\d+, \d+\), ENSURE", ln)]
    assert len(joins) <= 1  # the aggregate of the department table itself


@pytest.mark.parametrize("name", ["d01_d09_rule_counts", "d10_rule_violations"])
def test_rules_with_a_shuffle_are_stages_of_their_own(spark, name):
    """No sort-merge join and no key count shares the union's stage, where AQE would give it the largest tasks."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as over large tables
    try:
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    # each line with its depth, as the operator's name starts further right
    nodes = [(len(m.group(0)), ln[len(m.group(0)):]) for ln in plan if (m := re.match(r"[ :|+*()\d-]*", ln))]
    top = next(i for i, (_, what) in enumerate(nodes) if what.startswith("Union"))
    joins, inside = 0, []
    for depth, what in nodes[top:]:
        while inside and inside[-1][0] >= depth:
            inside.pop()
        if re.match(r"SortMergeJoin.*Left(Anti|Semi)|HashAggregate\(keys=\[\w.*functions=\[count\(1\)", what):
            joins += 1
            assert any(op.startswith("Exchange") for _, op in inside), what
        inside.append((depth, what))
    assert joins >= 17 + 20  # every foreign key and every unique rule


@pytest.mark.parametrize("name", ["d01_d09_rule_counts", "d10_rule_violations"])
def test_no_key_is_counted_in_the_stage_that_reads_its_table(spark, name):
    """There one task would hold every key of a file's row group; dealt before, AQE sizes the tasks."""
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString().split("\n")
    nodes = [(len(m.group(0)), ln[len(m.group(0)):]) for ln in plan if (m := re.match(r"[ :|+*()\d-]*", ln))]
    dealt = 0
    for i, (depth, what) in enumerate(nodes):
        if re.match(r"HashAggregate\(keys=\[(?!rule_id#)\w.*functions=\[partial_count\(1\)", what):
            below = [op for d, op in nodes[i + 1:] if d > depth]
            first = next(op for op in below if re.match(r"Exchange|AQEShuffleRead|FileScan|Scan", op))
            assert first.startswith("Exchange"), what
            dealt += "REBALANCE_PARTITIONS_BY_COL" in first
    assert dealt == 20  # every unique rule
