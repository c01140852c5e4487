"""Plan shapes of the registered queries (regression guard for scale)."""

import __spark_entry__ as entry

from conftest import explain_text
from dailybars.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate")


def test_no_python_no_pairs_no_sort_aggregate(spark):
    queries = entry.queries()
    for name in QUERIES:
        plan = explain_text(queries[name](spark, SF))
        for marker in FORBIDDEN:
            assert marker not in plan, (name, marker)


def test_report_plan_shape(spark):
    plan = explain_text(entry.queries()["daily_report"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 2        # aggregate, window
    assert "partial_min_by" in plan and "partial_max_by" in plan
    # Only the columns the report needs are read (not event_id, event_type).
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double,props:string>" in plan


def test_reports_push_the_date_bound_to_the_scan(spark):
    for name in ("daily_report", "report_sorted", "report_from_date"):
        plan = explain_text(entry.queries()[name](spark, SF), "formatted")
        assert "GreaterThanOrEqual(ts,2024-01-" in plan, name


def test_sorted_report_needs_no_extra_exchange(spark):
    plan = explain_text(entry.queries()["report_sorted"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Exchange rangepartitioning") == 1


def test_ledger_anti_join_broadcasts_the_bounded_side(spark):
    plan = explain_text(entry.queries()["ledger_missing_dates"](spark, SF))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
