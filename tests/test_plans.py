"""Shape of the physical plans."""

import re

import pytest

from fraudlake import FraudConfig
from fraudlake.operators import curate
from fraudlake.operators.rules import score_transactions
from fraudlake.plans import bridge, reports
from fraudlake.plans.queries import QUERIES
from tests.conftest import SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(plan, name):
    return len(re.findall(rf"[+-] (?:\*\(\d+\) )?{name}\b", plan))


@pytest.mark.parametrize("isolate_days", [True, False])
def test_all_rules_share_one_exchange_and_one_sort(spark, isolate_days):
    plan = plan_of(score_transactions(bridge.transactions(spark, SMALL), FraudConfig(isolate_days=isolate_days)))
    assert nodes(plan, "Exchange") == 1
    assert nodes(plan, "Sort") == 1
    assert nodes(plan, "Window") == 2


def test_no_python_in_the_plans(spark):
    plain = [name for name in QUERIES if name.startswith(("rule_", "score_", "report_", "fraud_", "curated_"))]
    plain += ["haversine_distance", "velocity_count", "prev_transaction", "kafka_payload", "ingest_parse_json"]
    for name in plain:
        assert "Python" not in plan_of(QUERIES[name](spark, SMALL)), name


def test_unused_columns_do_not_reach_the_shuffle(spark):
    plan = plan_of(reports.fraud_type(curate.fraud_alerts(score_transactions(bridge.transactions(spark, SMALL)))))
    assert "merchant_id" not in plan
    assert "event_type" not in plan


def test_top_reports_use_bounded_sorts(spark):
    for name in ("report_top_accounts", "report_top_accounts_basic", "report_latest_alerts", "report_daily_summary"):
        plan = plan_of(QUERIES[name](spark, SMALL))
        assert "TakeOrderedAndProject" in plan, name
        assert nodes(plan, "GlobalLimit") == 0, name


def test_aggregates_combine_before_the_shuffle(spark):
    plan = plan_of(QUERIES["fraud_summary"](spark, SMALL))
    assert "partial_sum" in plan
    assert "partial_count" in plan


def test_no_cross_join_anywhere(spark):
    for name in ("score_transactions_hot_account", "inject_patterns", "dim_city_coords"):
        plan = plan_of(QUERIES[name](spark, SMALL))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
