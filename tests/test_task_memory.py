"""How many sorts and hash tables one task holds: each takes a page at least, however few rows it has."""

from datetime import date, datetime

import pytest

from clientpulse.operators import alerts, backfill, features, reporting, rules
from pulsechecks import catalog
from pulsechecks.inputs import AS_OF, Inputs
from tests.conftest import SF, as_set

BUFFERS = ("Sort", "HashAggregate", "ObjectHashAggregate")

# Queries over the score history.
HISTORY_QUERIES = [
    "l14_alerts_rule_file",
    "l14_alerts_script",
    "l14_alerts_sql_v1",
    "q1_client_360",
    "q1_client_360_in_range",
    "q1_client_360_period",
    "q2_last_known_values_unlisted_text",
    "q5_monthly_mean_score",
    "q6_status_by_month",
    "l16_severity_order",
    "l16_severity_order_sql_v1",
    "l17_most_urgent",
    "l18_alert_summary",
    "l18_alert_summary_observed",
    "l1_latest_snapshot",
    "l1_latest_snapshot_period",
    "l2_previous_snapshot",
]


@pytest.fixture
def large(spark):
    """Plans as for tables that are too large for a broadcast."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def nodes(plan):
    yield plan
    children = plan.children()
    for n in range(children.size()):
        yield from nodes(children.apply(n))


def most_in_a_task(df) -> int:
    """The largest number of sorts and hash tables that a task holds, over all stages of a plan.

    A union of rows of one layout joins its parts partition by partition, so they add up; of other parts each is a task.
    """
    stages = []

    def held(plan) -> int:
        children = plan.children()
        below = [held(children.apply(n)) for n in range(children.size())]
        if "Exchange" in plan.nodeName() and "Reused" not in plan.nodeName():
            stages.extend(below)
            return 0
        apart = plan.nodeName() == "Union" and "Unknown" in plan.outputPartitioning().toString()
        return (max(below) if apart else sum(below)) + (plan.nodeName() in BUFFERS)

    return max(held(df._jdf.queryExecution().executedPlan()), *stages)


def month_sums(df) -> list:
    """The shuffles that deal the sums per client and month, each with the map side below it."""
    return [p for p in nodes(df._jdf.queryExecution().executedPlan())
            if "Exchange" in p.nodeName() and "month_end" in p.outputPartitioning().toString()]


def test_history_takes_few_buffers(large):
    i = Inputs(large, SF)
    for df in (alerts.latest_snapshot(i.history), alerts.previous_snapshot(i.history), alerts.alert_summary(i.script_alerts),
               reporting.client_360(i.clients, i.history), reporting.monthly_mean_score(i.history),
               reporting.status_by_month(i.history, months=3)):
        assert most_in_a_task(df) <= 6


def test_local_features_take_few_buffers(large):
    i = Inputs(large, SF)
    assert most_in_a_task(i.local_scores("sql_v1")) <= 6
    assert most_in_a_task(i.local_scores("pandas_v1")) <= 6


def test_client_alerts_evaluate_their_input_once(large):
    i = Inputs(large, SF)
    assert most_in_a_task(reporting.client_alerts(i.script_alerts)) <= 6


def test_clients_meet_their_months_after_the_sums(large):
    i = Inputs(large, SF)
    df = backfill.monthly_features(i.clients, i.campaigns, i.automations, i.messages, date(2001, 1, 1), date(2001, 6, 30))
    assert month_sums(df) and not any("Generate" in p.nodeName() for s in month_sums(df) for p in nodes(s))


@pytest.mark.parametrize("name", HISTORY_QUERIES)
def test_history_query_sums_clients_once(large, name):
    """No map task holds a group per client and month end of its split."""
    catalog.load()
    if name == "l18_alert_summary_observed":  # its result is a summary; these are the rows it writes
        df = alerts.evaluate_alerts(Inputs(large, SF).alert_base, rules.SCRIPT_ALERTS, AS_OF)
    else:
        df = catalog.QUERIES[name](large, SF)
    assert month_sums(df) and not any("Generate" in p.nodeName() for s in month_sums(df) for p in nodes(s))
    assert most_in_a_task(df) <= 6


def test_client_alerts_without_client_and_repeated(spark, rows):
    data = [("a", "x", "info", False), ("a", "x", "info", False), ("a", "y", "info", True), ("b", "x", "info", False),
            (None, "x", "info", False)]
    frame = rows(data, "client_id string, alert_id string, severity string, resolved boolean").selectExpr(
        "*", "'n' AS alert_name", "'d' AS action_suggested", "DATE'2026-01-01' AS alert_date")
    got = sorted(tuple(r)[:3] for r in reporting.client_alerts(frame).collect())
    assert got == [("a", 2, "x"), ("a", 2, "x"), ("b", 1, "x")]


def test_features_of_repeated_and_missing_clients(spark, rows):
    """Rows without a client reach nobody, repeated clients stay repeated, and one source does not add to another."""
    day = datetime(2001, 7, 10)
    dim = rows([("a", "A"), ("a", "A"), ("b", "B"), ("c", "C")], "client_id string, company_name string").selectExpr(
        "*", "'o' AS csm_owner", "1.0D AS mrr", "5 AS days_to_renewal", "true AS cashback_enabled")
    campaigns = rows([("1", "a", day, 4.0, 2.0), ("2", "a", day, 4.0, 0.0), ("3", None, day, 9.0, 1.0)],
                     "campaign_id string, client_id string, sent_at timestamp_ntz, revenue_attributed double, cost double")
    automations = rows([("a", "standard", "active"), ("b", "integration", "active"), (None, "standard", "active")],
                       "client_id string, automation_type string, status string")
    chat = rows([("a", True, False, False), ("a", False, True, False)],
                "client_id string, has_human_agent boolean, has_chat_flow boolean, has_ai_enabled boolean")
    messages = rows([("b", "2001-07", 5, 10), ("b", "2001-06", 4, 9), (None, "2001-07", 1, 1)],
                    "client_id string, year_month string, messages_sent bigint, plan_limit bigint")
    for variant, roi, missing in (("sql_v1", 1.0, 9999), ("pandas_v1", 4.0, 999)):
        got = features.local_features(dim, campaigns, automations, chat, messages, AS_OF, "2001-07", "2001-06", variant)
        assert got.count() == 6
        assert as_set(got, "client_id", "days_since_last_campaign", "campaign_roi", "active_automations",
                      "integration_automations", "messages_sent_current", "messages_sent_previous") == {
            ("a", 10, roi, 1, 0, 0, 0), ("b", missing, 0.0, 0, 1, 5, 4),
            ("c", missing, 0.0, 0, 0, 0, 0)}
