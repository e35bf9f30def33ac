from datetime import date

import pytest

from clientpulse.operators import alerts, rules
from tests.conftest import as_dict, as_set

HISTORY = ("client_id string, calculated_at date, period_days int, health_status string, campaign_roi double, "
           "days_since_last_campaign int, messages_mom_change double, plan_usage_pct double, total_score int")
DIM = "client_id string, company_name string, csm_owner string, days_to_renewal int"
D1, D2, D3 = date(2026, 3, 1), date(2026, 3, 31), date(2026, 4, 8)


def row(client, day, status, roi=5.0, days=3, change=0.0, usage=50.0, total=10, period=30):
    return (client, day, period, status, roi, days, change, usage, total)


def test_latest_and_previous(rows):
    history = rows([row("a", D1, "green"), row("a", D3, "red", roi=0.5), row("a", D2, "yellow", roi=2.0),
                    row("b", D3, "red")], HISTORY)
    both = alerts.latest_with_previous(history)
    assert as_set(both, "client_id", "calculated_at", "previous_status", "previous_roi", "previous_at") == {
        ("a", D3, "yellow", 2.0, D2), ("b", D3, None, None, None)}
    assert as_set(alerts.previous_snapshot(history), "client_id", "previous_status") == {("a", "yellow")}


def test_several_windows_per_day_do_not_duplicate_clients(rows):
    history = rows([row("a", D2, "green", period=p) for p in (7, 30, 60)] +
                   [row("a", D3, "red", period=p) for p in (7, 30, 60)], HISTORY)
    both = alerts.latest_with_previous(history, 30).collect()
    assert [(r["health_status"], r["previous_status"]) for r in both] == [("red", "green")]


@pytest.mark.parametrize("ruleset", [rules.SCRIPT_ALERTS, rules.SQL_V1_ALERTS], ids=["script", "sql_v1"])
def test_drop_to_red_needs_a_change(rows, ruleset):
    history = rows([row("stays", D2, "red"), row("stays", D3, "red"), row("drops", D2, "yellow"),
                    row("drops", D3, "red"), row("first", D3, "red"), row("rises", D2, "red"), row("rises", D3, "green")],
                   HISTORY)
    dim = rows([(c, c, "x", 500) for c in ("stays", "drops", "first", "rises")], DIM)
    fired = alerts.evaluate_alerts(alerts.alert_base(history, dim), ruleset, D3)
    assert as_set(fired.where("alert_id = 'score_dropped_to_red'"), "client_id") == {("drops",), ("first",)}


BASE = ("client_id string, company_name string, csm_owner string, health_status string, total_score int, "
        "days_since_last_campaign int, messages_mom_change double, plan_usage_pct double, coverage_pct double, "
        "days_to_renewal int, campaign_roi double, previous_status string, previous_roi double")


def base(rows, **values):
    default = dict(health_status="yellow", total_score=12, days_since_last_campaign=3, messages_mom_change=0.0,
                   plan_usage_pct=50.0, coverage_pct=50.0, days_to_renewal=500, campaign_roi=5.0,
                   previous_status="yellow", previous_roi=5.0)
    width = len(next(iter(values.values())))
    data = [(str(n), f"c{n}", None, *{**default, **{k: v[n] for k, v in values.items()}}.values()) for n in range(width)]
    return rows(data, BASE)


def clients_of(df, rule_id):
    return sorted(int(c) for (c,) in as_set(df.where(f"alert_id = '{rule_id}'"), "client_id"))


def test_recency_edges_and_sentinel(rows):
    frame = base(rows, days_since_last_campaign=[13, 14, 9998, 9999, None])
    assert clients_of(alerts.evaluate_alerts(frame, rules.WAREHOUSE_ALERTS, D3), "no_campaign_14d") == [1, 2]
    assert clients_of(alerts.evaluate_alerts(frame, rules.SCRIPT_ALERTS, D3), "no_campaign_14d") == [1, 2, 3]


def test_renewal_edges(rows):
    days = [-1, 0, 30, 31, 90, 91, None]
    frame = base(rows, days_to_renewal=days, health_status=["red"] * 7)
    wh = alerts.evaluate_alerts(frame, rules.WAREHOUSE_ALERTS, D3)
    assert clients_of(wh, "renewal_90d") == [3, 4] and clients_of(wh, "renewal_30d_red") == [1, 2]
    script = alerts.evaluate_alerts(frame, rules.SCRIPT_ALERTS, D3)
    assert clients_of(script, "renewal_90d") == [3, 4] and clients_of(script, "renewal_30d_red") == [0, 1, 2]
    sql = alerts.evaluate_alerts(frame, rules.SQL_V1_ALERTS, D3)
    assert clients_of(sql, "renewal_90d") == [0, 1, 2, 3, 4]


def test_volume_coverage_inactive_and_upsell_edges(rows):
    frame = base(rows, messages_mom_change=[-30.0, -29.99, None, 0.0], coverage_pct=[4.99, 5.0, None, None],
                 health_status=["yellow", "green", "inactive", "yellow"], days_to_renewal=[60, 60, 60, 61],
                 plan_usage_pct=[90.0, 90.0, 90.0, 89.0])
    got = alerts.evaluate_alerts(frame, rules.WAREHOUSE_ALERTS, D3)
    assert clients_of(got, "volume_drop_30pct") == [0]
    assert clients_of(got, "low_base_coverage") == [0, 3]
    assert clients_of(got, "inactive_client") == [2]
    assert clients_of(got, "upsell_opportunity") == [1]


def test_roi_rules(rows):
    frame = base(rows, campaign_roi=[0.9, 0.9, 1.0, None], previous_roi=[1.0, 0.9, 2.0, 2.0])
    assert clients_of(alerts.evaluate_alerts(frame, rules.SQL_V1_ALERTS, D3), "roi_dropped_below_1") == [0, 1]
    assert clients_of(alerts.evaluate_alerts(frame, rules.RULE_FILE_ALERTS, D3), "roi_dropped_below_1") == [0]


def test_missing_coverage_column_counts_as_low(rows):
    frame = base(rows, health_status=["red", "inactive"]).drop("coverage_pct")
    assert clients_of(alerts.evaluate_alerts(frame, rules.SCRIPT_ALERTS, D3), "low_base_coverage") == [0]


def test_metric_text(rows):
    frame = base(rows, messages_mom_change=[-45.5], coverage_pct=[None], days_to_renewal=[40])
    got = as_dict(alerts.evaluate_alerts(frame, rules.WAREHOUSE_ALERTS, D3), "alert_id", "alert_metric")
    assert got == {"renewal_90d": "40", "volume_drop_30pct": "-45.50", "low_base_coverage": "0.00"}


def test_one_pass_equals_rule_by_rule(rows):
    frame = base(rows, days_since_last_campaign=[20, 3, 99], health_status=["red", "green", "inactive"],
                 plan_usage_pct=[95.0] * 3, days_to_renewal=[20, 50, 10], messages_mom_change=[-40.0, 1.0, None])
    for ruleset in rules.ALERT_SETS.values():
        together = alerts.evaluate_alerts(frame, ruleset, D3).count()
        assert together == sum(alerts.evaluate_alerts(frame, [r], D3).count() for r in ruleset)


def test_order_and_summary(rows):
    frame = base(rows, health_status=["red", "red", "green"], days_to_renewal=[20, 200, 40], plan_usage_pct=[1.0, 1.0, 99.0])
    fired = alerts.evaluate_alerts(frame, rules.WAREHOUSE_ALERTS, D3)
    order = [(r["severity"], r["company_name"]) for r in alerts.ordered_alerts(fired).collect()]
    assert order == [("critical", "c0"), ("critical", "c0"), ("critical", "c1"), ("info", "c2"), ("info", "c2")]
    assert [r["company_name"] for r in alerts.most_urgent(fired, 3).collect()] == ["c0", "c0", "c1"]
    assert alerts.alert_summary(fired).first().asDict() == {"total": 5, "critical": 3, "warning": 0, "info": 2}


def test_rule_texts_follow_their_variant():
    by_id = {r.id: r for r in rules.WAREHOUSE_ALERTS}
    assert [r.id for r in rules.SCRIPT_ALERTS] == [r.id for r in rules.RULE_FILE_ALERTS if r.id != "roi_dropped_below_1"]
    assert by_id["renewal_30d_red"].action == "Escalar para gestao - risco alto de churn"
    assert len(rules.WAREHOUSE_ALERTS) == 8 and len(rules.SQL_V1_ALERTS) == 7


def test_run_date_is_the_newest(rows):
    history = rows([row("a", D2, "red"), row("b", D3, "red")], HISTORY)
    dim = rows([(c, c, "x", 500) for c in "ab"], DIM)
    fired = alerts.evaluate_alerts(alerts.alert_base(history, dim), rules.SCRIPT_ALERTS, alerts.run_date(history))
    assert as_set(fired, "alert_date") == {(D3,)}
