"""Threshold edges, profiles and the rules compiler."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clientpulse.operators import alerts, backfill, features, rules, scoring
from tests.conftest import as_dict, as_set

AS_OF = date(2026, 4, 8)
FEATURES = ("client_id string, days_since_last_campaign int, campaign_roi double, active_automations bigint, "
            "integration_automations bigint, active_integrations_count int, has_human_agent boolean, "
            "has_chat_flow boolean, has_ai_enabled boolean, chat_usage_level string, messages_mom_change double, "
            "plan_usage_pct double, coverage_pct double, cashback_enabled boolean")
BASE = dict(days_since_last_campaign=9999, campaign_roi=0.0, active_automations=0, integration_automations=0,
            active_integrations_count=0, has_human_agent=False, has_chat_flow=False, has_ai_enabled=False,
            chat_usage_level="none", messages_mom_change=None, plan_usage_pct=None, coverage_pct=None,
            cashback_enabled=False)


def points(rows, profile, column, feature, values, **others):
    data = [(str(n), *{**BASE, **others, feature: v}.values()) for n, v in enumerate(values)]
    scored = scoring.score_points(rows(data, FEATURES), profile)
    found = as_dict(scored, "client_id", column)
    return [found[str(n)] for n in range(len(values))]


@pytest.mark.parametrize("profile", list(rules.PROFILES.values()), ids=lambda p: p.name)
def test_recency_edges(rows, profile):
    assert points(rows, profile, "score_recency", "days_since_last_campaign", [-1, 0, 7, 8, 20, 21, 9999, None]) == [
        5, 5, 5, 3, 3, 0, 0, 0]


@pytest.mark.parametrize("profile", [rules.SQL_V1, rules.PANDAS_V1, rules.ASOF_BACKFILL], ids=lambda p: p.name)
def test_roi_and_integration_edges(rows, profile):
    assert points(rows, profile, "score_roi", "campaign_roi", [None, 0.0, 0.99, 1.0, 9.99, 10.0]) == [0, 0, 0, 3, 3, 5]
    assert points(rows, profile, "score_integrations", "integration_automations", [0, 1, 2, 3, 4, 9]) == [
        0, 2, 2, 4, 5, 5]


@pytest.mark.parametrize("profile", list(rules.PROFILES.values()), ids=lambda p: p.name)
def test_automation_edges(rows, profile):
    assert points(rows, profile, "score_automations", "active_automations", [0, 1, 2, 3]) == [0, 3, 3, 5]


def test_integrations_by_list(rows):
    assert points(rows, rules.WAREHOUSE_V1_1, "score_integrations", "active_integrations_count", [0, 1, 2, 3]) == [
        0, 3, 5, 5]


def test_volume_edges(rows):
    changes = [None, -30.0, -10.01, -10.0, 0.0, 0.01, 10.0, 10.01]
    narrow, wide = [0, 0, 0, 3, 3, 5, 5, 5], [0, 0, 0, 3, 3, 3, 3, 5]
    for profile, expected in ((rules.WAREHOUSE_V1_1, narrow), (rules.SQL_V1, narrow), (rules.ASOF_BACKFILL, narrow),
                              (rules.PANDAS_V1, wide)):
        assert points(rows, profile, "score_volume", "messages_mom_change", changes) == expected, profile.name
        assert points(rows, profile, "score_volume", "plan_usage_pct", [None, 79.99, 80.0],
                      messages_mom_change=-50.0) == [0, 0, 5], profile.name


def test_stable_wins_over_low_usage(rows):
    assert points(rows, rules.WAREHOUSE_V1_1, "score_volume", "plan_usage_pct", [5.0], messages_mom_change=0.0) == [3]


def test_coverage_edges(rows):
    assert points(rows, rules.WAREHOUSE_V1_1, "score_coverage", "coverage_pct", [None, 4.99, 5.0, 14.99, 15.0]) == [
        0, 0, 3, 3, 5]


def test_cashback_bonus_differs(rows):
    for profile, bonus in ((rules.SQL_V1, 2), (rules.PANDAS_V1, 0), (rules.ASOF_BACKFILL, 5)):
        assert points(rows, profile, "bonus_cashback", "cashback_enabled", [False, True]) == [0, bonus]


def test_chat_levels(rows):
    cases = [(True, True, True), (True, False, True), (True, True, False), (True, False, False), (False, True, False),
             (False, True, True), (False, False, True), (False, False, False), (None, None, None)]
    df = rows([(str(n), *c) for n, c in enumerate(cases)],
              "client_id string, has_human_agent boolean, has_chat_flow boolean, has_ai_enabled boolean")
    found = as_dict(features.chat_usage(df), "client_id", "chat_usage_level")
    assert [found[str(n)] for n in range(len(cases))] == [
        "advanced", "advanced", "advanced", "essential", "essential", "essential", "none", "none", "none"]


def bands(rows, profile, totals):
    df = rows([(t,) for t in totals], "total_score int").select(
        "total_score", rules.compile_bands(F.col("total_score"), profile.bands, profile.below).alias("s"))
    found = as_dict(df, "total_score", "s")
    return [found[t] for t in totals]


def test_band_edges(rows):
    assert bands(rows, rules.WAREHOUSE_V1_1, [0, 3, 4, 10, 11, 18, 19, 30]) == [
        "inactive", "inactive", "red", "red", "yellow", "yellow", "green", "green"]
    assert bands(rows, rules.PANDAS_V1, [0, 10, 11, 18, 19]) == ["red", "red", "yellow", "yellow", "green"]
    for profile in (rules.SQL_V1, rules.ASOF_BACKFILL):
        assert bands(rows, profile, [0, 15, 16, 25, 26]) == ["red", "red", "yellow", "yellow", "green"]


def test_profiles_agree_where_inputs_do(rows):
    data = [(str(n), d, 4.0, a, i, i, True, False, False, "essential", m, 50.0, 20.0, False)
            for n, (d, a, i, m) in enumerate([(3, 4, 0, 20.0), (15, 1, 4, -50.0), (40, 0, 0, -5.0)])]
    shared = ("client_id", "score_recency", "score_automations", "score_chat", "score_volume")
    found = [as_set(scoring.score_points(rows(data, FEATURES), p), *shared) for p in rules.PROFILES.values()]
    assert all(f == found[0] for f in found)


def test_total_is_the_sum_and_missing_criteria_stay_null(rows):
    data = [("a", 3, 4.0, 3, 1, 2, True, True, False, "advanced", 5.0, 50.0, 6.0, True)]
    full = scoring.health_score(rows(data, FEATURES), rules.WAREHOUSE_V1_1, AS_OF).first()
    assert full["total_score"] == 5 + 5 + 5 + 5 + 5 + 3 and full["health_status"] == "green"
    assert full["score_roi"] is None and full["bonus_cashback"] is None
    local = scoring.health_score(rows(data, FEATURES), rules.SQL_V1, AS_OF).first()
    assert local["total_score"] == 5 + 3 + 5 + 2 + 5 + 5 + 2 and local["score_coverage"] is None


def test_labels(rows):
    data = [("a", 3, 4.0, 2, 0, 1, True, False, False, "essential", None, None, None, False)]
    got = scoring.criterion_labels(rows(data, FEATURES), rules.WAREHOUSE_V1_1).first().asDict()
    assert got == {"client_id": "a", "label_recency": "Ativa (ultimos 7 dias)", "label_automations": "Basico (1-2)",
                   "label_integrations": "Basico (1)", "label_chat": "Essencial", "label_volume": None,
                   "label_coverage": "Baixa (<5%)"}


def test_rules_file(tmp_path, rows):
    text = """{"recency": {"rules": [{"condition": "days_since_last_campaign == 3", "points": 4, "label": "three"}]},
      "classification": {"low": {"min_score": 0, "max_score": 3}, "high": {"min_score": 4}},
      "alerts": [{"id": "x", "name": "X", "condition": "health_status == 'high' AND days_to_renewal <= 5",
                  "severity": "info", "action": "call"}]}"""
    path = tmp_path / "rules.json"
    path.write_text(text, encoding="utf-8")
    yaml_path = tmp_path / "rules.yaml"
    yaml_path.write_text(text, encoding="utf-8")
    profile, alert_rules = rules.load_rules(str(path))
    assert rules.load_rules(str(yaml_path)) == (profile, alert_rules)
    data = [(str(n), *{**BASE, "days_since_last_campaign": d}.values()) for n, d in enumerate((3, 4))]
    scored = scoring.classify(scoring.score_points(rows(data, FEATURES), profile), profile)
    assert as_dict(scored, "client_id", "health_status") == {"0": "high", "1": "low"}
    assert alert_rules[0].id == "x"


# --- features ---

CAMPAIGN = "campaign_id string, client_id string, sent_at timestamp_ntz, revenue_attributed double, cost double"


def test_newest_three_ties_costs_and_undated(rows):
    sent = datetime(2026, 4, 1, 10)
    data = [("1", "a", datetime(2026, 3, 1), 100.0, 10.0), ("2", "a", sent, 30.0, 10.0), ("3", "a", sent, 50.0, 0.0),
            ("4", "a", sent, 90.0, 30.0), ("5", "a", sent, 9.0, 1.0), ("6", "a", None, 1.0, 1.0),
            ("7", "b", sent, 5.0, 0.0)]
    got = {r["client_id"]: r for r in features.newest_campaigns(rows(data, CAMPAIGN), None).collect()}
    assert got["a"]["roi_mean"] == pytest.approx((3 + 0 + 3) / 3)
    assert got["a"]["roi_pooled"] == pytest.approx(170 / 40)
    assert got["a"]["last_campaign_at"] == sent
    assert (got["b"]["roi_mean"], got["b"]["roi_pooled"]) == (0.0, 0.0)


def test_roi_by_period(rows):
    days = [(1, 0), (2, 6), (3, 7), (4, 29), (5, 89), (6, 90), (7, -1)]
    data = [(str(n), "a", datetime.combine(date.fromordinal(AS_OF.toordinal() - d), datetime.min.time()), 10.0 * n, 5.0)
            for n, d in days]
    got = {r["period_days"]: (r["campaigns_in_period"], r["campaign_roi"])
           for r in features.roi_by_period(rows(data, CAMPAIGN), AS_OF).collect()}
    assert got == {7: (2, 3.0), 30: (4, 5.0), 60: (4, 5.0), 90: (5, 6.0)}


AUTOMATION = "automation_id string, client_id string, automation_type string, status string, created_at timestamp_ntz"
MESSAGE = "client_id string, year_month string, messages_sent bigint, plan_limit bigint"
CHAT = "client_id string, has_human_agent boolean, has_chat_flow boolean, has_ai_enabled boolean"
DIM = ("client_id string, company_name string, csm_owner string, mrr double, days_to_renewal int, "
       "cashback_enabled boolean")


def month_end_inputs(rows):
    dim = rows([("a", "A", "x", 1.0, 10, True), ("b", "B", "x", 1.0, 10, False)], DIM)
    campaigns = rows([("1", "a", datetime(2025, 10, 31, 10), 40.0, 10.0), ("2", "a", datetime(2025, 7, 1), 1000.0, 1.0),
                      ("3", "a", datetime(2025, 12, 5), 10.0, 10.0), ("4", "z", datetime(2025, 12, 5), 1.0, 1.0)], CAMPAIGN)
    automations = rows([("1", "a", "integration", "active", datetime(2025, 10, 31)),
                        ("2", "a", None, "active", datetime(2025, 11, 30, 12)),
                        ("3", "a", "standard", "paused", datetime(2025, 1, 1))], AUTOMATION)
    messages = rows([("a", "2025-10", 100, 200), ("a", "2025-11", 90, 0), ("a", "2026-01", 5, 10)], MESSAGE)
    chat = rows([("a", True, False, True)], CHAT)
    return dim, campaigns, automations, messages, chat


def month_end_rows(rows, cut):
    dim, campaigns, automations, messages, chat = month_end_inputs(rows)
    scores = backfill.backfill_scores(dim, campaigns, automations, chat, messages, dim, date(2025, 10, 1),
                                      date(2026, 1, 31), midnight_cut=cut)
    return {(r["client_id"], r["calculated_at"].month): r for r in scores.collect()}


def test_backfill_uses_only_what_was_known(rows):
    got = month_end_rows(rows, cut=False)
    assert len(got) == 8
    a = {m: got[("a", m)] for m in (10, 11, 12, 1)}
    assert [a[m]["days_since_last_campaign"] for m in (10, 11, 12, 1)] == [0, 30, 26, 57]
    assert [a[m]["campaign_roi"] for m in (10, 11, 12, 1)] == [4.0, 4.0, 2.5, 1.0]
    assert [a[m]["integration_automations"] for m in (10, 11, 12, 1)] == [1, 1, 1, 1]
    assert [a[m]["active_automations"] for m in (10, 11, 12, 1)] == [0, 1, 1, 1]
    assert [a[m]["messages_mom_change"] for m in (10, 11, 12, 1)] == [None, -10.0, None, None]
    assert [a[m]["plan_usage_pct"] for m in (10, 11, 12, 1)] == [50.0, None, None, 50.0]
    assert a[10]["bonus_cashback"] == 5 and a[10]["chat_usage_level"] == "advanced"
    b = got[("b", 10)]
    assert b["days_since_last_campaign"] is None and b["campaign_roi"] is None and b["total_score"] == 0


def test_backfill_midnight_cut_drops_the_last_day(rows):
    got = month_end_rows(rows, cut=True)
    a = {m: got[("a", m)] for m in (10, 11, 12, 1)}
    # The campaign of 31 October 10:00 is unknown in October but still belongs to October afterwards.
    assert [a[m]["days_since_last_campaign"] for m in (10, 11, 12, 1)] == [122, 30, 26, 57]
    assert [a[m]["campaign_roi"] for m in (10, 11, 12, 1)] == [None, 4.0, 2.5, 1.0]
    assert [a[m]["active_automations"] for m in (10, 11, 12, 1)] == [0, 0, 1, 1]
    assert [a[m]["integration_automations"] for m in (10, 11, 12, 1)] == [1, 1, 1, 1]


def test_unknown_change_is_zero_points_or_stable(rows):
    dim, campaigns, automations, messages, chat = month_end_inputs(rows)
    got = {}
    for variant in ("sql_v1", "pandas_v1"):
        feats = features.local_features(dim, campaigns, automations, chat, messages, date(2026, 1, 31), "2026-01", "2025-12",
                                        variant)
        row = scoring.health_score(feats, rules.PROFILES[variant], date(2026, 1, 31)).where("client_id = 'b'").first()
        got[variant] = (row["messages_mom_change"], row["plan_usage_pct"], row["score_volume"],
                        row["days_since_last_campaign"])
    assert got == {"sql_v1": (None, None, 0, 9999), "pandas_v1": (0.0, 0.0, 3, 999)}


def test_shares_are_doubles(rows):
    frame = rows([(7, 3, 0)], "a bigint, b bigint, messages_sent_previous bigint")
    got = frame.select(features.plan_usage("a", "b").alias("u"), features.message_change("a", "b").alias("c"))
    assert got.dtypes == [("u", "double"), ("c", "double")] and tuple(got.first()) == (233.33, 133.33)


def test_pandas_profile_scores_before_rounding(rows):
    dim, campaigns, automations, _, chat = month_end_inputs(rows)
    messages = rows([("a", "2026-01", 79_996, 100_000), ("b", "2025-12", 100_000, 1), ("b", "2026-01", 110_004, 10**9)], MESSAGE)
    got = {}
    for variant in ("sql_v1", "pandas_v1"):
        feats = features.local_features(dim, campaigns, automations, chat, messages, date(2026, 1, 31), "2026-01", "2025-12",
                                        variant)
        for row in scoring.health_score(feats, rules.PROFILES[variant], date(2026, 1, 31)).collect():
            got[(variant, row["client_id"])] = (row["plan_usage_pct"], row["messages_mom_change"], row["score_volume"])
    assert got[("sql_v1", "a")] == (80.0, None, 5) and got[("pandas_v1", "a")] == (80.0, 0.0, 3)
    assert got[("pandas_v1", "b")] == (0.01, 10.0, 5) and got[("sql_v1", "b")][1:] == (10.0, 5)


def test_scores_do_not_see_campaigns_after_the_day(rows):
    sent = [("1", "a", datetime(2026, 4, 1, 9), 10.0, 1.0), ("2", "a", datetime(2026, 4, 8, 23), 4.0, 1.0),
            ("3", "a", datetime(2026, 4, 9), 100.0, 1.0), ("4", "b", datetime(2026, 4, 9, 1), 1.0, 1.0)]
    frame, day = rows(sent, CAMPAIGN), date(2026, 4, 8)
    assert as_set(features.last_campaign(frame, day), "client_id", "days_since_last_campaign") == {("a", 0)}
    assert as_set(features.last_campaign(frame, day, bounded=False), "client_id", "days_since_last_campaign") == {
        ("a", -1), ("b", -1)}
    assert as_set(features.roi_pooled_last(frame, day), "client_id", "campaign_roi") == {("a", 7.0)}
    results = frame.select("client_id", "campaign_id", F.col("sent_at").alias("whatsapp_campaign_sent_at"),
                           F.col("revenue_attributed").alias("campaign_roi"))
    assert as_set(features.roi_values_last(results, day), "client_id", "campaign_roi") == {("a", 7.0)}


def test_score_rows_per_window(rows):
    sent = [("1", "a", datetime(2026, 4, 5), 10.0, 1.0), ("2", "a", datetime(2026, 3, 1), 2.0, 1.0)]
    day = date(2026, 4, 8)
    feats = rows([("a", 0.5), ("b", 0.5)], "client_id string, campaign_roi double")
    windows = features.roi_by_period(rows(sent, CAMPAIGN), day)
    got = features.with_periods(feats, windows)
    assert as_set(got.where("client_id = 'a'"), "period_days", "campaign_roi", "campaigns_in_period") == {
        (7, 10.0, 1), (30, 10.0, 1), (60, 6.0, 2), (90, 6.0, 2)}
    assert as_set(got.where("client_id = 'b'"), "campaign_roi", "campaigns_in_period") == {(0.0, 0)}
    own = features.with_periods(feats, windows, (30,), own_roi=True)
    assert as_set(own, "client_id", "campaign_roi", "campaigns_in_period") == {("a", 0.5, 1), ("b", 0.5, 0)}


def test_backfill_keeps_very_old_campaigns(rows):
    dim, _, automations, messages, chat = month_end_inputs(rows)
    campaigns = rows([("1", "a", datetime(2023, 1, 1), 1.0, 1.0), ("2", "b", datetime(2023, 6, 1), 1.0, 1.0)], CAMPAIGN)
    got = backfill.backfill_scores(dim, campaigns, automations, chat, messages, dim, date(2025, 11, 1), date(2025, 11, 30))
    assert as_set(got, "client_id", "days_since_last_campaign") == {("a", 1064), ("b", 913)}
    silent = [r for r in rules.WAREHOUSE_ALERTS if r.id == "no_campaign_14d"]
    base = got.withColumns({c: F.lit(None).cast("string") for c in ("company_name", "csm_owner")})
    assert as_set(alerts.evaluate_alerts(base, silent, date(2025, 11, 30)), "client_id", "alert_metric") == {
        ("a", "1064"), ("b", "913")}
    literal = backfill.monthly_features(dim, campaigns, automations, messages, date(2025, 11, 1), date(2025, 11, 30),
                                        unknown_from=999)
    assert as_set(literal, "client_id", "days_since_last_campaign") == {("a", None), ("b", 913)}
