"""The batch runs over a folder of tables, run twice."""

import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from clientpulse.plans.lake import Lake
from clientpulse.plans.runs import backfill_run, crm_run, daily_run, replay_run, warehouse_run
from clientpulse.session import shared_dir
from clientpulse.operators import alerts, dimensions, scoring
from clientpulse.sources import readers, writers
from clientpulse.sources.schemas import CSM_ACTIVITY, HEALTH_SCORE, conformed
from pulsechecks.inputs import AS_OF, CURRENT, PREVIOUS, Inputs
from tests.conftest import SF, as_set


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    i = Inputs(spark, SF)
    tables = {"companies": i.companies, "client_config": i.client_config, "campaigns": i.campaigns,
              "automations": i.automations, "chat": i.chat, "messages_monthly": i.messages, "calls": i.calls,
              "deals": i.deals, "app_companies": i.app_companies, "companies_activity_summary": i.activity_summary,
              "crm_companies": i.crm_companies, "owners": i.owners, "whatsapp_campaign_results": i.campaign_results,
              "automation_execution_summary": i.automation_summary, "flow_execution_summary": i.flows, "users": i.users,
              "cashback_configs": i.cashback_configs, "sms_campaigns": i.channel("sms"),
              "email_campaigns": i.channel("email"), "customer_success_meetings": i.meetings, "crm_calls": i.crm_calls}
    for name, df in tables.items():
        df.write.parquet(root.path(name))
    return root


def test_daily_then_backfill(lake):
    first = daily_run(lake, AS_OF, CURRENT, PREVIOUS)
    counts = {k: v.count() for k, v in first.items()}
    assert first["score_summary"].collect() == scoring.score_summary(first["fct_health_score"]).collect()
    assert first["alert_summary"].collect() == alerts.alert_summary(first["fct_alerts"]).collect()
    again = daily_run(lake, AS_OF, CURRENT, PREVIOUS)
    assert {k: v.count() for k, v in again.items()} == counts
    assert counts["fct_health_score"] == counts["dim_clients"] > 100 and counts["fct_alerts"] > 0
    today = again["fct_health_score"].where(F.col("calculated_at") == F.lit(AS_OF))
    assert today.where("campaigns_in_period > 0").count() > 0 and today.where("campaigns_in_period IS NULL").count() == 0
    low = again["fct_alerts"].where("alert_id = 'low_base_coverage'").count()
    assert 0 < low < counts["dim_clients"] and today.where("coverage_pct IS NOT NULL").count() > 0

    window = (date(2001, 1, 1), date(2001, 6, 30))
    filled = backfill_run(lake, *window)
    sizes = {k: v.count() for k, v in filled.items()}
    assert sizes["fct_health_score"] == counts["dim_clients"] * 7
    assert sizes["fct_revenue_retention_monthly"] == 6
    shorter = backfill_run(lake, date(2001, 5, 1), date(2001, 7, 31))
    assert shorter["fct_health_score"].count() == sizes["fct_health_score"] + counts["dim_clients"]
    months = [r["year_month"] for r in shorter["fct_revenue_retention_monthly"].orderBy("year_month").collect()]
    assert months == [f"2001-{m:02d}" for m in range(1, 8)]
    # The next day sees the status of today as the previous one.
    later = daily_run(lake, date(2001, 8, 1), "2001-08", "2001-07")
    drops = as_set(later["fct_alerts"].where("alert_id = 'score_dropped_to_red' AND alert_date = '2001-08-01'"), "client_id")
    history = later["fct_health_score"].where(F.col("calculated_at").isin(date(2001, 7, 31), date(2001, 8, 1)))
    by_day = {(r["client_id"], r["calculated_at"].day): r["health_status"] for r in history.collect()}
    expected = {(c,) for (c, d), s in by_day.items() if d == 1 and s == "red" and by_day.get((c, 31)) != "red"}
    assert drops == expected


def test_warehouse_run(lake):
    out = warehouse_run(lake, AS_OF, "corp.example", (date(1999, 1, 1), 31))
    clients = out["dim_clients"].count()
    assert clients == 150 and out["fct_health_score"].count() == 4 * clients and out["fct_upsell_flags"].count() == clients
    assert out["fct_alerts"].where("alert_id = 'score_red'").count() == out["fct_health_score"].where(
        "health_status = 'red' AND period_days = 30").count()
    assert out["fct_revenue_retention_monthly"].count() == 31
    assert out["fct_csm_activity_weekly"].count() > 0 and out["fct_coverage_monthly"].count() > 0


def test_crm_run(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    pages = {
        "companies": [{"results": [
            {"id": "H1", "properties": {"name": "A", "industry": "shop", "hubspot_owner_id": "7", "has_cs": "true",
                                        "closedate": "2024-05-06T00:00:00Z", "annualrevenue": "12.5", "pid": "P1"}},
            {"id": "H2", "properties": {"hubspot_owner_id": "8", "mrr": "x"}}]}],
        "calls": [{"results": [{"id": "C1", "properties": {"hs_call_duration": "90", "hubspot_owner_id": "7"},
                                "associations": {"companies": {"results": [{"id": "H1", "type": "t"}]}}}]}],
        "contacts": [{"results": [{"id": "N1", "properties": {"nps_score": "9", "email": "a@b"}}]}],
        "owners": [{"results": [{"id": "7", "firstName": "Ana", "lastName": None, "email": "a@corp"}]}]}
    landed = {}
    for kind, content in pages.items():
        folder = tmp_path / kind
        folder.mkdir()
        (folder / "1.json").write_text("\n".join(json.dumps(p) for p in content), encoding="utf-8")
        landed[kind] = str(folder)
    out = crm_run(lake, landed, client_id_property="pid")
    assert as_set(out["companies"], "hubspot_company_id", "csm_owner", "segment_ipc", "has_cs", "mrr", "client_id") == {
        ("H1", "Ana", "shop", True, 12.5, "P1"), ("H2", "8", "", False, 0.0, "H2")}
    assert as_set(out["calls"], "call_id", "hubspot_company_id", "csm_owner", "duration_minutes") == {("C1", "H1", "Ana", 1)}
    assert as_set(out["nps"], "response_id", "nps_category") == {("nps-N1", "promoter")}
    assert "deals" not in out
    # The texts that did not parse, as a second scan counts them.
    lost = {(r["kind"], r["property"]): r["unparsed"] for r in out["unparsed"].collect()}
    assert lost["companies", "mrr"] == 1 and lost["companies", "closedate"] == 0 and sum(lost.values()) == 1
    for kind in ("companies", "calls", "contacts"):
        scanned = readers.read_crm_pages(spark, landed[kind], list(dimensions.PARSED[kind])).agg(*dimensions.unparsed_counts(kind))
        assert {(kind, k): v for k, v in scanned.first().asDict().items()} == {k: v for k, v in lost.items() if k[0] == kind}
    # Pages without objects leave the table as it is, and make none.
    for kind in ("companies", "deals"):
        folder = tmp_path / f"empty-{kind}"
        folder.mkdir()
        (folder / "1.json").write_text(json.dumps({"results": []}), encoding="utf-8")
        landed[kind] = str(folder)
    again = crm_run(lake, {k: landed[k] for k in ("companies", "deals")}, client_id_property="pid")
    assert again["companies"].count() == 2 and "deals" not in again


def test_replay_run(spark, tmp_path):
    def part(name, columns, data):
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps({"columns": columns, "data": data}), encoding="utf-8")
        return str(path)

    exports = {
        "dim_clients": [part("dim", ["client_id", "company_name", "csm_owner", "has_cs", "contract_start_date", "churn_date",
                                     "onboarding_end_date", "mrr", "days_to_renewal", "_pad"],
                             [["1", "Loja A", "Ana", "True", "2024-02-29 10:00:00.000", "", "2024-03-01", "10.5", "40", "x"],
                              ["2", "Loja B", "Ana", "false", "bad", "2025-01-01", "", "x", "", "x"],
                              ["3", "Loja C", "Ana", "0", "", "None", "", "", None, "x"]])],
        "fct_health_score": [part("h1", ["client_id", "calculated_at", "period_days", "total_score", "health_status"],
                                  [["1", "2026-04-18", "30", "12.0", "yellow"], ["2", "2026-04-18", "30", "1", "red"]]),
                             part("h2", ["health_status", "client_id", "calculated_at", "campaign_roi"],
                                  [["red", "3", "2026-04-18", "bad"]])],
        "fct_alerts": [part("a1", ["client_id", "alert_id", "alert_date", "resolved"], [["1", "x", "2026-04-18", "False"]]),
                       part("a2", ["client_id", "alert_id", "alert_date", "resolved"], [["2", "x", "2026-04-18", "true"]])],
        "fct_csm_activity_weekly": [part("w", ["csm_owner", "week_start", "calls_total", "meetings_total"],
                                         [["Ana", "2026-04-13", "3", "2"]])],
        "fct_coverage_monthly": [part("c", ["csm_owner", "year_month", "client_name_slug"],
                                      [["Ana", "2026-04", "loja a"], ["Ana", "2026-04", "loja z"]])],
        "fct_revenue_retention_monthly": [part("r", ["year_month", "mrr_start", "grr"], [["2026-04", "10", ""]])],
        "fct_upsell_flags": [part("u", ["client_id", "has_sms", "has_email", "cashback_enabled"],
                                  [["1", "true", "True", "1"], ["2", "true", "true", "true"]])]}
    out = replay_run(Lake(spark, str(tmp_path / "lake")), exports, date(2026, 4, 18))
    assert as_set(out["dim_clients"], "client_id", "has_cs", "contract_end_date", "mrr", "days_to_renewal",
                  "cashback_enabled", "onboarding_completed") == {
        ("1", True, date(2025, 2, 28), 10.5, 40, True, True), ("3", False, None, 0.0, None, False, False)}
    assert as_set(out["fct_health_score"], "client_id", "total_score", "campaign_roi") == {("1", 12, None), ("3", None, None)}
    assert as_set(out["fct_alerts"], "client_id", "alert_date", "resolved") == {("1", date(2026, 4, 18), False)}
    assert as_set(out["fct_coverage_monthly"], "clients_with_cs_total", "clients_with_cs_contacted",
                  "coverage_with_cs_pct") == {(1, 2, 200.0)}
    assert as_set(out["campaigns"], "campaign_id", "campaign_type") == {("1-sms", "sms"), ("1-email", "email")}
    assert out["fct_revenue_retention_monthly"].first()["grr"] == 0.0
    assert out["fct_csm_activity_weekly"].first()["unique_clients_contacted"] == 2


def test_replay_then_daily_then_backfill_lose_nothing(lake, spark, tmp_path):
    """All runs write one layout: what one run stored is there after the next."""
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    root = Lake(spark, str(tmp_path / "lake"))
    for name in ("companies", "client_config", "campaigns", "automations", "chat", "messages_monthly", "calls", "deals"):
        spark.read.parquet(lake.path(name)).write.parquet(root.path(name))
    scores = [("1", date(2001, 5, 31), 30, 7, "red"), ("2", date(2001, 7, 20), 30, 9, "red")]
    slim = spark.createDataFrame(scores, "client_id string, calculated_at date, period_days int, total_score int, health_status string")
    full = slim.select(F.col("client_id").cast("bigint").alias("client_id"), *conformed(slim, HEALTH_SCORE)[1:])
    root.overwrite(full, "fct_health_score")
    weeks = [("ana", date(1999, 1, 4), 3)]
    root.overwrite(spark.createDataFrame(weeks, "csm_owner string, week_start date, calls_total bigint").select(
        *conformed(spark.createDataFrame(weeks, "csm_owner string, week_start date, calls_total bigint"), CSM_ACTIVITY)),
        "fct_csm_activity_weekly")
    daily = daily_run(root, AS_OF, CURRENT, PREVIOUS)
    clients = daily["dim_clients"].count()
    history = daily["fct_health_score"]
    assert history.count() == clients + 1  # today's snapshot replaced, the older one kept
    filled = backfill_run(root, date(2001, 4, 1), date(2001, 6, 30))
    kept = filled["fct_health_score"]
    assert kept.where("calculated_at = '2001-05-31' AND client_id = 1").select("total_score").first()[0] == 7
    assert kept.count() == 4 * clients
    assert filled["fct_csm_activity_weekly"].where("csm_owner = 'ana'").count() == 1
    staged = [p for p in os.listdir(shared_dir(spark).removeprefix("file:")) if p.startswith("stage-")]
    assert set(staged) <= before


def test_partitions_are_few_files(spark, tmp_path):
    rows = spark.range(0, 6000, 1, 8).select(F.date_add(F.lit(date(2001, 1, 1)), (F.col("id") % 6).cast("int")).alias(
        "calculated_at"), "id")
    writers.replace_snapshot(rows, str(tmp_path / "t"))
    assert len(spark.read.parquet(str(tmp_path / "t")).inputFiles()) == 6
