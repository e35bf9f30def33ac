"""What the physical plans must and must not contain, and one key that owns a third of the rows."""

import re
from collections import defaultdict
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from clientpulse.operators import activity, alerts, backfill, dimensions, features, reporting, revenue, rules
from pulsechecks.inputs import AS_OF, Inputs
from tests.conftest import SF

def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_rows_are_limited_before_the_shuffle(spark):
    i = Inputs(spark, SF)
    for df in (features.newest_campaigns(i.campaigns, AS_OF), dimensions.latest_activity(i.activity_summary),
               alerts.latest_with_previous(i.history), reporting.client_360(i.clients, i.history)):
        plan = plan_of(df)
        assert re.search(r"WindowGroupLimit .*Partial", plan) and re.search(r"WindowGroupLimit .*Final", plan)


def test_campaigns_are_read_once_per_score(spark):
    i = Inputs(spark, SF)
    plan = plan_of(i.local_scores("sql_v1"))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "orders.parquet" in line and "o_totalprice" in line]
    assert len(scans) == 1


def test_projection_and_filter_reach_the_scan(spark):
    from clientpulse.sources.readers import scan
    plan = plan_of(scan(spark, f"{SF}/orders.parquet", ["o_orderkey"], F.col("o_custkey") == 7))
    assert "PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,7)]" in plan
    assert "o_totalprice" not in plan and "o_orderpriority" not in plan


def test_time_windows_reach_the_scan(spark, tmp_path):
    """On stored tables the as-of windows prune row groups and month partitions."""
    i = Inputs(spark, SF)
    paths = {name: str(tmp_path / name) for name in ("campaigns", "automations", "messages", "calls", "deals")}
    i.campaigns.write.parquet(paths["campaigns"])
    i.automations.write.parquet(paths["automations"])
    i.calls.write.parquet(paths["calls"])
    i.deals.write.parquet(paths["deals"])
    i.messages.write.partitionBy("year_month").parquet(paths["messages"])
    t = {name: spark.read.parquet(path) for name, path in paths.items()}
    first, last = date(2001, 5, 1), date(2001, 6, 30)
    pushed = {
        "GreaterThanOrEqual(sent_at": features.roi_by_period(t["campaigns"], AS_OF),
        "LessThan(sent_at": features.roi_calendar_months(t["campaigns"], AS_OF),
        "GreaterThanOrEqual(call_date": activity.weekly_calls(t["calls"], i.clients, first, last),
        "LessThanOrEqual(call_date": activity.coverage_from_calls(i.clients, t["calls"], first, last),
        "GreaterThanOrEqual(closed_date": revenue.deal_movements(t["deals"], first, last),
        "LessThan(created_at": backfill.monthly_features(i.clients, t["campaigns"], t["automations"], t["messages"],
                                                         first, last)}
    for wanted, df in pushed.items():
        assert any(wanted in line for line in plan_of(df).splitlines() if "PushedFilters" in line), wanted
    plan = plan_of(pushed["LessThan(created_at"])
    scan_line = next(line for line in plan.splitlines() if "FileScan" in line and "messages_sent" in line)
    assert "year_month" in scan_line.split("PartitionFilters: [")[1].split("]")[0]
    two = plan_of(features.messages_two_months(t["messages"], "2001-07", "2001-06"))
    assert "PartitionFilters: [year_month" in two.replace("isnotnull(", "")


def test_all_alert_rules_share_one_pass(spark):
    plan = plan_of(Inputs(spark, SF).warehouse_alerts)
    assert plan.count("customer.parquet") == plan_of(Inputs(spark, SF).warehouse_scores).count("customer.parquet")
    assert "Union" not in plan.replace("UnionByName", "") or plan.count("Union") == plan_of(
        Inputs(spark, SF).warehouse_scores).count("Union")


def test_hot_client(spark, rows):
    """A third of the campaigns and calls belong to one client."""
    n = 6000
    base = datetime(2001, 1, 1)
    data = [(i, 0 if i % 3 == 0 else i % 997, base + timedelta(hours=(i * 7919) % 4000), float(i % 50), float(i % 7))
            for i in range(n)]
    frame = spark.createDataFrame(
        data, "campaign_id bigint, client_id bigint, sent_at timestamp_ntz, revenue_attributed double, cost double"
    ).repartition(8)
    by_client = defaultdict(list)
    for row in data:
        by_client[row[1]].append(row)
    expected = {}
    for client, items in by_client.items():
        top = sorted(items, key=lambda r: (-(r[2] - base).total_seconds(), r[0]))[:3]
        cost = sum(r[4] for r in top)
        expected[client] = (round(sum(r[3] / r[4] if r[4] > 0 else 0.0 for r in top) / len(top), 9),
                            round(sum(r[3] for r in top) / cost, 9) if cost else 0.0)
    got = {r["client_id"]: (round(r["roi_mean"], 9), round(r["roi_pooled"], 9))
           for r in features.newest_campaigns(frame, None).collect()}
    assert got == expected

    calls = frame.select(F.col("campaign_id").alias("call_id"), F.col("client_id").cast("string").alias("hubspot_company_id"),
                         F.lit(None).cast("string").alias("csm_owner"), F.col("sent_at").cast("date").alias("call_date"),
                         F.lit(1).alias("duration_minutes"), F.lit("urgencia").alias("call_type"))
    clients = spark.range(997).select(F.col("id").cast("string").alias("hubspot_company_id"), F.lit("ana").alias("csm_owner"))
    weekly = activity.weekly_calls(calls, clients, date(2001, 1, 1), date(2002, 1, 1))
    assert weekly.agg(F.sum("calls_total")).first()[0] == n


def test_rerun_and_shuffled_input_give_the_same_rows(spark):
    i = Inputs(spark, SF)
    straight = {tuple(r) for r in features.newest_campaigns(i.campaigns, AS_OF).collect()}
    shuffled = {tuple(r) for r in features.newest_campaigns(i.campaigns.repartition(13, F.rand(7)), AS_OF).collect()}
    assert {r[:2] for r in straight} == {r[:2] for r in shuffled}
    scored = alerts.evaluate_alerts(i.alert_base, rules.SCRIPT_ALERTS, AS_OF)
    assert scored.count() == scored.select("client_id", "alert_id").distinct().count()


def test_last_known_values_need_no_sort(spark):
    history = Inputs(spark, SF).history
    stored = spark.createDataFrame(history.limit(5).collect(), history.schema)
    assert "SortAggregate" not in plan_of(reporting.last_known_values(stored))


def test_newest_activity_reads_only_what_is_wanted(spark):
    """Message counts, which come from the lines of orders, are no part of the upsell flags' plan."""
    plan = plan_of(Inputs(spark, SF).upsell_flags)
    assert "lineitem.parquet" not in plan
    sorts = [line for line in plan.splitlines() if re.search(r"WindowGroupLimit|- Sort ", line) and "total_active_flows" in line]
    assert sorts and not any("total_messages" in line for line in sorts)


def test_as_of_reaches_the_scan(spark, tmp_path):
    Inputs(spark, SF).campaigns.write.parquet(str(tmp_path / "campaigns"))
    stored = spark.read.parquet(str(tmp_path / "campaigns"))
    for df in (features.last_campaign(stored, AS_OF), features.newest_campaigns(stored, AS_OF)):
        assert re.search(r"PushedFilters: \[[^\]]*LessThan\(sent_at", plan_of(df))


def test_tied_rows_give_one_result(spark, rows):
    """Equal keys and times: the same row wins however the input is ordered."""
    activity = rows([("a", datetime(2026, 1, 1), n, n * 2) for n in (5, 2, 3, 6, 4)],
                    "id string, created_at timestamp_ntz, total_active_flows bigint, total_customers bigint")
    owners = rows([("1", "Ana", None, "b@x"), ("1", "Bea", None, "a@x"), ("1", None, None, "0@x")],
                  "id string, firstname string, lastname string, email string")
    scores = rows([("a", date(2026, 1, 1), p, t, "red", 0.5) for p in (30, 60) for t in (3, 1, 2)],
                  "client_id string, calculated_at date, period_days int, total_score int, health_status string, campaign_roi double")
    clients = rows([("a",)], "client_id string")
    for seed in range(4):
        def mixed(df):
            return df.repartition(5, F.rand(seed))
        assert dimensions.latest_activity(mixed(activity)).first()["total_active_flows"] == 2
        assert dimensions.owner_directory(mixed(owners)).first()["owner_name"] == "Ana"
        assert alerts.latest_snapshot(mixed(scores), 60).first()["total_score"] == 1
        assert alerts.latest_snapshot(mixed(scores), None).first()["period_days"] == 60
        assert reporting.client_360(clients, mixed(scores)).first()["period_days"] == 30
        assert reporting.client_360(clients, mixed(scores), period_days=None).first()["period_days"] == 60
