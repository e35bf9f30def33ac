"""Kept newest rows: what a run reads, and that it equals a scan of the whole history."""

import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clientpulse.operators import alerts, features
from clientpulse.plans import state
from clientpulse.plans.lake import Lake
from clientpulse.plans.runs import last_scores, newest_and_recent
from tests.conftest import as_set

SCORES = "client_id bigint, calculated_at date, period_days int, health_status string, campaign_roi double, total_score int"
START = date(2020, 1, 1)


def day(n):
    return START + timedelta(days=n)


def scores(rows, days, clients=(1, 2, 3), salt=0):
    return rows([(c, day(d), p, ("red", "green", "yellow")[(c + d + salt) % 3], float(d + c), (d * 7 + c + salt) % 25)
                 for d in days for c in clients for p in (30, 60) if (c + d) % 4 or c == 1], SCORES)


def full(lake, as_of, period):
    history = lake.read("fct_health_score").where(F.col("calculated_at") <= F.lit(as_of))
    return as_set(alerts.latest_with_previous(history, period).drop("_rank"), "client_id", "calculated_at", "period_days",
                  "total_score", "previous_status", "previous_roi", "previous_at")


def kept(lake, as_of, period):
    return as_set(alerts.latest_with_previous(last_scores(lake, as_of), period), "client_id", "calculated_at", "period_days",
                  "total_score", "previous_status", "previous_roi", "previous_at")


def both_agree(lake, as_of):
    for period in (30, 60, None):
        assert kept(lake, as_of, period) == full(lake, as_of, period)


def test_a_run_over_a_thousand_days_reads_the_state_and_one_day(spark, rows, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(scores(rows, range(1000)), "fct_health_score")
    last_scores(lake, day(999))
    lake.replace_snapshot(scores(rows, [1000]), "fct_health_score", "calculated_at")
    keeper = lake.newest("fct_health_score")
    assert keeper.kept(spark) == [day(999).isoformat()]
    read = keeper.upto(spark, day(1000).isoformat()).inputFiles()
    facts = [f for f in read if "/state_" not in f]
    assert len(read) < 12 and facts and all(f"calculated_at={day(1000)}" in f for f in facts)
    both_agree(lake, day(1000))
    # With its state written, the run's alerts read nothing else.
    assert all("/state_" in f for f in keeper.upto(spark, day(1000).isoformat()).inputFiles())


def test_late_repeated_and_shrunken_days(spark, rows, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(scores(rows, [0, 2, 4, 6]), "fct_health_score")
    for d in (6, 8):
        lake.replace_snapshot(scores(rows, [d]), "fct_health_score", "calculated_at")
        both_agree(lake, day(d))
    keeper = lake.newest("fct_health_score")
    # A late day: states that did not know it go, and the next run reads from before it.
    lake.replace_snapshot(scores(rows, [5], salt=1), "fct_health_score", "calculated_at")
    assert keeper.kept(spark) == []
    both_agree(lake, day(5))
    both_agree(lake, day(8))
    # The same day again with fewer clients: the rows before come back.
    lake.replace_snapshot(scores(rows, [8], clients=(1,)), "fct_health_score", "calculated_at")
    assert keeper.kept(spark) == [day(5).isoformat()]
    both_agree(lake, day(8))
    # Rows that a backfill appends to an old day.
    lake.append_unseen(scores(rows, [7], clients=(9,)), "fct_health_score")
    both_agree(lake, day(8))
    both_agree(lake, day(6))  # a run of a day in the past
    lake.overwrite(scores(rows, [1]), "fct_health_score")
    assert keeper.kept(spark) == []
    both_agree(lake, day(8))


def test_a_state_that_was_not_finished_does_not_count(spark, rows, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(scores(rows, range(4)), "fct_health_score")
    last_scores(lake, day(2))
    broken = tmp_path / "state_fct_health_score" / f"upto-{day(3)}"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"half")
    assert lake.newest("fct_health_score").kept(spark) == [day(2).isoformat()]
    both_agree(lake, day(3))


def test_old_states_go(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "KEPT", 2)
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(scores(rows, range(5)), "fct_health_score")
    for d in range(5):
        last_scores(lake, day(d))
    assert lake.newest("fct_health_score").kept(spark) == [day(3).isoformat(), day(4).isoformat()]


CAMPAIGNS = "client_id bigint, campaign_id bigint, sent_at timestamp_ntz, revenue_attributed double, cost double"


def campaigns(rows, months, clients=range(1, 8), bonus=0.0):
    """Three to five campaigns of some clients in each month; one client only sends in the oldest one."""
    made = []
    for m in months:
        for c in clients:
            for k in range((c * 3 + m) % 5):
                if c != 7 or m == 0:
                    sent = datetime(2020 + m // 12, m % 12 + 1, 1 + (c * 5 + k * 6) % 28, 23, 59 - k)
                    made.append((c, m * 1000 + c * 10 + k, sent, 10.0 * c + k + bonus, float(k % 3)))
    return rows(made + [(1, 5, None, 1.0, 1.0)] * (0 in months), CAMPAIGNS)


@pytest.mark.parametrize("as_of", [date(2021, 6, 17), date(2021, 6, 1), date(2021, 5, 31), date(2020, 1, 3)])
def test_newest_campaigns_from_months(spark, rows, tmp_path, as_of):
    lake = Lake(spark, str(tmp_path))
    lake.land_months(campaigns(rows, range(20)), "campaigns", "sent_at")

    def agree(day_):
        newest, recent = newest_and_recent(lake, "campaigns", "sent_at", day_, 90)
        table = lake.read("campaigns")
        columns = ("client_id", "last_campaign_at", "roi_mean", "roi_pooled")
        assert as_set(features.newest_campaigns(newest, day_), *columns) == as_set(features.newest_campaigns(table, day_), *columns)
        assert as_set(features.last_campaign(newest, day_)) == as_set(features.last_campaign(table, day_))
        assert as_set(features.roi_by_period(recent, day_)) == as_set(features.roi_by_period(table, day_))
        return newest, recent

    agree(as_of)
    newest, recent = agree(as_of)  # now from the state
    facts = [f for f in newest.inputFiles() if "/state_" not in f]
    assert all(f"sent_month={as_of:%Y-%m}" in f for f in facts) and any("/state_" in f for f in newest.inputFiles())
    months = {re.search(r"sent_month=([^/]+)", f)[1] for f in recent.inputFiles()}
    assert len(months) <= 4
    # A correction of an old month.
    lake.land_months(campaigns(rows, [1], bonus=500.0).unionAll(campaigns(rows, [1], clients=[9])), "campaigns", "sent_at")
    agree(as_of)


def test_unchanged_results_of_a_daily_run_with_months(spark, tmp_path):
    """A lake whose campaigns are stored by month gives the scores and alerts of one whose campaigns are one folder."""
    from clientpulse.plans.runs import daily_run
    from pulsechecks.inputs import AS_OF, CURRENT, PREVIOUS, Inputs
    from tests.conftest import SF
    i, found = Inputs(spark, SF), []
    for kind in ("plain", "months"):
        lake = Lake(spark, str(tmp_path / kind))
        for name, df in {"companies": i.companies, "client_config": i.client_config, "automations": i.automations,
                         "chat": i.chat, "messages_monthly": i.messages}.items():
            df.write.parquet(lake.path(name))
        if kind == "plain":
            i.campaigns.write.parquet(lake.path("campaigns"))
        else:
            lake.land_months(i.campaigns, "campaigns", "sent_at")
        out = [daily_run(lake, AS_OF - timedelta(days=n), CURRENT, PREVIOUS, periods=(30, 90)) for n in (40, 1, 0)][-1]
        # Sums of ratios may differ in their last bit, as rows are read from other files.
        found.append({k: {tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in as_set(out[k])}
                      for k in ("fct_health_score", "fct_alerts")})
    assert found[0] == found[1] and found[0]["fct_alerts"]
