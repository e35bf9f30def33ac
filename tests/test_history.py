"""Validity intervals from snapshots, and scores of the past with them."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from clientpulse.operators import backfill, history
from tests.conftest import as_set

SCHEMA = "id string, snapshot_day date, status string"


def day(n):
    return date(2026, 1, 1) + timedelta(days=n)


def test_runs_of_equal_rows_are_one_interval(rows):
    seen = {"a": "xxyyx", "b": "x-xx-", "c": "--y--", "d": "nnnnn"}
    data = [(k, day(3 * n), None if s == "n" else s) for k, text in seen.items() for n, s in enumerate(text) if s != "-"]
    data += [("a", day(0), "z"), ("a", None, "lost")]  # a second row of a day, and one of no day
    got = history.validity_intervals(rows(data, SCHEMA), ["id"], ["status"])
    assert as_set(got, "id", "status", "valid_from", "valid_to") == {
        ("a", "x", None, day(6)), ("a", "y", day(6), day(12)), ("a", "x", day(12), None),
        ("b", "x", None, day(3)), ("b", "x", day(6), day(12)), ("c", "y", day(6), day(9)), ("d", None, None, None)}


def test_every_day_has_what_the_last_snapshot_said(rows):
    import random
    chance = random.Random(3)
    taken = sorted(chance.sample(range(60), 12))
    data = [(k, day(n), chance.choice("xy")) for k in "abcdef" for n in taken if chance.random() < 0.8]
    said = {(k, d): s for k, d, s in data}
    days = F.array(*[F.lit(day(n)) for n in range(-2, 62)])
    got = history.at_days(history.validity_intervals(rows(data, SCHEMA), ["id"], ["status"]), days)
    want = set()
    for n in range(-2, 62):
        last = day(max([t for t in taken if t <= n], default=taken[0]))
        want |= {(k, s, day(n)) for (k, d), s in said.items() if d == last}
    assert as_set(got, "id", "status", "as_of") == want
    assert history.at_days(history.validity_intervals(rows([], SCHEMA), ["id"], ["status"]), days).count() == 0


def test_backfill_with_a_status_change_between_two_month_ends(spark, rows):
    dim = rows([(1, "Ana", 10.0), (2, "Bia", 5.0)], "client_id bigint, csm_owner string, mrr double")
    campaigns = rows([], "client_id bigint, campaign_id bigint, sent_at timestamp_ntz, revenue_attributed double, cost double")
    built = rows([(7, 1, "standard", "paused", None)], "automation_id bigint, client_id bigint, automation_type string, status string, created_at timestamp_ntz")
    chat = rows([], "client_id bigint, has_human_agent boolean, has_chat_flow boolean, has_ai_enabled boolean")
    messages = rows([], "client_id bigint, year_month string, messages_sent bigint, plan_limit bigint")
    config = rows([(1, True), (2, False)], "client_id bigint, cashback_enabled boolean")
    snapshots = history.StatusHistory(
        rows([(7, 1, "standard", "active", date(2026, 1, 15)), (7, 1, "standard", "paused", date(2026, 2, 15))],
             "automation_id bigint, client_id bigint, automation_type string, status string, snapshot_day date"),
        rows([(2, True, True, False, date(2026, 2, 15))], "client_id bigint, has_human_agent boolean, has_chat_flow boolean, has_ai_enabled boolean, snapshot_day date"),
        rows([(1, False, date(2026, 1, 15)), (1, True, date(2026, 2, 15))], "client_id bigint, cashback_enabled boolean, snapshot_day date"))
    months = (date(2026, 1, 1), date(2026, 2, 28))

    def scored(**how):
        out = backfill.backfill_scores(dim, campaigns, built, chat, messages, config, *months, **how)
        return as_set(out.withColumn("cashback", F.col("bonus_cashback") > 0), "client_id", "calculated_at", "active_automations",
                      "chat_usage_level", "cashback")

    ends = (date(2026, 1, 31), date(2026, 2, 28))
    assert scored() == {(c, e, 0, "none", c == 1) for c in (1, 2) for e in ends}
    assert scored(history=snapshots) == {(1, ends[0], 1, "none", False), (1, ends[1], 0, "none", True),
                                         (2, ends[0], 0, "none", False), (2, ends[1], 0, "advanced", False)}
