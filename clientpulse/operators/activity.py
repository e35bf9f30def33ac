"""Account-manager activity and portfolio coverage."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientpulse.functions import (
    Rounding, band, iso_timestamp, latest_rows, month_start, percent, round_exact, round_half_even, slug, text_part,
    to_date, to_long, trimmed, truthy, week_start, year_month,
)
from clientpulse.operators.dimensions import owner_directory, owners_by_email

# Call types counted one by one, and the weekly and monthly targets.
CALL_TYPES = ("consultoria", "onboarding", "urgencia", "follow_up")
TARGET_CALLS = 20
TARGET_SQLS = 3
TARGET_BANDS = [(100, "green"), (70, "yellow")]


def owner_of_row() -> Column:
    """The owner of a row; the landed tables write a missing one as a blank, of whatever white space."""
    return F.nullif(trimmed("csm_owner"), F.lit(""))


def weekly_calls(calls: DataFrame, clients: DataFrame, first: date, last: date) -> DataFrame:
    """Calls per owner and week; the call's own owner, else the owner of the client. A blank owner is none.

    Calls are first counted per company, owner and week, so that only those counts meet the client table.
    """
    minutes = F.coalesce("duration_minutes", F.lit(0))
    per_company = calls.where(F.col("call_date").between(F.lit(first), F.lit(last))).groupBy(
        "hubspot_company_id", owner_of_row().alias("csm_owner"), week_start("call_date").alias("week_start")).agg(
            F.count("*").alias("calls"), F.sum(minutes).alias("minutes"),
            *[F.count_if(F.col("call_type") == t).alias(t) for t in CALL_TYPES])
    owner_of = latest_rows(
        clients.where(F.col("hubspot_company_id").isNotNull()).select(
            "hubspot_company_id", owner_of_row().alias("client_owner")),
        ["hubspot_company_id"], [F.col("client_owner").asc_nulls_last()])
    owned = per_company.join(owner_of, "hubspot_company_id", "left").withColumn(
        "csm_owner", F.coalesce("csm_owner", "client_owner")).where(F.col("csm_owner").isNotNull())
    return owned.groupBy("csm_owner", "week_start").agg(
        F.sum("calls").alias("calls_total"), *[F.sum(t).alias(f"calls_{t}") for t in CALL_TYPES],
        F.count_distinct("hubspot_company_id").alias("unique_clients_contacted"),
        F.sum("minutes").cast("bigint").alias("total_duration_minutes"))


def weekly_meetings(meetings: DataFrame) -> DataFrame:
    """Distinct meetings and their minutes per organiser e-mail and week."""
    known = meetings.where(F.col("start_date").isNotNull() & F.col("organizer").isNotNull())
    return known.groupBy(F.lower("organizer").alias("csm_email"), week_start("start_date").alias("week_start")).agg(
        F.count_distinct("id").alias("meetings_total"),
        F.sum(F.coalesce("meeting_duration_minutes", F.lit(0))).cast("bigint").alias("meeting_duration_minutes"))


def weekly_crm_calls(crm_calls: DataFrame, owners: DataFrame) -> DataFrame:
    """Distinct calls and whole minutes per owner e-mail and week; calls of unknown owners drop out.

    Distinct ids are counted per e-mail and week, because two owners may share an e-mail; the count is
    planned by (e-mail, week, id) first, so a busy owner is spread over tasks.
    """
    at = iso_timestamp("properties.hs_timestamp")
    per_call = crm_calls.select(
        F.col("properties.hubspot_owner_id").alias("owner_id"), week_start(at).alias("week_start"), "id",
        F.coalesce(to_long("properties.hs_call_duration"), F.lit(0).cast("bigint")).alias("ms")).where(
            F.col("week_start").isNotNull() & F.col("owner_id").isNotNull())
    mails = owner_directory(owners).where(F.col("owner_email").isNotNull()).select(
        "owner_id", F.lower("owner_email").alias("csm_email"))
    return per_call.join(mails, "owner_id", "inner").groupBy("csm_email", "week_start").agg(
        F.count_distinct("id").alias("calls_total"),
        F.expr("sum(ms) div 60000").alias("calls_duration_minutes"))


def weekly_activity(meetings: DataFrame, crm_calls: DataFrame, owners: DataFrame) -> DataFrame:
    """Meetings and calls side by side per e-mail and week, under the owner's name where known."""
    zero = F.lit(0).cast("bigint")
    both = weekly_meetings(meetings).join(weekly_crm_calls(crm_calls, owners), ["csm_email", "week_start"],
                                          "full_outer")
    counted = both.withColumns({c: F.coalesce(c, zero) for c in (
        "meetings_total", "calls_total", "meeting_duration_minutes", "calls_duration_minutes")})
    return counted.join(owners_by_email(owners).select("csm_email", "owner_name"), "csm_email", "left").select(
        F.coalesce("owner_name", "csm_email").alias("csm_owner"), "csm_email", "week_start", "meetings_total",
        "calls_total", (F.col("meetings_total") + F.col("calls_total")).alias("activities_total"),
        (F.col("meeting_duration_minutes") + F.col("calls_duration_minutes")).alias("total_duration_minutes"))


def activity_table(weekly: DataFrame) -> DataFrame:
    """Weekly activity in the local shape: numbers out of text, call types 0, one row per owner and week.

    A week that is blank, missing or no date is NULL; an owner's rows of that kind add up to one row.
    """
    def number(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string").try_cast("double").try_cast("bigint"),
                          F.lit(0).cast("bigint")) if name in weekly.columns else F.lit(0).cast("bigint")

    return weekly.where(F.col("csm_owner").isNotNull()).groupBy(
        "csm_owner", to_date("week_start").alias("week_start")).agg(
            F.sum(number("calls_total")).alias("calls_total"),
            *[F.lit(0).cast("bigint").alias(f"calls_{t}") for t in CALL_TYPES],
            F.sum(number("meetings_total")).alias("unique_clients_contacted"),
            F.sum(number("total_duration_minutes")).alias("total_duration_minutes"))


def coverage_from_calls(clients: DataFrame, calls: DataFrame, first: date, last: date) -> DataFrame:
    """Per owner and month: clients with and without CS, and how many of them had a call by that owner.

    Every owner appears in every month. The month list has a fixed length and is attached by ``explode``.
    """
    owned = clients.select(owner_of_row().alias("csm_owner"), "hubspot_company_id", "has_cs").where(
        F.col("csm_owner").isNotNull())
    months = F.sequence(F.trunc(F.lit(first), "MM"), F.trunc(F.lit(last), "MM"), F.expr("interval 1 month"))
    has_cs = F.col("has_cs")
    totals = owned.groupBy("csm_owner").agg(
        F.count_if(has_cs).alias("clients_with_cs_total"),
        F.count_if(~has_cs).alias("clients_without_cs_total")).withColumn("month", F.explode(months))
    called = calls.where(F.col("call_date").between(F.trunc(F.lit(first), "MM"), F.last_day(F.lit(last)))).select(
        owner_of_row().alias("csm_owner"), "hubspot_company_id", month_start("call_date").alias("month")).distinct()
    contacted = called.join(owned, ["csm_owner", "hubspot_company_id"], "inner").groupBy("csm_owner", "month").agg(
        F.count_if(has_cs).alias("clients_with_cs_contacted"),
        F.count_if(~has_cs).alias("clients_without_cs_contacted"))
    return _coverage_columns(totals.join(contacted, ["csm_owner", "month"], "left"), year_month("month"), 2, round_exact)


def _coverage_columns(df: DataFrame, month: Column, scale: int, rounding: Rounding) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    filled = df.withColumns({c: F.coalesce(c, zero) for c in (
        "clients_with_cs_contacted", "clients_without_cs_contacted")})
    return filled.select(
        "csm_owner", month.alias("year_month"), "clients_with_cs_total", "clients_with_cs_contacted",
        "clients_without_cs_total", "clients_without_cs_contacted",
        percent("clients_with_cs_contacted", "clients_with_cs_total", scale, 0.0, rounding).alias(
            "coverage_with_cs_pct"),
        percent("clients_without_cs_contacted", "clients_without_cs_total", scale, 0.0, rounding).alias(
            "coverage_without_cs_pct"),
        F.lit(0).alias("sqls_identified"))


def client_facing_meetings(meetings: DataFrame, internal_domain: str, marker: str = "<>") -> DataFrame:
    """Meetings named ``CSM <> Client`` with at least one attendee from outside, each once."""
    return _client_facing(meetings, internal_domain, marker).distinct()


def _client_facing(meetings: DataFrame, internal_domain: str, marker: str) -> DataFrame:
    outside = F.exists("attendees", lambda a: ~F.lower(a).endswith(f"@{internal_domain.lower()}") & (a != ""))
    return meetings.where(
        F.col("start_date").isNotNull() & F.col("organizer").isNotNull() & F.col("summary").contains(marker)
        & outside).select(F.col("id").alias("meeting_id"), F.lower("organizer").alias("csm_email"), "start_date",
                          "summary")


def coverage_granular(meetings: DataFrame, owners: DataFrame, internal_domain: str, part: int = 2,
                      marker: str = "<>") -> DataFrame:
    """Distinct client-facing meetings per owner (the e-mail where no name is known), month and client slug.

    ``part`` is the side of the marker that names the client.
    """
    facing = _client_facing(meetings, internal_domain, marker)
    counted = facing.groupBy(
        "csm_email", month_start("start_date").alias("month_start"),
        slug(text_part("summary", marker, part)).alias("client_name_slug")).agg(
            F.count_distinct("meeting_id").alias("meetings"))
    names = owners_by_email(owners).select("csm_email", F.coalesce("owner_name", "csm_email").alias("csm_owner"))
    return counted.join(names, "csm_email", "inner").groupBy(
        "csm_owner", year_month("month_start").alias("year_month"), "month_start", "client_name_slug").agg(
            F.sum("meetings").alias("meetings_count"))


def coverage_table(granular: DataFrame, clients: DataFrame) -> DataFrame:
    """Granular coverage as one row per owner and month; an unknown client counts as one with CS.

    Rows without an owner drop out.
    """
    granular = granular.where(F.col("csm_owner").isNotNull())
    portfolio = clients.where(F.col("csm_owner").isNotNull()).select(
        "csm_owner", slug("company_name").alias("client_name_slug"), truthy("has_cs").alias("has_cs"))
    by_slug = portfolio.where(F.col("client_name_slug").isNotNull()).groupBy("csm_owner", "client_name_slug").agg(
        F.max("has_cs").alias("has_cs"))
    has_cs = F.coalesce("has_cs", F.lit(True))
    contacted = granular.join(by_slug, ["csm_owner", "client_name_slug"], "left").groupBy(
        "csm_owner", "year_month").agg(F.count_if(has_cs).alias("clients_with_cs_contacted"),
                                       F.count_if(~has_cs).alias("clients_without_cs_contacted"))
    totals = portfolio.groupBy("csm_owner").agg(
        F.count_if(F.col("has_cs")).alias("clients_with_cs_total"),
        F.count_if(~F.col("has_cs")).alias("clients_without_cs_total"))
    return _coverage_columns(contacted.join(totals, "csm_owner", "left"), F.col("year_month"), 1,
                             round_half_even)


def target_tracking(activity: DataFrame, coverage: DataFrame) -> DataFrame:
    """Latest week's calls and latest month's SQLs per owner against their targets."""
    calls = activity.groupBy("csm_owner").agg(
        F.max("week_start").alias("week_start"), F.max_by("calls_total", "week_start").alias("calls_total"))
    sqls = coverage.groupBy("csm_owner").agg(F.max_by("sqls_identified", "year_month").alias("sqls_identified"))
    joined = calls.join(sqls, "csm_owner", "left").withColumn(
        "sqls_identified", F.coalesce("sqls_identified", F.lit(0)))
    scored = joined.withColumns({"calls_pct": percent("calls_total", F.lit(TARGET_CALLS)),
                                 "sqls_pct": percent("sqls_identified", F.lit(TARGET_SQLS))})
    return scored.withColumns({"calls_band": band("calls_pct", TARGET_BANDS, "red"),
                               "sqls_band": band("sqls_pct", TARGET_BANDS, "red")})


def recent_weeks(activity: DataFrame, weeks: int = 12, last: date | None = None) -> DataFrame:
    """The newest ``weeks`` weeks present for each owner, within the same span of calendar weeks if ``last``."""
    rows = activity
    if last is not None:
        final = F.trunc(F.lit(last), "WEEK")
        rows = rows.where(F.col("week_start").between(F.date_sub(final, 7 * (weeks - 1)), final))
    newest = Window.partitionBy("csm_owner").orderBy(F.col("week_start").desc())
    return rows.withColumn("_n", F.dense_rank().over(newest)).where(F.col("_n") <= weeks).drop("_n")


def latest_coverage_rows(coverage: DataFrame) -> DataFrame:
    """Newest month per owner as two rows: clients with CS and clients without."""
    newest = latest_rows(coverage, ["csm_owner"], [F.col("year_month").desc()])
    # The two row names of the report.
    kinds = (("Com CS", "with_cs"), ("Sem CS", "without_cs"))
    rows = F.array(*[F.struct(
        F.lit(name).alias("kind"), F.col(f"clients_{k}_total").alias("total"),
        F.col(f"clients_{k}_contacted").alias("contacted"), F.col(f"coverage_{k}_pct").alias("coverage_pct"))
        for name, k in kinds])
    return newest.select("csm_owner", "year_month", F.inline(rows))
