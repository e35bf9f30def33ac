"""Client dimension, owner resolution and CRM normalisers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientpulse.functions import (
    add_years, days_between, epoch_or_iso_date, iso_timestamp, latest_rows, person_name, safe_float, safe_int,
    to_date, to_double, total_order, truthy,
)


def client_dimension(companies: DataFrame, config: DataFrame, as_of: date) -> DataFrame:
    """Companies with a product configuration, with tenure and days to renewal at ``as_of``."""
    joined = companies.where(F.col("client_id").isNotNull()).join(config, "client_id", "inner")
    return joined.select(
        "client_id", "hubspot_company_id", "company_name", "segment_ipc", "csm_owner", "has_cs",
        "contract_start_date", "contract_end_date", "mrr", "plan_type", "cashback_enabled", "onboarding_completed",
        days_between(F.lit(as_of), "contract_start_date").alias("days_as_client"),
        days_between("contract_end_date", F.lit(as_of)).alias("days_to_renewal"))


def latest_activity(activity: DataFrame, *columns: str) -> DataFrame:
    """Newest activity row per company id, with the wanted columns (all by default).

    Rows of one moment are ordered by the wanted columns, so that no other column is read, sorted or shuffled.
    """
    wanted = activity.select("id", *columns, *[c for c in ["created_at"] if c not in columns]) if columns else activity
    newest = latest_rows(wanted, ["id"], total_order(wanted, ["id"], [F.col("created_at").desc_nulls_last()]))
    return newest.select("id", *columns) if columns else newest


def owner_directory(owners: DataFrame, blank_as_null: bool = True) -> DataFrame:
    """One row per owner: id, full name, e-mail; of several rows of an id the first named one by name and e-mail."""
    named = owners.select(F.col("id").alias("owner_id"),
                          person_name("firstname", "lastname", blank_as_null).alias("owner_name"),
                          F.col("email").alias("owner_email"))
    return latest_rows(named, ["owner_id"], total_order(named, ["owner_id"], []))


def owners_by_email(owners: DataFrame, blank_as_null: bool = True) -> DataFrame:
    """One row per lower-cased e-mail; the smallest id wins."""
    named = owners.where(F.col("email").isNotNull()).select(
        F.lower("email").alias("csm_email"), F.col("id").alias("owner_id"),
        person_name("firstname", "lastname", blank_as_null).alias("owner_name"))
    return latest_rows(named, ["csm_email"], total_order(named, ["csm_email"], [F.col("owner_id").asc()]))


def with_owner(df: DataFrame, owners: DataFrame, id_columns: Sequence[str], name: str = "csm_owner") -> DataFrame:
    """First known owner name along ``id_columns`` and, separately, the first id that is set."""
    out = df
    found = []
    for i, column in enumerate(id_columns):
        names = owners.select(F.col("owner_id").alias(column), F.col("owner_name").alias(f"_owner_{i}"))
        out = out.join(names, column, "left")
        found.append(F.col(f"_owner_{i}"))
    return (out.withColumn(name, F.coalesce(*found))
               .withColumn(f"{name}_id", F.coalesce(*[F.col(c) for c in id_columns]))
               .drop(*[f"_owner_{i}" for i in range(len(id_columns))]))


def crm_company_facts(crm_companies: DataFrame) -> DataFrame:
    """Typed columns out of the CRM property struct, one row per app name (the smallest company id wins)."""
    p = "properties."
    typed = crm_companies.select(
        F.col("id").alias("hubspot_company_id"),
        F.col(p + "gupshupapp").alias("gupshup_app_name"),
        to_double(p + "mrr_fixo").alias("mrr"),
        F.col(p + "cs_responsavel").alias("cs_owner_id"),
        F.col(p + "cx_responsavel").alias("cx_owner_id"),
        F.col(p + "hubspot_owner_id").alias("crm_owner_id"),
        F.col(p + "lifecyclestage").alias("lifecyclestage"),
        F.col(p + "consultoria_estrategica_contratada").alias("consultoria_estrategica"),
        F.col(p + "hs_csm_sentiment").alias("csm_sentiment"),
        to_double(p + "faturamento_mensal_estimado").alias("faturamento_mensal_estimado"),
        iso_timestamp(p + "createdate").alias("hs_createdate"),
        iso_timestamp(p + "closedate").alias("contract_start_date"),
        to_date(p + "data_do_churn").alias("churn_date"),
        to_double(p + "valor_do_churn").alias("valor_do_churn"),
        iso_timestamp(p + "onboarding_start_date").alias("onboarding_start_date"),
        iso_timestamp(p + "onboarding_end_date").alias("onboarding_end_date"),
        iso_timestamp(p + "data_da_ultima_reuniao_cs").alias("data_ultima_reuniao_cs"),
        F.col(p + "motivo_de_churn").alias("motivo_de_churn"),
        F.col(p + "razao_do_churn").alias("razao_do_churn"))
    return latest_rows(typed.where(F.col("gupshup_app_name").isNotNull()), ["gupshup_app_name"],
                       total_order(typed, ["gupshup_app_name"], [F.col("hubspot_company_id").asc()]))


def warehouse_client_dimension(app_companies: DataFrame, activity: DataFrame, crm_companies: DataFrame,
                               owners: DataFrame, as_of: date) -> DataFrame:
    """Client dimension from product companies, activity summary, CRM companies and owners.

    Every joined side is unique on its key, so each product company gives exactly one row.
    """
    base = app_companies.select(F.col("id").alias("client_id"), F.col("name").alias("company_name"),
                                "gupshup_app_name", "business_sector", "is_active")
    service = latest_activity(activity, "has_customer_service").withColumnRenamed("id", "client_id")
    joined = (base.join(service, "client_id", "left")
                  .join(crm_company_facts(crm_companies), "gupshup_app_name", "left"))
    named = with_owner(joined, owner_directory(owners), ["cs_owner_id", "cx_owner_id", "crm_owner_id"])
    return named.select(
        "client_id", "company_name", "gupshup_app_name", "hubspot_company_id", "mrr", "csm_owner", "csm_owner_id",
        "lifecyclestage", "business_sector", "is_active", "has_customer_service", "consultoria_estrategica",
        "csm_sentiment", "faturamento_mensal_estimado", "hs_createdate", "contract_start_date", "churn_date",
        "valor_do_churn", "onboarding_start_date", "onboarding_end_date", "data_ultima_reuniao_cs",
        "motivo_de_churn", "razao_do_churn",
        days_between(add_years("contract_start_date"), F.lit(as_of)).alias("days_to_renewal"))


# Texts that stand for no date in the exports.
NULL_TEXTS = ("", "None", "nan", "NaT", "null")


def active_clients(dim: DataFrame) -> DataFrame:
    """Clients without a churn date; blank or textual nulls count as none."""
    text = F.trim(F.col("churn_date").cast("string"))
    return dim.where(F.col("churn_date").isNull() | text.isin(*NULL_TEXTS))


def dashboard_clients(dim: DataFrame, upsell_flags: DataFrame, as_of: date,
                      service_column: str = "has_customer_service") -> DataFrame:
    """Warehouse dimension in the local shape: padded columns, contract end, tenure, cashback flag.

    Dates and numbers may come as text; ``service_column`` says whether customer service is contracted.
    """
    cashback = upsell_flags.select("client_id", truthy("cashback_enabled").alias("cashback_enabled"))
    start = to_date("contract_start_date")
    onboarding_end = F.col("onboarding_end_date").cast("string")
    return dim.join(cashback, "client_id", "left").select(
        "client_id", "hubspot_company_id", "company_name", F.lit(None).cast("string").alias("segment_ipc"),
        "csm_owner", truthy(service_column).alias("has_cs"),
        start.alias("contract_start_date"), add_years(start).alias("contract_end_date"),
        F.coalesce(to_double("mrr"), F.lit(0.0)).alias("mrr"), F.lit(None).cast("string").alias("plan_type"),
        F.coalesce("cashback_enabled", F.lit(False)).alias("cashback_enabled"),
        (onboarding_end.isNotNull() & (onboarding_end != "")).alias("onboarding_completed"),
        days_between(F.lit(as_of), start).alias("days_as_client"),
        to_double("days_to_renewal").cast("bigint").alias("days_to_renewal"))


# --- CRM objects in the landed-page shape: id, properties struct of text, company_id -------------


def _filled(*names: str) -> Column:
    """First property that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(F.col(f"properties.{n}"), F.lit("")) for n in names])


# Properties each normaliser reads from a landed object.
COMPANY_PROPERTIES = ("name", "segment_ipc", "industry", "hubspot_owner_id", "has_cs", "contract_start_date",
                      "hs_date_entered_customer", "contract_end_date", "closedate", "mrr", "annualrevenue", "client_id")
DEAL_PROPERTIES = ("amount", "mrr_before", "mrr_after", "deal_type_cs", "dealtype", "closedate", "dealstage")
CALL_PROPERTIES = ("hs_call_duration", "hs_timestamp", "hubspot_owner_id", "call_type", "hs_call_body")
FEEDBACK_PROPERTIES = ("hs_rating", "hs_submission_timestamp")
CONTACT_PROPERTIES = ("nps_score", "nps_date", "associatedcompanyid", "email")


# How each property that is not taken as text is parsed.
_NUMBER = partial(safe_float, default=None)
PARSED = {
    "companies": {**dict.fromkeys(("contract_start_date", "hs_date_entered_customer", "contract_end_date", "closedate"),
                                  epoch_or_iso_date), **dict.fromkeys(("mrr", "annualrevenue"), _NUMBER)},
    "deals": {"closedate": epoch_or_iso_date, **dict.fromkeys(("amount", "mrr_before", "mrr_after"), _NUMBER)},
    "calls": {"hs_timestamp": epoch_or_iso_date, "hs_call_duration": _NUMBER},
    "feedback": {"hs_submission_timestamp": epoch_or_iso_date, "hs_rating": _NUMBER},
    "contacts": {"nps_date": epoch_or_iso_date, "nps_score": _NUMBER},
}


def unparsed_counts(kind: str) -> list[Column]:
    """Per property of a landed kind that is parsed: how many objects have a text for it that is no value of its type.

    For ``functions.observed.watched`` on the landed objects, or for an aggregate over them.
    """
    def lost(name: str, parse: Callable[[Column], Column]) -> Column:
        text = F.nullif(F.trim(F.col(f"properties.{name}")), F.lit(""))
        return F.count_if(text.isNotNull() & parse(text).isNull()).alias(name)

    return [lost(name, parse) for name, parse in PARSED[kind].items()]


def normalise_companies(objects: DataFrame, client_id_property: str = "client_id") -> DataFrame:
    """CRM companies in the raw company shape; without a product id the CRM id takes its place."""
    return objects.select(
        F.col("id").alias("hubspot_company_id"),
        F.coalesce(F.col("properties.name"), F.lit("")).alias("company_name"),
        F.coalesce(_filled("segment_ipc", "industry"), F.lit("")).alias("segment_ipc"),
        F.coalesce(F.col("properties.hubspot_owner_id"), F.lit("")).alias("csm_owner"),
        F.coalesce(F.col("properties.has_cs").isin("true", "1"), F.lit(False)).alias("has_cs"),
        epoch_or_iso_date(_filled("contract_start_date", "hs_date_entered_customer")).alias("contract_start_date"),
        epoch_or_iso_date(_filled("contract_end_date", "closedate")).alias("contract_end_date"),
        safe_float(_filled("mrr", "annualrevenue")).alias("mrr"),
        F.coalesce(F.col(f"properties.{client_id_property}"), F.col("id")).alias("client_id"))


def normalise_deals(objects: DataFrame) -> DataFrame:
    """CRM deals with their signed MRR change; an absent MRR after the deal is its amount."""
    after = F.coalesce(F.col("properties.mrr_after"), F.col("properties.amount"))
    before = safe_float("properties.mrr_before")
    return objects.select(
        F.col("id").alias("deal_id"), F.col("company_id").alias("hubspot_company_id"),
        F.coalesce(_filled("deal_type_cs"), F.col("properties.dealtype"), F.lit("new")).alias("deal_type"),
        before.alias("mrr_before"), safe_float(after).alias("mrr_after"),
        (safe_float(after) - before).alias("mrr_delta"),
        epoch_or_iso_date("properties.closedate").alias("closed_date"),
        F.coalesce(F.col("properties.dealstage"), F.lit("")).alias("deal_stage"))


def normalise_calls(objects: DataFrame, notes_chars: int | None = None) -> DataFrame:
    """CRM calls; durations above 60 count as seconds, others as minutes.

    Notes are kept whole unless ``notes_chars`` says how many characters to keep.
    """
    notes = F.coalesce(F.col("properties.hs_call_body"), F.lit(""))
    seconds = safe_int("properties.hs_call_duration")
    return objects.select(
        F.col("id").alias("call_id"), F.col("company_id").alias("hubspot_company_id"),
        F.coalesce(F.col("properties.hubspot_owner_id"), F.lit("")).alias("csm_owner"),
        epoch_or_iso_date("properties.hs_timestamp").alias("call_date"),
        F.when(seconds > 60, F.floor(seconds / 60)).otherwise(seconds).cast("bigint").alias("duration_minutes"),
        F.coalesce(F.col("properties.call_type"), F.lit("follow_up")).alias("call_type"),
        (notes if notes_chars is None else F.substring(notes, 1, notes_chars)).alias("notes"))


def nps_category(score: Column) -> Column:
    return F.when(score >= 9, "promoter").when(score >= 7, "passive").when(score.isNotNull(), "detractor")


def normalise_nps(feedback: DataFrame | None, contacts: DataFrame | None, drop_zero: bool = False,
                  sought: DataFrame | None = None) -> DataFrame:
    """NPS answers from feedback objects, or from contacts where there is no feedback at all.

    A missing or malformed score drops the answer; ``drop_zero`` also drops real zeros. ``sought`` are the feedback
    objects to look for, where those of ``feedback`` are counted as they pass by.
    """
    def shaped(objects: DataFrame, prefix: str, score: str, when: str, company: Column, mail: Column) -> DataFrame:
        value = safe_int(F.col(f"properties.{score}"), -1)
        return objects.select(
            F.concat(F.lit(prefix), F.col("id")).alias("response_id"), company.alias("hubspot_company_id"),
            mail.alias("contact_email"), value.cast("int").alias("nps_score"),
            epoch_or_iso_date(f"properties.{when}").alias("response_date")).where(
                F.col("nps_score") >= (1 if drop_zero else 0))

    def answers(objects: DataFrame) -> DataFrame:
        return shaped(objects, "", "hs_rating", "hs_submission_timestamp", F.lit(None).cast("string"), F.lit(""))

    parts = []
    if feedback is not None:
        parts.append(answers(feedback))
    if contacts is not None:
        other = shaped(contacts, "nps-", "nps_score", "nps_date", F.col("properties.associatedcompanyid"),
                       F.coalesce(F.col("properties.email"), F.lit("")))
        if parts:
            # Contacts count only while feedback is empty: one uncorrelated subquery, no join.
            other = other.where(~answers(feedback if sought is None else sought).exists())
        parts.append(other)
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.withColumn("nps_category", nps_category(F.col("nps_score")))
