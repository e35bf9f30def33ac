"""Column types of every table the operators read or write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
          "boolean": T.BooleanType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType()}


def _schema(columns: str) -> T.StructType:
    """Flat schema from ``name type`` pairs; needs no running session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Raw tables.
COMPANIES = _schema(
    "hubspot_company_id string, company_name string, segment_ipc string, csm_owner string, has_cs boolean, "
    "contract_start_date date, contract_end_date date, mrr double, client_id string")
DEALS = _schema(
    "deal_id string, hubspot_company_id string, deal_type string, mrr_before double, mrr_after double, "
    "mrr_delta double, closed_date date, deal_stage string")
CALLS = _schema(
    "call_id string, hubspot_company_id string, csm_owner string, call_date date, duration_minutes bigint, "
    "call_type string, notes string")
NPS = _schema(
    "response_id string, hubspot_company_id string, contact_email string, nps_score int, nps_category string, "
    "response_date date")
CAMPAIGNS = _schema(
    "campaign_id string, client_id string, campaign_name string, sent_at timestamp_ntz, recipients_count int, "
    "messages_sent int, revenue_attributed double, cost double, campaign_type string")
AUTOMATIONS = _schema(
    "automation_id string, client_id string, automation_name string, automation_type string, status string, "
    "created_at timestamp_ntz, last_triggered_at timestamp_ntz")
CHAT = _schema(
    "client_id string, has_human_agent boolean, human_agents_count int, has_chat_flow boolean, "
    "has_ai_enabled boolean, last_conversation_at timestamp_ntz")
MESSAGES_MONTHLY = _schema("client_id string, year_month string, messages_sent bigint, plan_limit bigint")
CLIENT_CONFIG = _schema(
    "client_id string, plan_type string, cashback_enabled boolean, onboarding_completed boolean, "
    "onboarding_completed_at date")

# Modelled tables.
DIM_CLIENTS = _schema(
    "client_id string, hubspot_company_id string, company_name string, segment_ipc string, csm_owner string, "
    "has_cs boolean, contract_start_date date, contract_end_date date, mrr double, plan_type string, "
    "cashback_enabled boolean, onboarding_completed boolean, days_as_client int, days_to_renewal int")
HEALTH_SCORE = _schema(
    "client_id string, calculated_at date, period_days int, "
    "score_recency int, score_roi int, score_automations int, score_integrations int, score_chat int, "
    "score_volume int, score_coverage int, bonus_cashback int, "
    "days_since_last_campaign int, campaign_roi double, campaigns_in_period bigint, "
    "active_automations bigint, integration_automations bigint, active_integrations_count int, active_flows bigint, "
    "chat_usage_level string, has_human_agent boolean, has_chat_flow boolean, has_ai_enabled boolean, "
    "messages_sent_current bigint, messages_sent_previous bigint, messages_mom_change double, "
    "plan_usage_pct double, coverage_pct double, total_score int, health_status string")
ALERTS = _schema(
    "client_id string, alert_date date, alert_id string, alert_name string, severity string, "
    "action_suggested string, resolved boolean, resolved_at timestamp_ntz, resolved_by string")
CSM_ACTIVITY = _schema(
    "csm_owner string, week_start date, calls_total bigint, calls_consultoria bigint, calls_onboarding bigint, "
    "calls_urgencia bigint, calls_follow_up bigint, unique_clients_contacted bigint, total_duration_minutes bigint")
COVERAGE = _schema(
    "csm_owner string, year_month string, clients_with_cs_total bigint, clients_with_cs_contacted bigint, "
    "clients_without_cs_total bigint, clients_without_cs_contacted bigint, coverage_with_cs_pct double, "
    "coverage_without_cs_pct double, sqls_identified int")
REVENUE = _schema(
    "year_month string, mrr_start double, mrr_churn double, mrr_downgrade double, mrr_upsell double, "
    "mrr_cross_sell double, mrr_new double, mrr_end double, grr double, nrr double")

# Landed JSON.
EXPORT_PART = T.StructType([
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("data", T.ArrayType(T.ArrayType(T.StringType())))])
_LINK = _schema("id string, type string")
CRM_PAGE = T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("associations", T.StructType([T.StructField("companies", T.StructType([
            T.StructField("results", T.ArrayType(_LINK))]))]))]))),
    T.StructField("paging", T.StructType([T.StructField("next", _schema("after string, link string"))]))])
OWNER_PAGE = T.StructType([T.StructField("results", T.ArrayType(
    _schema("id string, firstName string, lastName string, email string")))])


def conformed(df: DataFrame, schema: T.StructType, keep_types: tuple[str, ...] = ()) -> list[Column]:
    """The columns of ``schema`` taken from ``df``: missing ones NULL, present ones cast.

    Columns in ``keep_types`` keep their own type, so keys may be numbers or text.
    """
    present = set(df.columns)

    def one(field: T.StructField) -> Column:
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if field.name in keep_types:
            return F.col(field.name)
        return F.col(field.name).cast(field.dataType).alias(field.name)

    return [one(f) for f in schema.fields]


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed table without rows, for a source that is not connected."""
    return spark.createDataFrame([], schema)
