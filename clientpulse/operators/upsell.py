"""Product flags per client and the gaps between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientpulse.functions import item_count, percent, truthy
from clientpulse.operators.dimensions import latest_activity
from clientpulse.operators.features import automation_counts, keys_having, with_flag

# Product names of the upsell report and the flag of each.
PRODUCTS = {
    "Fluxo de Atendimento": "has_chat_flow",
    "SMS": "has_sms",
    "Email": "has_email",
    "Agente de IA": "has_ai_enabled",
    "Automacao de Integracao 2+": "has_integration_automations",
    "Automacao de Campanhas": "has_active_automations",
    "Cashback Ativo": "cashback_enabled",
}
FLAGS = tuple(PRODUCTS.values())


def missing_products(flags: Sequence[str] = FLAGS) -> Column:
    """How many of the product flags are not set; unknown counts as not set."""
    return sum((F.when(F.col(f), 0).otherwise(1) for f in flags), F.lit(0))


def upsell_flags(dim: DataFrame, activity: DataFrame, automations: DataFrame, sms: DataFrame, email: DataFrame,
                 users: DataFrame, cashback_configs: DataFrame,
                 standard_type: str = "Personalizada") -> DataFrame:
    """Seven product flags and four counts per client; facts are keyed on ``company_id``."""
    def by_client(df: DataFrame) -> DataFrame:
        return df.withColumnRenamed("company_id", "client_id")

    summary = latest_activity(activity, "total_active_flows", "active_integrations").withColumnRenamed("id", "client_id")
    kind = F.col("automation_type")
    counts = automation_counts(by_client(automations), F.col("automation_is_active"), kind == standard_type,
                               kind != standard_type)
    joined = (dim.select("client_id", "company_name", "csm_owner", "mrr")
                 .join(summary, "client_id", "left").join(counts, "client_id", "left"))
    for df, condition, flag in (
            (sms, None, "has_sms"), (email, None, "has_email"),
            (users, F.col("ai_agent_id") != "", "has_ai_enabled"),
            (cashback_configs, F.col("is_active"), "cashback_enabled")):
        joined = with_flag(joined, keys_having(by_client(df), condition), flag)
    zero = F.lit(0).cast("bigint")
    flagged = joined.withColumns({
        "std_autos_count": F.coalesce("active_automations", zero),
        "integ_autos_count": F.coalesce("integration_automations", zero),
        "active_flows_count": F.coalesce("total_active_flows", zero),
        "ecommerce_integrations_count": item_count("active_integrations")}).withColumns({
            "has_chat_flow": F.col("active_flows_count") > 0,
            "has_integration_automations": F.col("integ_autos_count") >= 2,
            "has_active_automations": F.col("std_autos_count") > 0})
    return flagged.withColumn("upsell_opportunities_count", missing_products()).select(
        "client_id", "company_name", "csm_owner", "mrr", *FLAGS, "std_autos_count", "integ_autos_count",
        "active_flows_count", "ecommerce_integrations_count", "upsell_opportunities_count")


def campaign_channels(campaigns: DataFrame, key: str = "client_id") -> DataFrame:
    """Whether a client ever sent an SMS or an e-mail campaign."""
    kind = F.col("campaign_type")
    return campaigns.groupBy(key).agg(
        F.coalesce(F.bool_or(kind == "sms"), F.lit(False)).alias("has_sms"),
        F.coalesce(F.bool_or(kind == "email"), F.lit(False)).alias("has_email"))


def channel_marker_campaigns(upsell: DataFrame) -> DataFrame:
    """Marker campaign rows that carry the SMS and e-mail flags of an upsell table."""
    channels = F.array(*[F.when(truthy(f"has_{c}"), F.lit(c)) for c in ("sms", "email")])
    rows = upsell.select("client_id", F.explode(F.array_compact(channels)).alias("campaign_type"))
    return rows.select(
        F.concat_ws("-", F.col("client_id").cast("string"), "campaign_type").alias("campaign_id"), "client_id",
        F.concat(F.lit("_synthetic_"), "campaign_type", F.lit("_flag")).alias("campaign_name"),
        F.lit(None).cast("timestamp_ntz").alias("sent_at"), F.lit(0).alias("recipients_count"),
        F.lit(0).alias("messages_sent"), F.lit(0.0).alias("revenue_attributed"), F.lit(0.0).alias("cost"),
        "campaign_type")


def product_base(client_health: DataFrame, channels: DataFrame) -> DataFrame:
    """Client 360 rows with all seven flags; a client without score or campaigns has none of them."""
    columns = [c for c in client_health.columns if c not in ("has_sms", "has_email")]
    joined = client_health.select(*columns).join(channels, "client_id", "left").withColumns({
        "has_integration_automations": F.col("integration_automations") >= 2,
        "has_active_automations": F.col("active_automations") > 0})
    return joined.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in FLAGS})


def product_adoption(base: DataFrame) -> DataFrame:
    """Clients with and without each product, and the share with it.

    One aggregation to one row; the products become rows afterwards.
    """
    counts = base.agg(F.count("*").alias("total"), *[F.count_if(F.col(f)).alias(f) for f in FLAGS])
    rows = F.array(*[F.struct(F.lit(name).alias("product"), F.col(flag).alias("has_product"),
                              (F.col("total") - F.col(flag)).alias("lacks_product"))
                     for name, flag in PRODUCTS.items()])
    return counts.select("total", F.inline(rows)).select(
        "product", "has_product", "lacks_product", percent("has_product", "total", 2, 0.0).alias("adoption_pct"))


def opportunity_order() -> list[Column]:
    """The order of the list, for ``writers.write_ordered``."""
    return [F.col("product"), F.col("total_score").asc_nulls_last(), F.col("client_id")]


def product_opportunities(base: DataFrame, csm: str | None = None, status: str | None = None, ordered: bool = True) -> DataFrame:
    """Clients that lack a product, lowest score first within each product."""
    rows = base
    if csm is not None:
        rows = rows.where(F.col("csm_owner") == csm)
    if status is not None:
        rows = rows.where(F.col("health_status") == status)
    lacking = F.array_compact(F.array(*[F.when(~F.col(flag), F.lit(name)) for name, flag in PRODUCTS.items()]))
    listed = rows.select(
        F.explode(lacking).alias("product"), "client_id", "company_name", "csm_owner", "segment_ipc", "total_score",
        "health_status", "mrr", "days_to_renewal")
    return listed.orderBy(*opportunity_order()) if ordered else listed
