"""Projections of the given Parquet tables onto the library's input schemas (see FIXTURES.md)."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientpulse.operators import alerts, backfill, dimensions, features, rules, scoring, upsell
from clientpulse.sources.readers import scan

AS_OF = date(2001, 7, 20)
CURRENT, PREVIOUS = "2001-07", "2001-06"
BACKFILL = (date(2001, 1, 1), date(2001, 6, 30))
CALL_WINDOW = (date(2024, 1, 1), date(2024, 6, 30))
CRM_AS_OF = date(2025, 3, 10)
DOMAIN = "corp.example"


def squeezed(day: Column) -> Column:
    """80 order months pressed into the six before August 2001."""
    end = F.lit(date(2001, 8, 1))
    return F.date_sub(end, F.floor(F.date_diff(end, day.cast("date")) / 16).cast("int"))


def elsewhere(key: Column, condition: Column, name: str = "client_id") -> Column:
    """The key, negative where the row is to belong to no client."""
    return F.when(condition, -key).otherwise(key).alias(name)


def text_of(c: Column) -> Column:
    return c.cast("string")


class Inputs:
    """Lazy input frames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str, *columns: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = scan(self.spark, f"{self.dir}/{name}.parquet")
        return self._tables[name].select(*columns)

    @cached_property
    def clients(self) -> DataFrame:
        k = F.col("c_custkey")
        start = F.date_sub(F.lit(AS_OF), (180 + (k * 37) % 361).cast("int"))
        base = self.table("customer", "c_custkey", "c_name", "c_mktsegment", "c_acctbal").select(
            k.alias("client_id"), F.concat(F.lit("HS-"), text_of(k)).alias("hubspot_company_id"),
            F.concat(F.lit("app"), text_of(k)).alias("gupshup_app_name"), F.col("c_name").alias("company_name"),
            F.col("c_mktsegment").alias("segment_ipc"),
            F.when(k % 13 != 0, F.concat(F.lit("csm_"), text_of(k % 7))).alias("csm_owner"),
            (k % 2 == 0).alias("has_cs"), start.alias("contract_start_date"),
            F.date_add(start, 365).alias("contract_end_date"), F.greatest("c_acctbal", F.lit(0.0)).alias("mrr"),
            F.when(k % 3 == 0, "Starter").when(k % 3 == 1, "Growth").otherwise("Enterprise").alias("plan_type"),
            (k % 5 == 0).alias("cashback_enabled"), (k % 6 != 0).alias("onboarding_completed"))
        return base.withColumns({
            "days_as_client": F.date_diff(F.lit(AS_OF), "contract_start_date"),
            "days_to_renewal": F.date_diff("contract_end_date", F.lit(AS_OF))})

    @cached_property
    def companies(self) -> DataFrame:
        """Companies, some without a product id."""
        return self.clients.select(
            "hubspot_company_id", "company_name", "segment_ipc", "csm_owner", "has_cs", "contract_start_date",
            F.when(F.col("client_id") % 10 != 9, F.col("contract_end_date")).alias("contract_end_date"), "mrr",
            F.when(F.col("client_id") % 31 != 0, F.col("client_id")).alias("client_id"))

    @cached_property
    def client_config(self) -> DataFrame:
        """Configurations; those of some clients carry a key that no client has."""
        k = F.col("client_id")
        return self.clients.select(elsewhere(k, k % 29 == 0), "plan_type", "cashback_enabled", "onboarding_completed")

    @cached_property
    def campaigns(self) -> DataFrame:
        o, c = F.col("o_orderkey"), F.col("o_custkey")
        base = F.floor(F.col("o_totalprice") / 100).cast("double") / 100
        factor = F.when(c % 4 == 0, 0.5).when(c % 4 == 1, 4.0).otherwise(12.0)
        kind = (F.when((F.col("o_orderpriority") == "3-MEDIUM") & (c % 3 == 0), "sms")
                 .when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (c % 4 == 0), "email")
                 .otherwise("whatsapp"))
        sent = F.timestamp_add("HOUR", (8 + o % 11).cast("int"),
                               squeezed(F.col("o_orderdate")).cast("timestamp_ntz"))
        return self.table("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                          "o_orderpriority").select(
            o.alias("campaign_id"), F.when(c % 17 == 0, c + 1).otherwise(c).alias("client_id"), sent.alias("sent_at"),
            (base * factor).alias("revenue_attributed"),
            F.when(o % 29 == 0, 0.0).otherwise(base).alias("cost"), kind.alias("campaign_type"))

    @cached_property
    def automations(self) -> DataFrame:
        o = F.col("o_orderkey")
        return self.table("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate").select(
            o.alias("automation_id"), F.col("o_custkey").alias("client_id"),
            F.when(o % 31 == 0, F.lit(None)).when(o % 2 == 0, "integration").otherwise("standard").alias(
                "automation_type"),
            F.when(F.floor(o / 2) % 2 == 1, "draft").when(F.col("o_orderstatus") == "O", "paused").otherwise(
                "active").alias("status"),
            squeezed(F.col("o_orderdate")).cast("timestamp_ntz").alias("created_at"))

    @cached_property
    def messages(self) -> DataFrame:
        orders = self.table("orders", "o_orderkey", "o_custkey", "o_orderdate").select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("client_id"),
            F.date_format(squeezed(F.col("o_orderdate")), "yyyy-MM").alias("year_month"))
        lines = self.table("lineitem", "l_orderkey", "l_quantity").groupBy("l_orderkey").agg(
            F.sum("l_quantity").alias("quantity"))
        k = F.col("client_id")
        return lines.join(orders, "l_orderkey").groupBy("client_id", "year_month").agg(
            F.sum("quantity").cast("bigint").alias("messages_sent")).withColumn(
            "plan_limit", F.when(k % 3 == 0, 150).when(k % 3 == 1, 300).otherwise(600).cast("bigint"))

    @cached_property
    def chat(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer", "c_custkey").select(
            elsewhere(k, k % 23 == 0), (k % 3 != 0).alias("has_human_agent"), (k % 5 == 1).alias("has_chat_flow"),
            (k % 4 == 3).alias("has_ai_enabled"))

    # --- warehouse sources -------------------------------------------------------------------

    @cached_property
    def app_companies(self) -> DataFrame:
        return self.clients.select(
            F.col("client_id").alias("id"), F.col("company_name").alias("name"), "gupshup_app_name",
            F.lower("segment_ipc").alias("business_sector"), (F.col("client_id") % 8 != 0).alias("is_active"))

    @cached_property
    def activity_summary(self) -> DataFrame:
        """Current rows for every client, and an older differing row for every fifth."""
        k = F.col("client_id")
        two = features.messages_two_months(self.messages, CURRENT, PREVIOUS)
        joined = self.clients.select("client_id", "gupshup_app_name").join(two, "client_id", "left")
        big = F.lit(0).cast("bigint")
        tools = F.when(k % 11 != 0, F.transform(
            F.when(k % 4 == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), (k % 4).cast("int"))),
            lambda x: F.concat(F.lit("tool"), x.cast("string"))))
        older = F.col("older")
        # Both rows of a client come from one pass over the join.
        rows = joined.withColumn("older", F.explode(
            F.when(k % 5 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
        return rows.select(
            k.alias("id"), "gupshup_app_name",
            F.when(older, F.lit(date(2001, 7, 1))).otherwise(F.lit(AS_OF)).cast("timestamp_ntz").alias("created_at"),
            F.when(older, F.lit(False)).otherwise(k % 3 != 0).alias("has_customer_service"),
            F.when(older, 9).when(k % 5 == 1, 1).otherwise(0).cast("bigint").alias("total_active_flows"),
            tools.alias("active_integrations"),
            F.when(older, 1).otherwise(F.col("messages_sent_current")).cast("bigint").alias("total_messages_this_month"),
            F.col("messages_sent_previous").alias("total_messages_prev_month"),
            F.when(k % 3 == 0, 150).when(k % 3 == 1, 300).otherwise(600).cast("bigint").alias(
                "whatsapp_marketing_package_limit"),
            F.when(older, big).otherwise((k * 7) % 300).alias("total_impacted_customers_this_month"),
            F.when(k % 19 == 0, big).otherwise(1000).cast("bigint").alias("total_customers"))

    @cached_property
    def campaign_results(self) -> DataFrame:
        c = F.col("campaign_id")
        return self.campaigns.select(
            F.col("client_id").alias("company_id"), "campaign_id",
            F.when(F.col("cost") > 0, F.col("revenue_attributed") / F.col("cost")).alias("campaign_roi"),
            F.when(c % 37 != 0, F.col("sent_at")).alias("whatsapp_campaign_sent_at"))

    @cached_property
    def automation_summary(self) -> DataFrame:
        kind = F.col("automation_type")
        return self.automations.select(
            F.col("client_id").alias("company_id"), (F.col("status") == "active").alias("automation_is_active"),
            F.when(kind == "standard", "Personalizada").when(kind == "integration", "Integracao").alias(
                "automation_type"))

    @cached_property
    def flows(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer", "c_custkey").select(
            elsewhere(k, ~(k % 5).isin(1, 2), "company_id"), (k % 5 == 1).alias("flow_is_active"))

    @cached_property
    def users(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer", "c_custkey").select(
            elsewhere(k, k % 4 == 2, "company_id"), F.when(k % 4 == 3, F.concat(F.lit("agent-"), text_of(k))).when(
                k % 4 == 1, "").alias("ai_agent_id"))

    @cached_property
    def cashback_configs(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer", "c_custkey").select(
            elsewhere(k, ~(k % 5).isin(0, 3), "company_id"), (k % 5 == 0).alias("is_active"))

    def channel(self, kind: str) -> DataFrame:
        return self.campaigns.where(F.col("campaign_type") == kind).select(F.col("client_id").alias("company_id"))

    @cached_property
    def owners(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self.table("nation", "n_nationkey").select(
            text_of(n).alias("id"),
            F.when(n % 9 != 8, F.concat(F.lit("First"), text_of(n))).alias("firstname"),
            F.when((n % 4 != 3) & (n != 17), F.concat(F.lit("Last"), text_of(n))).alias("lastname"),
            F.concat(F.lit("Owner"), text_of(n), F.lit("@corp.example")).alias("email"))

    @cached_property
    def crm_companies(self) -> DataFrame:
        k = F.col("c_custkey")
        two = F.lpad(text_of(1 + k % 12), 2, "0")
        iso = F.concat(F.lit("20"), text_of(23 + k % 3), F.lit("-"), two, F.lit("-15T03:00:00"),
                       F.when(k % 7 == 0, "-03:00").otherwise("Z"))
        money = F.greatest("c_acctbal", F.lit(0.0)).cast("decimal(12,2)").cast("string")
        props = F.struct(
            F.concat(F.lit("app"), text_of(k)).alias("gupshupapp"), F.col("c_name").alias("name"),
            F.when(k % 10 == 0, "").when(k % 21 == 0, "abc").otherwise(money).alias("mrr_fixo"),
            F.when(k % 3 != 0, text_of(k % 25)).alias("cs_responsavel"),
            F.when(k % 4 != 0, text_of((k + 1) % 25)).alias("cx_responsavel"),
            text_of((k + 2) % 40).alias("hubspot_owner_id"),
            F.concat(F.lit("2022-"), two, F.lit("-01T10:30:00Z")).alias("createdate"),
            F.when(k % 23 == 0, "bad").otherwise(iso).alias("closedate"),
            F.when(k % 9 == 0, F.concat(F.lit("2025-"), two, F.lit("-20"))).alias("data_do_churn"),
            F.when(k % 18 == 0, "500.0").alias("valor_do_churn"),
            F.lit("customer").alias("lifecyclestage"),
            F.concat(F.lit("2023-"), two, F.lit("-02T00:00:00Z")).alias("onboarding_start_date"),
            F.when(k % 6 != 0, F.concat(F.lit("2023-"), two, F.lit("-28T23:30:00-03:00"))).alias(
                "onboarding_end_date"),
            F.when(k % 9 == 0, "preco").alias("motivo_de_churn"), F.lit(None).cast("string").alias("razao_do_churn"),
            F.when(k % 2 == 0, "true").otherwise("false").alias("consultoria_estrategica_contratada"),
            F.when(k % 5 == 0, "").otherwise("2025-01-31T12:00:00Z").alias("data_da_ultima_reuniao_cs"),
            F.lit("neutral").alias("hs_csm_sentiment"),
            F.when(k % 15 == 0, "n/a").otherwise(text_of(k * 10)).alias("faturamento_mensal_estimado"))
        return self.table("customer", "c_custkey", "c_name", "c_acctbal").select(
            F.concat(F.lit("HS-"), text_of(k)).alias("id"), props.alias("properties"))

    # --- account managers --------------------------------------------------------------------

    @cached_property
    def deals(self) -> DataFrame:
        kinds = {"1-URGENT": ("new", 1), "2-HIGH": ("upsell", 1), "3-MEDIUM": ("cross_sell", 1),
                 "4-NOT SPECIFIED": ("downgrade", -1), "5-LOW": ("churn", -1)}
        kind, sign = F.lit(None).cast("string"), F.lit(0)
        for priority, (name, s) in kinds.items():
            kind = F.when(F.col("o_orderpriority") == priority, name).otherwise(kind)
            sign = F.when(F.col("o_orderpriority") == priority, s).otherwise(sign)
        base = F.floor(F.col("o_totalprice") / 100).cast("double") / 100
        closed = F.col("o_orderdate").cast("date")
        # One month without deals: its deals close a month later.
        closed = F.when(F.date_format(closed, "yyyy-MM") == "1997-02", F.add_months(closed, 1)).otherwise(closed)
        return self.table("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                          "o_orderpriority").select(
            F.col("o_orderkey").alias("deal_id"),
            F.concat(F.lit("HS-"), text_of(F.col("o_custkey"))).alias("hubspot_company_id"),
            kind.alias("deal_type"), (base * sign).alias("mrr_delta"), closed.alias("closed_date"))

    @cached_property
    def calls(self) -> DataFrame:
        e, u = F.col("event_id"), F.col("user_id")
        kinds = (F.when(F.col("event_type") == "click", "consultoria").when(F.col("event_type") == "purchase",
                 "onboarding").when(F.col("event_type") == "error", "urgencia").otherwise("follow_up"))
        return self.table("events", "event_id", "ts", "user_id", "event_type").where(
            F.col("event_type") != "signup").select(
            e.alias("call_id"), F.concat(F.lit("HS-"), text_of(u)).alias("hubspot_company_id"),
            F.when(e % 11 != 0, F.concat(F.lit("csm_"), text_of(u % 7))).alias("csm_owner"),
            F.add_months(F.col("ts").cast("date"), (e % 6).cast("int")).alias("call_date"),
            (15 + e % 46).alias("duration_minutes"), kinds.alias("call_type"))

    @cached_property
    def meetings(self) -> DataFrame:
        e, u = F.col("event_id"), F.col("user_id")
        owner = F.concat(F.lit("owner"), text_of(u % 25))
        inside = F.concat(owner, F.lit("@corp.example"))
        outside = F.concat(F.lit("buyer"), text_of(u), F.lit("@client.example"))
        empty = F.array().cast("array<string>")
        people = (F.when(e % 5 == 0, F.array(inside)).when(e % 46 == 0, F.lit(None))
                   .when(e % 23 == 0, empty).otherwise(F.array(inside, outside)))
        summary = F.when(e % 4 == 0, "internal sync").otherwise(
            F.concat(owner, F.lit(" <> Customer#"), F.lpad(text_of(u), 9, "0")))
        return self.table("events", "event_id", "ts", "user_id", "event_type").where(
            F.col("event_type").isin("view", "click")).select(
            e.alias("id"), F.concat(owner, F.lit("@CORP.example")).alias("organizer"),
            F.col("ts").alias("start_date"), summary.alias("summary"), people.alias("attendees"),
            (15 + e % 46).alias("meeting_duration_minutes"))

    @cached_property
    def crm_calls(self) -> DataFrame:
        e = F.col("event_id")
        iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
        props = F.struct(
            F.when(e % 23 == 0, "not a time").when(e % 41 != 0, iso).alias("hs_timestamp"),
            F.when(e % 29 == 0, "x").otherwise(text_of((e % 1000) * 1000 + 500)).alias("hs_call_duration"),
            F.when(e % 17 == 0, "99").otherwise(text_of(F.col("user_id") % 25)).alias("hubspot_owner_id"))
        return self.table("events", "event_id", "ts", "user_id", "event_type").where(
            F.col("event_type").isin("purchase", "error")).select(e.alias("id"), props.alias("properties"))

    @cached_property
    def nps(self) -> DataFrame:
        e = F.col("event_id")
        return self.table("events", "event_id", "ts", "user_id", "event_type").where(
            F.col("event_type") == "signup").select(
            e.alias("response_id"), F.concat(F.lit("HS-"), text_of(F.col("user_id"))).alias("hubspot_company_id"),
            ((e * 7) % 11).cast("int").alias("nps_score"),
            dimensions.nps_category((e * 7) % 11).alias("nps_category"),
            F.col("ts").cast("date").alias("response_date"))

    @cached_property
    def owned_clients(self) -> DataFrame:
        """Clients owned by the named owners of the meetings."""
        n = (F.col("client_id") % 25).cast("string")
        names = dimensions.owner_directory(self.owners).select(
            F.col("owner_id").alias("_n"), F.col("owner_name").alias("csm_owner"))
        return self.clients.drop("csm_owner").withColumn("_n", n).join(names, "_n").drop("_n")

    # --- derived tables ----------------------------------------------------------------------

    def local_scores(self, variant: str) -> DataFrame:
        feats = features.local_features(self.clients, self.campaigns, self.automations, self.chat, self.messages,
                                        AS_OF, CURRENT, PREVIOUS, variant, self.activity_summary)
        return scoring.health_score(feats, rules.PROFILES[variant], AS_OF)

    @cached_property
    def warehouse_features(self) -> DataFrame:
        return features.warehouse_features(self.clients, self.activity_summary, self.campaign_results,
                                           self.automation_summary, self.flows, self.users, self.cashback_configs,
                                           AS_OF)

    @cached_property
    def warehouse_scores(self) -> DataFrame:
        return scoring.health_score(self.warehouse_features, rules.WAREHOUSE_V1_1, AS_OF,
                                    extra=("company_name", "csm_owner", "mrr", "days_to_renewal"))

    @cached_property
    def backfill(self) -> DataFrame:
        return backfill.backfill_scores(self.clients, self.campaigns, self.automations, self.chat, self.messages,
                                        self.clients, *BACKFILL)

    @cached_property
    def history(self) -> DataFrame:
        """Six month ends and the run of today.

        Today's rows are dealt by day and client. Were both parts dealt by client, the union would join them partition
        by partition, and one task would hold the sorts of both runs and of the query that reads the history.
        """
        return self.backfill.unionByName(self.local_scores("sql_v1").repartition("calculated_at", "client_id"))

    @cached_property
    def window_scores(self) -> DataFrame:
        """Warehouse scores of today, one row per analysis window."""
        windows = features.results_by_period(self.campaign_results.withColumnRenamed("company_id", "client_id"), AS_OF)
        return scoring.health_score(features.with_periods(self.warehouse_features, windows), rules.WAREHOUSE_V1_1, AS_OF)

    @cached_property
    def window_history(self) -> DataFrame:
        """The history with a row per analysis window; each window's totals differ by its length."""
        each = F.explode(F.array(*[F.lit(p) for p in features.PERIODS]))
        return self.history.withColumn("period_days", each).withColumn(
            "total_score", F.col("total_score") + F.col("period_days"))

    @cached_property
    def alert_base(self) -> DataFrame:
        return alerts.alert_base(self.history, self.clients)

    @cached_property
    def script_alerts(self) -> DataFrame:
        """Alerts of today's run; those of every fourth client are resolved."""
        fired = alerts.evaluate_alerts(self.alert_base, rules.SCRIPT_ALERTS, AS_OF)
        return fired.withColumn("resolved", F.col("client_id") % 4 == 0)

    @cached_property
    def warehouse_alerts(self) -> DataFrame:
        return alerts.evaluate_alerts(self.warehouse_scores, rules.WAREHOUSE_ALERTS, AS_OF)

    @cached_property
    def upsell_flags(self) -> DataFrame:
        return upsell.upsell_flags(self.clients, self.activity_summary, self.automation_summary,
                                   self.channel("sms"), self.channel("email"), self.users, self.cashback_configs)
