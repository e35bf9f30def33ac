"""Scoring and alert rules as data, and their compilation into column expressions.

A rule is a Spark SQL condition over feature columns plus its points (or alert texts). Rules of one criterion are
tried in order; a NULL condition counts as not met.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    condition: str
    points: int
    label: str = ""


@dataclass(frozen=True)
class Band:
    status: str
    min_score: int
    max_score: int | None = None
    label: str = ""


@dataclass(frozen=True)
class AlertRule:
    id: str
    name: str
    condition: str
    severity: str
    action: str
    metric: str | None = None


@dataclass(frozen=True)
class Profile:
    """One score variant: ladders per score column, bands, and the status below all bands.

    ``rounded`` names feature columns stored with fewer decimals than they are scored on.
    """
    name: str
    criteria: Mapping[str, Sequence[Rule]]
    bands: Sequence[Band]
    below: str = "red"
    bonus: Mapping[str, Sequence[Rule]] = field(default_factory=dict)
    rounded: Mapping[str, int] = field(default_factory=dict)


# ---------------------------------------------------------------------------------------------
# Thresholds, points, labels and texts of the four score variants and the alert sets.
# ---------------------------------------------------------------------------------------------

_RECENCY = (
    Rule("days_since_last_campaign <= 7", 5, "Ativa (ultimos 7 dias)"),
    Rule("days_since_last_campaign <= 20", 3, "Moderada (8-20 dias)"),
    Rule("days_since_last_campaign > 20 OR no_campaigns", 0, "Inativa (>20 dias)"),
)
_ROI = (Rule("campaign_roi >= 10", 5), Rule("campaign_roi >= 1", 3))
_AUTOMATIONS = (
    Rule("active_automations >= 3", 5, "Completo (3+)"),
    Rule("active_automations >= 1", 3, "Basico (1-2)"),
    Rule("active_automations == 0", 0, "Nenhuma"),
)
_INTEGRATIONS_BY_AUTOMATION = (
    Rule("integration_automations >= 4", 5),
    Rule("integration_automations == 3", 4),
    Rule("integration_automations >= 1", 2),
)
_INTEGRATIONS_BY_LIST = (
    Rule("active_integrations >= 2", 5, "Multi-integracao (2+)"),
    Rule("active_integrations == 1", 3, "Basico (1)"),
    Rule("active_integrations == 0", 0, "Nenhuma"),
)
_CHAT_BY_LEVEL = (Rule("chat_usage_level == 'advanced'", 5), Rule("chat_usage_level == 'essential'", 4))
_CHAT_BY_FLAGS = (
    Rule("has_human_agent AND (has_chat_flow OR has_ai)", 5, "Avancado/Hibrido"),
    Rule("has_human_agent OR has_chat_flow", 4, "Essencial"),
    Rule("no_chat_usage", 0, "Nao utiliza"),
)
_VOLUME_BY_CHANGE = (
    Rule("messages_mom_change > 0 OR plan_usage_pct >= 80", 5),
    Rule("messages_mom_change >= -10", 3),
)
_VOLUME_WIDE_STABLE = (
    Rule("messages_mom_change > 10 OR plan_usage_pct >= 80", 5),
    Rule("messages_mom_change BETWEEN -10 AND 10", 3),
)
_VOLUME_BY_TREND = (
    Rule("volume_trend == 'growing' OR plan_usage_pct >= 80", 5, "Alto/Crescente"),
    Rule("volume_trend == 'stable'", 3, "Estavel"),
    Rule("volume_trend == 'declining' OR plan_usage_pct < 20", 0, "Queda/Irrelevante"),
)
_COVERAGE = (
    Rule("coverage_pct >= 15", 5, "Alta cobertura (>=15%)"),
    Rule("coverage_pct >= 5", 3, "Moderada (5-14%)"),
    Rule("coverage_pct < 5 OR no_customers", 0, "Baixa (<5%)"),
)
_BANDS_V1_1 = (
    Band("green", 19, 30, "Campeao"),
    Band("yellow", 11, 18, "Alerta"),
    Band("red", 4, 10, "Em Risco"),
    Band("inactive", 0, 3, "Inativo"),
)
_BANDS_V1 = (Band("green", 26), Band("yellow", 16))

WAREHOUSE_V1_1 = Profile(
    "warehouse_v1_1",
    {"score_recency": _RECENCY, "score_automations": _AUTOMATIONS, "score_integrations": _INTEGRATIONS_BY_LIST,
     "score_chat": _CHAT_BY_FLAGS, "score_volume": _VOLUME_BY_TREND, "score_coverage": _COVERAGE},
    _BANDS_V1_1, below="inactive")
SQL_V1 = Profile(
    "sql_v1",
    {"score_recency": _RECENCY, "score_roi": _ROI, "score_automations": _AUTOMATIONS,
     "score_integrations": _INTEGRATIONS_BY_AUTOMATION, "score_chat": _CHAT_BY_LEVEL,
     "score_volume": _VOLUME_BY_CHANGE},
    _BANDS_V1, bonus={"bonus_cashback": (Rule("cashback_enabled", 2),)})
PANDAS_V1 = Profile(
    "pandas_v1", {**SQL_V1.criteria, "score_volume": _VOLUME_WIDE_STABLE}, _BANDS_V1_1[:2],
    bonus={"bonus_cashback": (Rule("false", 0),)}, rounded={"messages_mom_change": 2, "plan_usage_pct": 2})
ASOF_BACKFILL = Profile(
    "asof_backfill", SQL_V1.criteria, _BANDS_V1, bonus={"bonus_cashback": (Rule("cashback_enabled", 5),)})

PROFILES = {p.name: p for p in (WAREHOUSE_V1_1, SQL_V1, PANDAS_V1, ASOF_BACKFILL)}

STATUS_LABELS = {b.status: b.label for b in _BANDS_V1_1}

RULE_FILE_ALERTS = (
    AlertRule("score_dropped_to_red", "Score caiu para Vermelho",
              "health_status == 'red' AND previous_status != 'red'", "critical",
              "Criar task urgente para o CSM"),
    AlertRule("no_campaign_14d", "Sem campanha ha 14+ dias", "days_since_last_campaign >= 14", "warning",
              "Notificar CSM para agendar consultoria"),
    AlertRule("roi_dropped_below_1", "ROI caiu abaixo de 1x", "campaign_roi < 1 AND previous_roi >= 1", "warning",
              "Agendar analise de campanha com cliente"),
    AlertRule("renewal_90d", "Renovacao em 90 dias", "days_to_renewal <= 90", "info",
              "Iniciar processo de reaplicacao SPICE"),
    AlertRule("renewal_30d_red", "Renovacao em 30 dias + Score Vermelho",
              "days_to_renewal <= 30 AND health_status == 'red'", "critical",
              "Escalar para gestao — risco alto de churn"),
    AlertRule("volume_drop_30pct", "Queda de volume >30%", "messages_mom_change <= -30", "warning",
              "Investigar causa e agendar call"),
    AlertRule("low_base_coverage", "Cobertura da base abaixo de 5%",
              "coverage_pct < 5 AND health_status != 'inactive'", "warning",
              "Orientar cliente a ampliar uso de campanhas e automacoes"),
    AlertRule("inactive_client", "Cliente sem atividade (Inativo)",
              "health_status == 'inactive' AND days_to_renewal <= 60", "critical",
              "Acionar CSM para diagnostico — risco de churn silencioso"),
    AlertRule("upsell_opportunity", "Oportunidade de upsell", "health_status == 'green' AND plan_usage_pct >= 90",
              "info", "Qualificar como SQL de expansao"),
)


def _changed(rules: Sequence[AlertRule], **changes: dict) -> tuple[AlertRule, ...]:
    """The rules named in ``changes``, in their order, with some fields replaced."""
    return tuple(AlertRule(**{**vars(r), **changes[r.id]}) for r in rules if r.id in changes)


SCRIPT_ALERTS = _changed(
    RULE_FILE_ALERTS,
    score_dropped_to_red={"condition": "health_status == 'red' AND coalesce(previous_status != 'red', true)"},
    no_campaign_14d={}, renewal_90d={"condition": "days_to_renewal BETWEEN 31 AND 90"}, renewal_30d_red={},
    volume_drop_30pct={},
    low_base_coverage={"condition": "health_status != 'inactive' AND coalesce(coverage_pct < 5, true)"},
    inactive_client={}, upsell_opportunity={})

WAREHOUSE_ALERTS = _changed(
    RULE_FILE_ALERTS,
    no_campaign_14d={"condition": "days_since_last_campaign >= 14 AND days_since_last_campaign < 9999",
                     "metric": "cast(days_since_last_campaign AS string)"},
    renewal_90d={"condition": "days_to_renewal BETWEEN 31 AND 90", "metric": "cast(days_to_renewal AS string)"},
    renewal_30d_red={"condition": "days_to_renewal BETWEEN 0 AND 30 AND health_status == 'red'",
                     "action": "Escalar para gestao - risco alto de churn",
                     "metric": "cast(days_to_renewal AS string)"},
    volume_drop_30pct={"metric": "cast(cast(messages_mom_change AS decimal(10,2)) AS string)"},
    low_base_coverage={"condition": "coalesce(coverage_pct, 0) < 5 AND health_status != 'inactive'",
                       "metric": "cast(cast(coalesce(coverage_pct, 0) AS decimal(10,2)) AS string)"},
    inactive_client={"metric": "cast(days_to_renewal AS string)"},
    upsell_opportunity={"metric": "cast(cast(plan_usage_pct AS decimal(10,2)) AS string)"},
) + (AlertRule("score_red", "Score em Vermelho", "health_status == 'red'", "critical",
               "Criar task urgente para o CSM", "cast(total_score AS string)"),)

SQL_V1_ALERTS = (
    AlertRule("score_dropped_to_red", "Health score dropped to red",
              "health_status = 'red' AND coalesce(previous_status != 'red', true)", "critical",
              "Schedule urgent CSM call; review campaign recency, automations and volume"),
    AlertRule("no_campaign_14d", "No campaign sent in the last 14 days", "days_since_last_campaign >= 14", "high",
              "Contact client to plan next campaign; check if they need creative support"),
    AlertRule("roi_dropped_below_1", "Campaign ROI dropped below 1x", "campaign_roi < 1", "high",
              "Review campaign targeting, segmentation and offer strategy with client"),
    AlertRule("renewal_90d", "Contract renewal within 90 days", "days_to_renewal <= 90", "medium",
              "Initiate renewal conversation; present usage report and expansion opportunities"),
    AlertRule("renewal_30d_red", "Renewal in 30 days with red health status — churn risk",
              "days_to_renewal <= 30 AND health_status = 'red'", "critical",
              "Escalate to CS lead; prepare retention offer and executive outreach"),
    AlertRule("volume_drop_30pct", "Message volume dropped 30% or more vs previous month",
              "messages_mom_change <= -30", "high",
              "Investigate cause of volume drop; check platform issues, campaign pause or low engagement"),
    AlertRule("upsell_opportunity", "Upsell opportunity: green health + plan usage >= 90%",
              "health_status = 'green' AND plan_usage_pct >= 90", "low",
              "Present plan upgrade or expanded features; schedule strategic growth call"),
)

ALERT_SETS = {"script": SCRIPT_ALERTS, "sql_v1": SQL_V1_ALERTS, "warehouse": WAREHOUSE_ALERTS,
              "rule_file": RULE_FILE_ALERTS}

# Score column of each criterion section of a rules file.
RULE_FILE_SECTIONS = {
    "recency": "score_recency", "roi": "score_roi", "automations": "score_automations",
    "integrations": "score_integrations", "chat_usage": "score_chat", "message_volume": "score_volume",
    "base_coverage": "score_coverage",
}


# ---------------------------------------------------------------------------------------------


def profile_from_rules(document: Mapping, name: str = "rule_file") -> tuple[Profile, tuple[AlertRule, ...]]:
    """Profile and alert rules out of a parsed rules document (criterion sections, classification, alerts)."""
    criteria = {score: tuple(Rule(r["condition"], int(r["points"]), r.get("label", ""))
                             for r in document[section]["rules"])
                for section, score in RULE_FILE_SECTIONS.items() if section in document}
    bands = sorted((Band(status, int(b["min_score"]), b.get("max_score"), b.get("label", ""))
                    for status, b in document["classification"].items()), key=lambda b: -b.min_score)
    alerts = tuple(AlertRule(a["id"], a["name"], a["condition"], a["severity"], a["action"])
                   for a in document.get("alerts", ()))
    return Profile(name, criteria, tuple(bands), below=bands[-1].status), alerts


def load_rules(path: str, name: str = "rule_file") -> tuple[Profile, tuple[AlertRule, ...]]:
    """Rules from a YAML or JSON file on the driver; the file holds rules, not data."""
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith(".json"):
        import json
        return profile_from_rules(json.loads(text), name)
    try:
        import yaml
    except ImportError as error:
        raise ImportError("reading a YAML rules file needs PyYAML; use JSON instead") from error
    return profile_from_rules(yaml.safe_load(text), name)


# What the feature profiles store for a client without any campaign, instead of a number of days.
NO_CAMPAIGN_DAYS = (999, 9999)


def rule_features(df: DataFrame) -> DataFrame:
    """Add the derived names that rule conditions may use."""
    columns = set(df.columns)

    def known(name: str, kind: str) -> Column:
        return F.col(name) if name in columns else F.lit(None).cast(kind)

    change = known("messages_mom_change", "double")
    level = known("chat_usage_level", "string")
    return df.withColumns({
        "no_campaigns": F.coalesce(known("days_since_last_campaign", "int").isin(*NO_CAMPAIGN_DAYS), F.lit(True)),
        "no_chat_usage": F.coalesce(level == "none", F.lit(True)),
        "no_customers": known("coverage_pct", "double").isNull(),
        "volume_trend": F.when(change > 0, "growing").when(change >= -10, "stable").when(change < -10, "declining"),
        "active_integrations": known("active_integrations_count", "int"),
        "has_ai": known("has_ai_enabled", "boolean"),
        **{c: known(c, "boolean") for c in ("has_human_agent", "has_chat_flow") if c not in columns}})


RULE_FEATURES = ("no_campaigns", "no_chat_usage", "no_customers", "volume_trend", "active_integrations", "has_ai")


def compile_points(rules: Sequence[Rule]) -> Column:
    """Points of the first rule met, 0 when none is."""
    out = None
    for rule in rules:
        condition = F.expr(rule.condition)
        out = F.when(condition, rule.points) if out is None else out.when(condition, rule.points)
    return out.otherwise(0)


def compile_labels(rules: Sequence[Rule]) -> Column:
    """Label of the first rule met."""
    out = None
    for rule in rules:
        condition = F.expr(rule.condition)
        out = F.when(condition, rule.label) if out is None else out.when(condition, rule.label)
    return out


def compile_bands(score: Column, bands: Sequence[Band], below: str) -> Column:
    out = None
    for b in bands:
        out = F.when(score >= b.min_score, b.status) if out is None else out.when(score >= b.min_score, b.status)
    return out.otherwise(below)
