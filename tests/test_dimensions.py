from datetime import date, datetime

from pyspark.sql import functions as F

from clientpulse.operators import dimensions
from tests.conftest import as_dict, as_set

AS_OF = date(2026, 4, 8)


def test_local_dimension(rows):
    companies = rows([("H1", "A", date(2026, 1, 1), date(2026, 5, 8), "1"), ("H2", "B", None, None, "2"),
                      ("H3", "C", None, None, None), ("H4", "D", None, None, "4")],
                     "hubspot_company_id string, company_name string, contract_start_date date, "
                     "contract_end_date date, client_id string").withColumns(
        {"segment_ipc": F.lit("s"), "csm_owner": F.lit("x"), "has_cs": F.lit(True), "mrr": F.lit(1.0)})
    config = rows([("1", "p"), ("2", "p"), ("3", "p")], "client_id string, plan_type string").withColumns(
        {"cashback_enabled": F.lit(True), "onboarding_completed": F.lit(True)})
    got = dimensions.client_dimension(companies, config, AS_OF)
    assert as_set(got, "client_id", "days_as_client", "days_to_renewal") == {("1", 97, 30), ("2", None, None)}


def test_latest_activity_prefers_dated_rows(rows):
    data = [(1, datetime(2026, 1, 1), "old"), (1, datetime(2026, 2, 1), "new"), (1, None, "undated"), (2, None, "only")]
    got = dimensions.latest_activity(rows(data, "id bigint, created_at timestamp_ntz, v string"))
    assert as_set(got, "id", "v") == {(1, "new"), (2, "only")}


def test_blank_owner_falls_through(rows):
    owners = rows([("1", None, None), ("2", "Ana", "Lima")], "id string, firstname string, lastname string").withColumn(
        "email", F.lit("a@b"))
    clients = rows([("a", "1", "2", None), ("b", None, None, "9"), ("c", None, "2", "1")],
                   "client_id string, cs string, cx string, crm string")
    named = dimensions.with_owner(clients, dimensions.owner_directory(owners), ["cs", "cx", "crm"])
    assert as_set(named, "client_id", "csm_owner", "csm_owner_id") == {
        ("a", "Ana Lima", "1"), ("b", None, "9"), ("c", "Ana Lima", "2")}
    literal = dimensions.with_owner(clients, dimensions.owner_directory(owners, blank_as_null=False), ["cs", "cx", "crm"])
    assert as_dict(literal, "client_id", "csm_owner")["a"] == ""


def test_duplicate_app_names_and_emails_do_not_multiply(rows, spark):
    owners = rows([("2", "B", "B", "X@corp"), ("1", "A", "A", "x@corp")],
                  "id string, firstname string, lastname string, email string")
    assert as_set(dimensions.owners_by_email(owners), "csm_email", "owner_id") == {("x@corp", "1")}
    crm = spark.sql("""SELECT id, named_struct('gupshupapp', app, 'name', id, 'mrr_fixo', mrr, 'cs_responsavel', '1',
        'cx_responsavel', CAST(NULL AS STRING), 'hubspot_owner_id', '2', 'createdate', '', 'closedate', close,
        'data_do_churn', '', 'valor_do_churn', 'x', 'lifecyclestage', 'c', 'onboarding_start_date', '',
        'onboarding_end_date', '', 'motivo_de_churn', '', 'razao_do_churn', '', 'consultoria_estrategica_contratada', '',
        'data_da_ultima_reuniao_cs', '', 'hs_csm_sentiment', '', 'faturamento_mensal_estimado', '') AS properties
        FROM VALUES ('H1', 'app1', '10.5', '2024-02-29T10:00:00Z'), ('H2', 'app1', '99', 'bad'),
                    ('H3', NULL, '7', '') t(id, app, mrr, close)""")
    apps = rows([(1, "One", "app1"), (2, "Two", None)], "id bigint, name string, gupshup_app_name string").withColumns(
        {"business_sector": F.lit("b"), "is_active": F.lit(True)})
    activity = rows([(1, datetime(2026, 1, 1), True), (1, datetime(2026, 1, 2), False)],
                    "id bigint, created_at timestamp_ntz, has_customer_service boolean")
    got = dimensions.warehouse_client_dimension(apps, activity, crm, owners, date(2025, 2, 1))
    assert as_set(got, "client_id", "hubspot_company_id", "mrr", "csm_owner", "has_customer_service",
                  "days_to_renewal") == {(1, "H1", 10.5, "A A", False, 27), (2, None, None, None, None, None)}


def test_active_clients_read_textual_nulls(rows):
    data = [("a", None), ("b", ""), ("c", "nan"), ("d", "2025-01-01"), ("e", "None"), ("f", "NaT"), ("g", " ")]
    got = dimensions.active_clients(rows(data, "client_id string, churn_date string"))
    assert {c for (c,) in as_set(got, "client_id")} == {"a", "b", "c", "e", "f", "g"}


def objects(spark, names, data, company=None):
    columns = ", ".join(f"'{n}', c{k}" for k, n in enumerate(names))
    values = ", ".join("(" + ", ".join("CAST(NULL AS STRING)" if v is None else f"'{v}'" for v in row) + ")" for row in data)
    heads = ", ".join(["id"] + [f"c{k}" for k in range(len(names))])
    return spark.sql(f"SELECT id, named_struct({columns}) AS properties, CAST(NULL AS STRING) AS company_id "
                     f"FROM VALUES {values} t({heads})")


def test_call_units(spark):
    names = ["hs_call_duration", "hs_timestamp", "hubspot_owner_id", "call_type", "hs_call_body"]
    data = [("1", "60", "2024-01-01T00:00:00Z", "7", None, "x" * 600), ("2", "61", None, None, "urgencia", None),
            ("3", "600", "1704067200000", "", "onboarding", ""), ("4", "bad", "", None, None, None)]
    got = {r["call_id"]: r for r in dimensions.normalise_calls(objects(spark, names, data)).collect()}
    assert [got[k]["duration_minutes"] for k in "1234"] == [60, 1, 10, 0]
    assert [got[k]["call_type"] for k in "1234"] == ["follow_up", "urgencia", "onboarding", "follow_up"]
    assert got["1"]["call_date"] == got["3"]["call_date"] == date(2024, 1, 1) and got["4"]["call_date"] is None
    assert len(got["1"]["notes"]) == 600 and got["2"]["notes"] == ""
    cut = dimensions.normalise_calls(objects(spark, names, data), notes_chars=500)
    assert max(len(r["notes"]) for r in cut.collect()) == 500


def test_deal_fallbacks(spark):
    names = ["amount", "mrr_before", "mrr_after", "deal_type_cs", "dealtype", "closedate", "dealstage"]
    data = [("1", "100", "40", None, None, None, None, None), ("2", "100", None, "", "", "renewal", "x", "won"),
            ("3", None, "5", "8", "upsell", "renewal", None, "")]
    got = {r["deal_id"]: r for r in dimensions.normalise_deals(objects(spark, names, data)).collect()}
    assert [(got[k]["deal_type"], got[k]["mrr_after"], got[k]["mrr_delta"]) for k in "123"] == [
        ("new", 100.0, 60.0), ("renewal", 0.0, 0.0), ("upsell", 8.0, 3.0)]


def test_nps_sources_and_zero(spark):
    feedback = objects(spark, ["hs_rating", "hs_submission_timestamp"], [("1", "10", None), ("2", "0", None),
                                                                         ("3", "", None), ("4", "x", None)])
    contacts = objects(spark, ["nps_score", "nps_date", "associatedcompanyid", "email"],
                       [("5", "8", None, "H", "m"), ("6", "6", None, "H", None)])
    kept = dimensions.normalise_nps(feedback, contacts)
    assert as_set(kept, "response_id", "nps_score", "nps_category") == {("1", 10, "promoter"), ("2", 0, "detractor")}
    assert as_set(dimensions.normalise_nps(feedback, contacts, drop_zero=True), "response_id") == {("1",)}
    silent = feedback.where("id = '3'")
    assert as_set(dimensions.normalise_nps(silent, contacts), "response_id", "nps_category", "contact_email") == {
        ("nps-5", "passive", "m"), ("nps-6", "detractor", "")}
    assert dimensions.normalise_nps(None, contacts).count() == 2
