from datetime import date, datetime

from pyspark.sql import functions as F

from clientpulse.operators import activity, upsell
from tests.conftest import as_dict, as_set

CALLS = ("call_id string, hubspot_company_id string, csm_owner string, call_date date, duration_minutes bigint, "
         "call_type string")
CLIENTS = "hubspot_company_id string, csm_owner string, has_cs boolean, company_name string, client_id string"


def test_weekly_calls_owner_and_window(rows):
    calls = rows([("1", "H1", "ana", date(2024, 1, 1), 10, "consultoria"), ("2", "H1", None, date(2024, 1, 7), 5, "urgencia"),
                  ("3", "H2", "ana", date(2024, 1, 3), None, "other"), ("4", "H9", None, date(2024, 1, 3), 9, "urgencia"),
                  ("5", "H1", "ana", date(2023, 12, 31), 9, "urgencia")], CALLS)
    # Two clients share a company id: calls must not be counted twice.
    clients = rows([("H1", "bia", True, "A", "1"), ("H1", "bia", True, "A2", "2"), ("H2", "bia", True, "B", "3")], CLIENTS)
    got = activity.weekly_calls(calls, clients, date(2024, 1, 1), date(2024, 1, 31))
    assert as_set(got, "csm_owner", "week_start", "calls_total", "calls_consultoria", "calls_urgencia",
                  "unique_clients_contacted", "total_duration_minutes") == {
        ("ana", date(2024, 1, 1), 2, 1, 0, 2, 10), ("bia", date(2024, 1, 1), 1, 0, 1, 1, 5)}


def owners(rows):
    return rows([("1", "Ana", "Lima", "Ana@corp"), ("2", "Ana", "Dois", "ana@corp"), ("3", "Bia", None, None)],
                "id string, firstname string, lastname string, email string")


def test_activity_full_join(rows, spark):
    meetings = rows([("m1", "ANA@corp", datetime(2024, 1, 2), 30), ("m1", "ana@corp", datetime(2024, 1, 2), 30),
                     ("m2", "zed@corp", datetime(2024, 1, 9), None), ("m3", None, datetime(2024, 1, 9), 10),
                     ("m4", "ana@corp", None, 10)],
                    "id string, organizer string, start_date timestamp_ntz, meeting_duration_minutes bigint")
    calls = spark.sql("""SELECT id, named_struct('hs_timestamp', t, 'hs_call_duration', d, 'hubspot_owner_id', o) AS properties
        FROM VALUES ('c1', '2024-01-03T09:00:00Z', '90000', '1'), ('c2', '2024-01-04T09:00:00Z', '45000', '2'),
                    ('c3', 'bad', '60000', '1'), ('c4', '2024-01-10T00:00:00Z', 'x', '1'), ('c5', '2024-01-10T00:00:00Z', '1', '9'),
                    ('c6', '2024-01-10T00:00:00Z', '1', '3') v(id, t, d, o)""")
    got = activity.weekly_activity(meetings, calls, owners(rows))
    assert as_set(got, "csm_owner", "csm_email", "week_start", "meetings_total", "calls_total", "activities_total",
                  "total_duration_minutes") == {
        ("Ana Lima", "ana@corp", date(2024, 1, 1), 1, 2, 3, 62), ("zed@corp", "zed@corp", date(2024, 1, 8), 1, 0, 1, 0),
        ("Ana Lima", "ana@corp", date(2024, 1, 8), 0, 1, 1, 0)}


def test_activity_table_sums_owner_weeks(rows):
    weekly = rows([("a", "2024-01-01", "3", "2", "x"), ("a", "2024-01-01", "1", None, "10.0"), (None, "2024-01-01", "1", "1", "1")],
                  "csm_owner string, week_start string, calls_total string, meetings_total string, total_duration_minutes string")
    got = activity.activity_table(weekly).first()
    assert (got["calls_total"], got["unique_clients_contacted"], got["total_duration_minutes"], got["calls_urgencia"]) == (
        4, 2, 10, 0)


def test_coverage_from_calls_keeps_empty_months(rows):
    clients = rows([("H1", "ana", True, "A", "1"), ("H2", "ana", True, "B", "2"), ("H3", "ana", False, "C", "3"),
                    ("H4", None, True, "D", "4"), ("H5", "bia", True, "E", "5")], CLIENTS)
    calls = rows([("1", "H1", "ana", date(2024, 2, 1), 1, "x"), ("2", "H1", "ana", date(2024, 2, 9), 1, "x"),
                  ("3", "H2", "bia", date(2024, 2, 9), 1, "x"), ("4", "H3", "ana", date(2024, 3, 31), 1, "x")], CALLS)
    got = activity.coverage_from_calls(clients, calls, date(2024, 2, 1), date(2024, 3, 31))
    assert as_set(got, "csm_owner", "year_month", "clients_with_cs_contacted", "coverage_with_cs_pct",
                  "clients_without_cs_contacted", "coverage_without_cs_pct") == {
        ("ana", "2024-02", 1, 50.0, 0, 0.0), ("ana", "2024-03", 0, 0.0, 1, 100.0),
        ("bia", "2024-02", 0, 0.0, 0, 0.0), ("bia", "2024-03", 0, 0.0, 0, 0.0)}


def test_coverage_from_meetings(rows, spark):
    meetings = spark.sql("""SELECT id, organizer, CAST(s AS TIMESTAMP_NTZ) AS start_date, summary, attendees FROM VALUES
        ('1', 'Ana@corp', '2024-01-02', 'Ana <>  Loja A ', array('ana@corp', 'x@loja')),
        ('2', 'ana@corp', '2024-01-03', 'Ana <> LOJA A', array('x@loja')),
        ('3', 'ana@corp', '2024-01-03', 'Ana <> Loja B', array('ana@corp', 'bob@CORP')),
        ('4', 'ana@corp', '2024-01-03', 'sync', array('x@loja')),
        ('5', 'ana@corp', '2024-01-04', 'Ana <> Loja C', CAST(NULL AS ARRAY<STRING>)),
        ('6', 'ana@corp', '2024-01-04', 'Ana <> Loja C', array('', NULL)),
        ('7', 'ana@corp', '2024-01-05', 'Ana <> Loja Z', array('y@z')) t(id, organizer, s, summary, attendees)""")
    granular = activity.coverage_granular(meetings, owners(rows), "corp")
    assert as_set(granular, "csm_owner", "client_name_slug", "meetings_count") == {
        ("Ana Lima", "loja a", 2), ("Ana Lima", "loja z", 1)}
    first = activity.coverage_granular(meetings, owners(rows), "corp", part=1)
    assert as_set(first, "client_name_slug", "meetings_count") == {("ana", 3)}
    clients = rows([("H1", "Ana Lima", False, " Loja A", "1"), ("H2", "Ana Lima", False, "loja a", "2")], CLIENTS)
    table = activity.coverage_table(granular, clients).first().asDict()
    # The unknown client counts as one with CS although the owner has none: nothing to divide by.
    assert (table["clients_with_cs_contacted"], table["clients_without_cs_contacted"]) == (1, 1)
    assert (table["coverage_with_cs_pct"], table["coverage_without_cs_pct"]) == (0.0, 50.0)


def test_targets_and_recent_weeks(rows):
    weeks = [date.fromordinal(date(2024, 1, 1).toordinal() + 7 * n) for n in range(14)]
    table = rows([("a", w, n + 7) for n, w in enumerate(weeks)] + [("b", weeks[0], 13), ("c", weeks[3], 14)],
                 "csm_owner string, week_start date, calls_total bigint")
    cover = rows([("a", "2024-01", 3), ("a", "2024-02", 2)], "csm_owner string, year_month string, sqls_identified int")
    got = activity.target_tracking(table, cover)
    assert as_set(got, "csm_owner", "calls_total", "calls_band", "sqls_identified", "sqls_band") == {
        ("a", 20, "green", 2, "red"), ("b", 13, "red", 0, "red"), ("c", 14, "yellow", 0, "red")}
    recent = activity.recent_weeks(table)
    assert recent.where("csm_owner = 'a'").count() == 12 and recent.where("csm_owner = 'b'").count() == 1


def test_upsell_count_is_false_flags(rows):
    data = [("a", True, False, False, True, False, False, True), ("b", *[False] * 7), ("c", *[None] * 7), ("d", *[True] * 7)]
    frame = rows(data, "client_id string, " + ", ".join(f"{f} boolean" for f in upsell.FLAGS))
    got = as_dict(frame.withColumn("n", upsell.missing_products()), "client_id", "n")
    assert got == {"a": 4, "b": 7, "c": 7, "d": 0}


def test_adoption_of_unscored_clients(rows):
    health = rows([("a", "A", 12, "yellow", 3, 0, True, None, True), ("b", "B", None, None, None, None, None, None, None)],
                  "client_id string, company_name string, total_score int, health_status string, "
                  "integration_automations bigint, active_automations bigint, has_chat_flow boolean, "
                  "has_ai_enabled boolean, cashback_enabled boolean").withColumns(
        {"csm_owner": F.lit("x"), "segment_ipc": F.lit("s"), "mrr": F.lit(1.0), "days_to_renewal": F.lit(9)})
    channels = rows([("a", True, False)], "client_id string, has_sms boolean, has_email boolean")
    base = upsell.product_base(health, channels)
    got = {r["product"]: (r["has_product"], r["lacks_product"], r["adoption_pct"])
           for r in upsell.product_adoption(base).collect()}
    assert got["SMS"] == (1, 1, 50.0) and got["Email"] == (0, 2, 0.0)
    assert got["Automacao de Integracao 2+"] == (1, 1, 50.0) and got["Automacao de Campanhas"] == (0, 2, 0.0)
    assert upsell.product_opportunities(base, status="yellow").count() == 3
    assert upsell.product_opportunities(base).count() == 10


def test_blank_owner_falls_back_to_the_client_owner(rows):
    calls = rows([("1", "H1", "", date(2024, 1, 2), 10, "follow_up"), ("2", "H1", " ", date(2024, 1, 3), 10, "follow_up"),
                  ("3", "H2", "", date(2024, 1, 3), 10, "follow_up")], CALLS)
    clients = rows([("H1", "ana", True, "A", "a"), ("H2", "", True, "B", "b")], CLIENTS)
    got = activity.weekly_calls(calls, clients, date(2024, 1, 1), date(2024, 1, 31))
    assert as_set(got, "csm_owner", "calls_total") == {("ana", 2)}
    cover = activity.coverage_from_calls(clients, calls, date(2024, 1, 1), date(2024, 1, 31))
    assert as_set(cover, "csm_owner", "clients_with_cs_contacted") == {("ana", 0)}


def test_rows_without_owner_leave_the_coverage_table(rows):
    granular = rows([("ana", "2024-01", "a"), (None, "2024-01", "b")], "csm_owner string, year_month string, client_name_slug string")
    clients = rows([("H1", "ana", True, "A", "a")], CLIENTS)
    assert as_set(activity.coverage_table(granular, clients), "csm_owner") == {("ana",)}


def test_weeks_that_are_no_date_and_owners_of_white_space(rows):
    from clientpulse.operators import activity
    weekly = rows([("ana", "2026-04-13", "3"), ("ana", "", "2"), ("ana", "nan", "5"), ("ana", None, "1"), (None, "2026-04-13", "9")],
                  "csm_owner string, week_start string, calls_total string")
    got = {(r["csm_owner"], r["week_start"], r["calls_total"]) for r in activity.activity_table(weekly).collect()}
    assert got == {("ana", date(2026, 4, 13), 3), ("ana", None, 8)}
    owners = rows([("\t",), ("\u00a0 ",), (" ana\n",), (None,)], "csm_owner string").select(activity.owner_of_row().alias("o"))
    assert [r["o"] for r in owners.collect()] == [None, None, "ana", None]
