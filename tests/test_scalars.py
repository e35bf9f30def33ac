import math
from datetime import date, datetime

import numpy as np
from pyspark.sql import functions as F

from clientpulse import functions as fn


def one(rows, value, kind, expression):
    return rows([(value,)], f"v {kind}").select(expression(F.col("v")).alias("x")).first()["x"]


def test_safe_numbers(rows):
    cases = {"": (0.0, 0), None: (0.0, 0), "abc": (0.0, 0), "12.9": (12.9, 12), "-3.9": (-3.9, -3), " 7 ": (7.0, 7),
             "0": (0.0, 0), "1e3": (1000.0, 1000), "5d": (0.0, 0), ".5": (0.5, 0)}
    for text, (as_float, as_int) in cases.items():
        assert one(rows, text, "string", fn.safe_float) == as_float, text
        assert one(rows, text, "string", fn.safe_int) == as_int, text


def test_truthy(rows):
    for text, expected in {"true": True, "TRUE": True, "1": True, "0": False, "": False, "yes": False, None: False}.items():
        assert one(rows, text, "string", fn.truthy) is expected, text
    assert one(rows, 1, "int", fn.truthy) is True
    assert one(rows, True, "boolean", fn.truthy) is True
    assert one(rows, None, "boolean", fn.truthy) is False


def test_iso_timestamp_keeps_clock_fields(rows):
    cases = {"2024-05-06T10:00:00-03:00": datetime(2024, 5, 6, 10), "2024-05-06T10:00:00Z": datetime(2024, 5, 6, 10),
             "2024-05-06": datetime(2024, 5, 6), "2024-05-06T10:00:00.250Z": datetime(2024, 5, 6, 10, 0, 0, 250000),
             "": None, "bad": None, None: None, "2024-13-01": None}
    for text, expected in cases.items():
        assert one(rows, text, "string", fn.iso_timestamp) == expected, text


def test_epoch_or_iso_date(rows):
    cases = {"1700000000000": date(2023, 11, 14), "2023-11-14T23:59:59Z": date(2023, 11, 14), "x": None, "": None,
             None: None, "99999999999999999999": None, "Tuesday": None}
    for text, expected in cases.items():
        assert one(rows, text, "string", fn.epoch_or_iso_date) == expected, text


def test_elapsed_days_round_down_and_calendar_days_do_not(rows):
    df = rows([(datetime(2026, 4, 1, 10),), (datetime(2026, 4, 8, 10),)], "sent_at timestamp_ntz").select(
        fn.elapsed_days(date(2026, 4, 8), "sent_at").alias("e"),
        fn.days_between(F.lit(date(2026, 4, 8)), "sent_at").alias("c"))
    assert [tuple(r) for r in df.collect()] == [(6, 7), (-1, 0)]


def test_add_year_from_leap_day(rows):
    assert one(rows, date(2024, 2, 29), "date", fn.add_years) == date(2025, 2, 28)


def test_week_starts_on_monday(rows):
    assert one(rows, date(2024, 1, 7), "date", fn.week_start) == date(2024, 1, 1)
    assert one(rows, date(2024, 1, 8), "date", fn.week_start) == date(2024, 1, 8)


def test_rounding_modes(rows):
    assert one(rows, 0.125, "double", fn.round_half_up) == 0.13
    assert one(rows, 0.125, "double", fn.round_half_even) == 0.12
    for value in (0.125, 0.375, 2.675, 6.165, 8.325, 1234567.885, -2.5, -0.001, 1e15 + 0.3):
        assert one(rows, value, "double", fn.round_exact) == round(value, 2), value
        assert one(rows, value, "double", fn.round_half_even) == float(np.round(value, 2)), value
    assert one(rows, None, "double", fn.round_exact) is None


def test_ratio_guards(rows):
    df = rows([(5, 2), (5, 0), (5, -1), (5, None), (None, 2)], "n bigint, d bigint")
    assert [r[0] for r in df.select(fn.ratio("n", "d")).collect()] == [2.5, None, None, None, None]
    assert [r[0] for r in df.select(fn.percent("n", "d", missing=0.0)).collect()][:4] == [250.0, 0.0, 0.0, 0.0]
    assert [r[0] for r in df.select(fn.change_percent("n", "d")).collect()][:2] == [150.0, None]


def test_names_and_slugs(rows):
    df = rows([("Ana", "Lima"), ("Ana", None), (None, "Lima"), (None, None), ("", "")], "a string, b string")
    assert [r[0] for r in df.select(fn.person_name("a", "b")).collect()] == ["Ana Lima", "Ana", "Lima", None, None]
    assert [r[0] for r in df.select(fn.person_name("a", "b", blank_as_null=False)).collect()][3:] == ["", ""]
    assert one(rows, " \t Loja X\n", "string", fn.slug) == "loja x"


def test_search_is_a_pattern_unless_literal(rows):
    df = rows([("Loja (A)",), ("LOJA B",), (None,)], "n string")
    assert [r[0] for r in df.select(fn.matches_ci("n", "loja.*b$")).collect()] == [False, True, False]
    assert [r[0] for r in df.select(fn.matches_ci("n", "(a)", literal=True)).collect()] == [True, False, False]


def test_item_count_of_null_is_zero(spark):
    df = spark.sql("SELECT * FROM VALUES (array('a', 'b')), (NULL), (array()) t(x)")
    assert [r[0] for r in df.select(fn.item_count("x")).collect()] == [2, 0, 0]


def test_texts(rows):
    assert one(rows, 1234567.5, "double", fn.money_text) == "R$ 1,234,567.50"
    assert one(rows, None, "double", fn.money_text) == "R$ 0.00"
    assert one(rows, 41.6, "double", fn.percent_text) == "42%"
    assert not math.isnan(one(rows, 1.0, "double", fn.round_half_up))
