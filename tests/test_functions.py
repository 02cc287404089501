import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapmart.functions import dates, labels, numbers, text


def values(spark, cells, expr, kind="string"):
    """Result of one expression over a list of cells, in order."""
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {kind}")
    return [r["x"] for r in df.select("i", expr(F.col("c")).alias("x")).orderBy("i").collect()]


def test_parse_number(spark):
    cells = ["12f", "12d", "0x10", "1,000", "1_000", "-", "nan", None, "", " 12 ", " 12\t", "1e3", "1E3", "+5", "-5.5", ".5", "5."]
    got = values(spark, cells, numbers.parse_number)
    assert got == [None] * 9 + [12.0, 12.0, 1000.0, 1000.0, 5.0, -5.5, 0.5, 5.0]
    assert values(spark, ["inf", "-Infinity"], numbers.parse_number) == [math.inf, -math.inf]


def test_round_half_even(spark):
    got = values(spark, [0.125, -0.125, 2.675, 1.005, 0.375, None], numbers.round_half_even, "double")
    assert got == [0.12, -0.12, 2.68, 1.0, 0.38, None]


def test_cap_keeps_null(spark):
    assert values(spark, [1.0, 9.0, None], lambda c: numbers.cap_at(c, F.lit(5.0)), "double") == [1.0, 5.0, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=2, max_size=60))
def test_order_key_is_monotone_and_nested(spark, cells):
    cells = sorted(cells + [0.0, -0.0, 1.0, 2.0, 0.1, 5e-324, 1e308, -1e308, math.inf, -math.inf])
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c double")
    rows = df.select("i", *[numbers.order_key(F.col("c"), b).alias(f"k{b}") for b in (10, 16, 20)]).orderBy("i").collect()
    for b in (10, 16, 20):
        keys = [r[f"k{b}"] for r in rows]
        assert keys == sorted(keys)
    assert len({r["k20"]: r["k10"] for r in rows}) == len({(r["k20"], r["k10"]) for r in rows})


def test_score_key_is_monotone(spark):
    cells = sorted([0.0, 1e-300, 1e-12, 0.1, 0.3, 0.49999999999999994, 0.5, 0.5000000000000001, 0.7, 1 - 1e-12, 1.0])
    keys = values(spark, cells, lambda c: numbers.score_key(c, 16), "double")
    assert keys == sorted(keys) and len(set(keys)) >= 9


def test_strip_is_unicode_aware(spark):
    assert values(spark, [" a b\t", " 　x\x1f", "", None], text.strip_text) == ["a b", "x", "", None]


def test_missing_tokens(spark):
    bad = ["Unknown", " unk ", "NA", "n/a", "N / A", "null", "None", "nan", "-", "—", " – ", "", None, " "]
    good = ["x", "unknown person", "n.a", "--", "na na", "0", "a/n"]
    assert values(spark, bad, text.is_missing_token) == [True] * len(bad)
    assert values(spark, good, text.is_missing_token) == [False] * len(good)
    for cells, expected in ((bad, True), (good, False)):
        df = spark.createDataFrame([(i, "x", c, "y") for i, c in enumerate(cells)], "i int, a string, c string, b string")
        got = df.select(text.any_missing_token([F.col("a"), F.col("c"), F.col("b")]).alias("x")).collect()
        assert [r["x"] for r in got] == [expected] * len(cells)


def test_yes_no_text(spark):
    assert values(spark, ["Yes。，", "1.0", " NO . ", "a \t b"], text.yes_no_text) == ["yes", "1", "no ", "a b"]


def test_income_text(spark):
    assert values(spark, ["1t0-150K", "6z—100k", ">15mk"], text.income_text) == ["150-150k", "60-100k", ">150k"]


def test_headers():
    assert text.clean_header("﻿ customer  ID ") == "customer ID"


@pytest.mark.parametrize("cell,expected", [("Yes", 1), (" t ", 1), ("1", 1), ("0.7", 1), ("0.2", 0), ("n", 0), ("2", 1),
                                           ("maybe", None), (None, None), ("nan", None)])
def test_binary_label(spark, cell, expected):
    assert values(spark, [cell], labels.map_binary_label) == [expected]


def test_dates(spark):
    cells = ["2024-05-01", "2024/05/01", "1/6/2024", "2024-02-30", "not a date", None]
    got = [d and d.isoformat() for d in values(spark, cells, dates.parse_date)]
    assert got == ["2024-05-01", None, None, None, None, None]
    slash = [d and d.isoformat() for d in values(spark, cells[:3], lambda c: dates.parse_date(c, "yyyy/MM/dd"))]
    assert slash == [None, "2024-05-01", None]
    assert dates.date_format_of("1/6/2024") == "M/d/yyyy" and dates.date_format_of("x") is None
    names = ["gold_2024_05_01.csv", "gold_2024_13_01.csv", "other.csv"]
    assert [d and d.isoformat() for d in values(spark, names, dates.date_from_name)] == ["2024-05-01", None, None]
    assert values(spark, ["2024-05-01"], lambda c: dates.weekday_number(c.cast("date"))) == [2]
    assert values(spark, ["2024-05-01"], lambda c: dates.quarter_number(c.cast("date"))) == [2]
