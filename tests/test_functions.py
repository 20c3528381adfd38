import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starload.functions import (
    decimal_comma,
    dimension_text,
    iso_week,
    month_start,
    na_token_to_null,
    nan_to_null,
    season_of_month,
    strip_text,
    to_double,
    to_int_key,
)
from starload.functions.patterns import NA_TOKENS
from tests.conftest import plan_text


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("1,5", 1.5),
        (" 01 ", 1.0),
        ("1.234,5", None),
        ("", None),
        ("nan", None),
        ("x", None),
        ("0x10", None),
        ("1_000", None),
        ("1d", None),
        ("2020.0", 2020.0),
        ("1e3", 1000.0),
        ("5.", 5.0),
        (".5", 0.5),
        ("+1", 1.0),
        ("1e400", None),
        ("١٢", None),
    ],
)
def test_tolerant_double(spark, text, expected):
    assert one(spark, to_double(decimal_comma("v")), text) == expected


def test_infinity_literal(spark):
    assert one(spark, to_double(decimal_comma("v")), "inf") == math.inf
    assert one(spark, to_double("v"), "-Infinity") == -math.inf


@pytest.mark.parametrize("text,expected", [(" 01 ", 1), ("2020.0", 2020), ("1e3", 1000), ("", None), ("x", None), (None, None)])
def test_int_key(spark, text, expected):
    assert one(spark, to_int_key("v"), text) == expected


@pytest.mark.parametrize("text", ["1,5", "inf", "2020.5"])
def test_int_key_rejects_fraction_and_infinity(spark, text):
    with pytest.raises(PySparkException):
        one(spark, to_int_key(decimal_comma("v")), text)


@pytest.mark.parametrize("text", [" A ", "A", "\tA", "A\r\n", " A"])
def test_strip_all_white_space(spark, text):
    assert one(spark, strip_text("v"), text) == "A"


@pytest.mark.parametrize("text", [None, "", "  ", "\t", "NaN", "nan", "NAN", " nan "])
def test_dimension_text_rejects(spark, text):
    assert one(spark, dimension_text("v"), text) is None


def test_na_tokens(spark):
    df = spark.createDataFrame([(t,) for t in NA_TOKENS] + [("A",), (" NA",)], "v string")
    out = [r["r"] for r in df.select(na_token_to_null("v").alias("r")).collect()]
    assert out == [None] * len(NA_TOKENS) + ["A", " NA"]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    assert [r["r"] for r in df.select(nan_to_null("v").alias("r")).collect()] == [None, 1.0, None]


@pytest.mark.parametrize(
    "m,season",
    [(12, "Winter"), (1, "Winter"), (2, "Winter"), (3, "Frühling"), (5, "Frühling"), (6, "Sommer"), (8, "Sommer"), (9, "Herbst"), (11, "Herbst")],
)
def test_season(spark, m, season):
    assert one(spark, season_of_month("v"), m, "int") == season


@pytest.mark.parametrize("y,m,date,week", [(2021, 1, dt.date(2021, 1, 1), 53), (2023, 12, dt.date(2023, 12, 1), 48)])
def test_month_start_and_iso_week(spark, y, m, date, week):
    df = spark.createDataFrame([(y, m)], "y int, m int").select(month_start("y", "m").alias("d"))
    r = df.select("d", iso_week("d").alias("w")).first()
    assert r["d"] == date and r["w"] == week


def test_month_13_is_an_error(spark):
    df = spark.createDataFrame([(2021, 13)], "y int, m int")
    with pytest.raises(PySparkException):
        df.select(month_start("y", "m")).collect()


def test_no_python_in_expressions(spark):
    df = spark.createDataFrame([("1,5", 3)], "v string, m int")
    plan = df.select(to_double(decimal_comma("v")), to_int_key("v"), season_of_month("m"), dimension_text("v"))
    text = plan_text(plan)
    assert "EvalPython" not in text and "PythonUDF" not in text and F is not None


def test_errors_do_not_depend_on_ansi_mode(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        from starload.functions import parse_date

        with pytest.raises(PySparkException):
            one(spark, parse_date("v"), "2023-13-45")
        with pytest.raises(PySparkException):
            one(spark, month_start(F.lit(2021), "v"), 13, "int")
        with pytest.raises(PySparkException):
            one(spark, to_int_key("v"), "3e9")
        assert one(spark, parse_date("v"), None) is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
