import pytest

from starload.operators.monthly import monthly_aggregate
from starload.operators.quality import (
    ColumnsMissing,
    DataQualityError,
    assert_empty,
    column_coverage,
    columns_checked,
    duplicate_keys,
    not_constant_within,
    null_counts,
    orphan_keys,
    out_of_range,
)
from starload.sources.series_files import parse_series
from tests.conftest import plan_text, rows


def test_wanted_columns(spark):
    df = spark.createDataFrame([(1, 2), (1, None)], "a int, b int")
    assert columns_checked(df, ["a"], "t") is df
    with pytest.raises(ColumnsMissing) as e:
        columns_checked(df, ["d", "a", "c"], "t")
    assert (e.value.source, e.value.missing, e.value.found) == ("t", ["c", "d"], ["a", "b"])
    assert isinstance(e.value, DataQualityError)
    got = rows(column_coverage(df, ["a", "b", "c"]), "column_name", "present", "n_rows", "n_values")
    assert got == [("a", True, 2, 2), ("b", True, 2, 1), ("c", False, 2, 0)]


def test_duplicates_orphans_nulls_ranges(spark):
    fact = spark.createDataFrame([(1, 5.0), (1, 101.0), (2, None), (3, -1.0)], "k int, pct double")
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(duplicate_keys(fact, ["k"])) == [(1, 2)]
    assert rows(orphan_keys(fact, "k", dim), "k") == [(3,)]
    assert null_counts(fact).first().asDict() == {"n_rows": 4, "k": 0, "pct": 1}
    assert out_of_range(fact, ["pct"]).first()["pct"] == 2
    with pytest.raises(DataQualityError, match="dup"):
        assert_empty(duplicate_keys(fact, ["k"]), "dup")
    assert_empty(duplicate_keys(dim, ["k"]), "dup")


def test_month_constant_counts_null_as_a_value(spark):
    df = spark.createDataFrame(
        [(2023, 1, 1.0, None), (2023, 1, 1.0, None), (2023, 2, 1.0, None), (2023, 2, 1.0, 2.0)],
        "year int, month int, t double, p double",
    )
    assert rows(not_constant_within(df, ["year", "month"], ["t", "p"])) == [(2023, 2, 2)]


def test_monthly_aggregate_plan_is_partial_and_jvm_only(spark):
    daily = spark.createDataFrame(
        [("2023-01-01", "S", "A", "x", 1.0, None, None, None, None, 2.0)],
        "date string, syndrome string, age_group string, ed_type string, relative_cases double, "
        "relative_cases_7day_ma double, expected_value double, expected_lowerbound double, "
        "expected_upperbound double, ed_count double",
    )
    text = plan_text(monthly_aggregate(daily), "simple")
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1
    assert "EvalPython" not in text


def test_series_parse_is_narrow(spark):
    files = spark.createDataFrame([("f1", "Jahr;Monat;Deutschland\n2000;1;1,5\n")], "file string, text string")
    p = parse_series(files, "v")
    assert "Exchange" not in plan_text(p, "simple")
    assert rows(p, "year", "month", "v") == [(2000, 1, 1.5)]


def test_star_checks_counts_each_rule(spark):
    from starload.operators.quality import star_checks

    fact = spark.createDataFrame(
        [(1, 1, 50.0), (1, 1, 150.0), (2, 9, 10.0), (None, 1, -1.0)], "a_key long, b_key long, pct double"
    )
    dim_a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "a_key long, a string")
    dim_b = spark.createDataFrame([(1, "p"), (3, "p")], "b_key long, b string")
    out = star_checks(fact, {"A": (dim_a, "a_key", ("a",)), "B": (dim_b, "b_key", ("b",))}, ("a_key", "b_key"), ("pct",))
    got = {(r["rule"], r["subject"]): r["violations"] for r in out.collect()}
    assert got == {
        ("unique", "A.a_key"): 1,
        ("unique", "A.a"): 1,
        ("unique", "B.b_key"): 0,
        ("unique", "B.b"): 1,
        ("unique", "fact.a_key+b_key"): 1,
        ("foreign_key", "A.a_key"): 0,
        ("foreign_key", "B.b_key"): 1,
        ("not_null", "fact.a_key"): 1,
        ("not_null", "fact.b_key"): 0,
        ("percent_range", "fact.pct"): 2,
    }
