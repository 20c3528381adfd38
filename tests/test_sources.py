import os

import pytest
from pyspark.errors import PySparkException

from starload.functions import parse_date
from starload.operators.monthly import monthly_aggregate
from starload.sources.csv_io import read_csv_typed
from starload.sources.daily_tsv import read_daily_tsv
from starload.sources.landing import landing_manifest
from starload.sources.paths import inputs_found, required_inputs
from starload.sources.series_files import (
    load_series,
    load_weather,
    read_series_files,
    series_format_problems,
)
from tests.conftest import plan_text, rows

DAILY = (
    "date\tsyndrome\tage_group\ted_type\trelative_cases\trelative_cases_7day_ma\texpected_value\t"
    "expected_lowerbound\texpected_upperbound\ted_count\n"
    "2023-01-01\tS1\t00+\tall\t2.0\tNA\tNA\tNA\tNA\t10\n"
    "2023-01-02\tS1\t00+\tall\t4.0\tNA\t3.0\t1.0\t5.0\t12\n"
    "2023-02-01\tS1\t00+\tall\tNA\tNA\tNA\tNA\tNA\t11\n"
    "2023-02-01\tNA\t00+\tall\t9.0\tNA\tNA\tNA\tNA\t11\n"
)


def write(path, text, newline="\n"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline=newline) as f:
        f.write(text)


def test_daily_tsv_to_monthly(spark, tmp_path):
    p = tmp_path / "daily" / "series.tsv"
    write(str(p), DAILY)
    m = monthly_aggregate(read_daily_tsv(spark, str(p.parent)))
    got = rows(m, "year", "month", "syndrome", "relative_cases_avg", "relative_cases_7day_ma_avg",
               "expected_value_avg", "expected_lowerbound_avg", "expected_upperbound_avg",
               "ed_count_avg", "ed_count_min", "ed_count_max")
    assert got == [
        (2023, 1, "S1", 3.0, None, 3.0, 1.0, 5.0, 11.0, 10.0, 12.0),
        (2023, 2, "S1", None, None, None, None, None, 11.0, 11.0, 11.0),
    ]


def test_daily_bad_date_is_an_error(spark, tmp_path):
    p = tmp_path / "bad" / "series.tsv"
    write(str(p), DAILY.replace("2023-01-02", "2023-13-45"))
    with pytest.raises(PySparkException):
        monthly_aggregate(read_daily_tsv(spark, str(p.parent))).collect()


def test_daily_missing_column(spark, tmp_path):
    p = tmp_path / "cols" / "series.tsv"
    write(str(p), DAILY.replace("ed_count\n", "count\n", 1))
    with pytest.raises(ValueError, match="no column ed_count"):
        read_daily_tsv(spark, str(p.parent))


def test_daily_missing_input(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_daily_tsv(spark, str(tmp_path / "nothing-here"))


TM01 = "some preamble line\nJahr;Monat;Bayern;Deutschland;\n1881;01;-1.5;-5.36;\n1882;01;; 1,32;\n1881;01;0;-9.99;\n"
TM02 = "Jahr;Monat;Deutschland\r\n1881;02;1.0\r\n1882;02;\r\n"


def test_series_files(spark, tmp_path):
    d = tmp_path / "tm"
    write(str(d / "regional_averages_tm_01.txt"), TM01)
    write(str(d / "regional_averages_tm_02.txt"), TM02, newline="")
    s = load_series(spark, str(d / "regional_averages_tm_*.txt"), "temperature_mean")
    assert rows(s, "year", "month", "temperature_mean") == [(1881, 1, -9.99), (1881, 2, 1.0), (1882, 1, 1.32)]


def test_weather_inner_join(spark, tmp_path):
    for code, off in (("tm", 0.0), ("rr", 10.0), ("sd", 100.0)):
        d = tmp_path / code
        write(str(d / f"regional_averages_{code}_01.txt"), f"Jahr;Monat;Deutschland;\n2000;1;{1 + off};\n2001;1;{2 + off};\n")
        if code != "sd":
            write(str(d / f"regional_averages_{code}_02.txt"), f"Jahr;Monat;Deutschland;\n2000;2;{3 + off};\n")
    globs = {
        "temperature_mean": str(tmp_path / "tm" / "*.txt"),
        "precipitation": str(tmp_path / "rr" / "*.txt"),
        "sunshine_duration": str(tmp_path / "sd" / "*.txt"),
    }
    w = load_weather(spark, globs)
    assert rows(w, "year", "month", "temperature_mean", "precipitation", "sunshine_duration") == [
        (2000, 1, 1.0, 11.0, 101.0),
        (2001, 1, 2.0, 12.0, 102.0),
    ]


def test_series_without_header_is_an_error(spark, tmp_path):
    d = tmp_path / "nohdr"
    write(str(d / "regional_averages_tm_03.txt"), "Year;Month;Deutschland\n1881;03;1.0\n")
    with pytest.raises(PySparkException, match="not found"):
        load_series(spark, str(d / "*.txt"), "temperature_mean").collect()
    probs = series_format_problems(read_series_files(spark, str(d / "*.txt")))
    assert [r["problem"] for r in probs.collect()] == ["header not found"]


def test_series_without_region_is_an_error(spark, tmp_path):
    d = tmp_path / "noreg"
    write(str(d / "regional_averages_tm_04.txt"), "Jahr;Monat;Bayern\n1881;04;1.0\n")
    with pytest.raises(PySparkException, match="Deutschland"):
        load_series(spark, str(d / "*.txt"), "temperature_mean").collect()


def test_series_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_series(spark, str(tmp_path / "none" / "*.txt"), "temperature_mean")


def test_landing_manifest(spark, tmp_path):
    d = tmp_path / "land"
    for m in (1, 2, 5):
        write(str(d / f"regional_averages_tm_{m:02d}.txt"), "x" * m)
    out = landing_manifest(spark, {"temperature_mean": str(d / "*.txt"), "precipitation": str(tmp_path / "none" / "*.txt")})
    got = {(r["variable"], r["month"]): (r["n_files"], r["bytes"]) for r in out.collect()}
    assert len(got) == 24
    assert got[("temperature_mean", 5)] == (1, 5)
    assert got[("temperature_mean", 3)] == (0, 0)
    assert got[("precipitation", 1)] == (0, 0)


def test_landing_manifest_reads_no_file_content(spark, tmp_path):
    from tests.conftest import plan_text

    d = tmp_path / "land2"
    write(str(d / "regional_averages_rr_01.txt"), "x")
    out = landing_manifest(spark, {"precipitation": str(d / "*.txt")})
    text = plan_text(out, "simple")
    assert "binaryFile" in text or "BinaryFile" in text
    assert "content" not in text.split("ReadSchema:")[1].split("\n")[0]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 50), st.integers(1, 3), st.floats(-50, 50)),
                min_size=1, max_size=60))
def test_keep_last_matches_file_then_line_order(spark, recs):
    """Keep-last under heavy key repetition equals a sequential scan in (file, line) order."""
    from starload.sources.series_files import keep_last

    uniq = {(f, n): (m, v) for f, n, m, v in recs}  # a (file, line) position holds one row
    df = spark.createDataFrame([(f, n, 2000, m, v) for (f, n), (m, v) in uniq.items()],
                               "file string, n int, year int, month int, value double")
    expect = {}
    for (f, n), (m, v) in sorted(uniq.items()):
        expect[(2000, m)] = v
    got = {(r["year"], r["month"]): r["value"] for r in keep_last(df, ["value"]).collect()}
    assert got == expect


def test_csv_source_tokens_and_types(spark, tmp_path):
    from starload.sources.csv_io import read_csv_typed

    p = tmp_path / "proc" / "part.csv"
    write(str(p), "year,month,name,x\n2020.0,1,A,1.5\n,2,NA,\n2021,3,nan,x\n")
    df = read_csv_typed(spark, str(p.parent), {"year": "int", "month": "int", "name": "string", "x": "double"})
    assert rows(df, "month", "year", "name", "x") == [(1, 2020, "A", 1.5), (2, None, None, None), (3, 2021, None, None)]


def test_daily_files_with_one_header(spark, tmp_path):
    write(str(tmp_path / "d" / "a.tsv"), DAILY)
    write(str(tmp_path / "d" / "b.tsv"), DAILY.replace("S1", "S2"))
    assert {r["syndrome"] for r in read_daily_tsv(spark, str(tmp_path / "d")).collect()} == {"S1", "S2", None}


def test_daily_file_with_another_column_order_raises(spark, tmp_path):
    write(str(tmp_path / "d" / "a.tsv"), DAILY)
    write(str(tmp_path / "d" / "b.tsv"), DAILY.replace("syndrome\tage_group", "age_group\tsyndrome"))
    with pytest.raises(Exception, match="(?s)CSV header does not conform.*CSV file: .*d/[ab].tsv"):
        read_daily_tsv(spark, str(tmp_path / "d")).collect()


def test_surplus_fields_raise_and_missing_ones_are_null(spark, tmp_path):
    write(str(tmp_path / "short" / "a.tsv"), DAILY.replace("\t12\n", "\n"))
    got = rows(read_daily_tsv(spark, str(tmp_path / "short")).where("ed_count is null"), "relative_cases")
    assert got == [(4.0,)]
    write(str(tmp_path / "long" / "a.tsv"), DAILY.replace("\t12\n", "\t12\t13\n"))
    with pytest.raises(PySparkException, match="more than 10 fields in .*a.tsv"):
        read_daily_tsv(spark, str(tmp_path / "long")).select("date").collect()
    write(str(tmp_path / "csv" / "a.csv"), 'a,b\n1,"x,y"\n')
    assert rows(read_csv_typed(spark, str(tmp_path / "csv"), {"a": "int", "b": "string"})) == [(1, "x,y")]
    write(str(tmp_path / "csv2" / "a.csv"), "a,b\n1,x,y\n")
    with pytest.raises(PySparkException, match="more than 2 fields"):
        read_csv_typed(spark, str(tmp_path / "csv2"), {"a": "int", "b": "string"}).collect()


@pytest.mark.parametrize("text", ["2023", "2023-01-02 garbage", "2023-01-02Txx", "2023-1-2", " 2023-01-02"])
def test_loose_dates_raise(spark, text):
    with pytest.raises(PySparkException, match="cannot parse date"):
        spark.createDataFrame([(text,)], "t string").select(parse_date("t")).collect()


def test_series_keep_the_last_file(spark, tmp_path):
    for name, value in (("01", "1,0"), ("02", "2,0")):
        write(str(tmp_path / "s" / f"regional_averages_tm_{name}.txt"), f"x\nJahr;Monat;Deutschland;\n2023;01;{value};\n")
    got = load_series(spark, str(tmp_path / "s" / "regional_averages_tm_*.txt"), "v")
    assert rows(got, "year", "month", "v") == [(2023, 1, 2.0)]


def test_series_lines_end_at_any_line_boundary(spark, tmp_path):
    write(str(tmp_path / "s" / "f.txt"), "x\x0cJahr;Monat;Deutschland;\u20282023;01;1,5;\x852023;02;2,5;\n")
    assert rows(load_series(spark, str(tmp_path / "s" / "*.txt"), "v"), "month", "v") == [(1, 1.5), (2, 2.5)]


def test_inputs_found(spark, tmp_path):
    write(str(tmp_path / "in" / "a.txt"), "1\n2\n")
    write(str(tmp_path / "in" / "b.txt"), "3\n")
    got = inputs_found(spark, {"here": str(tmp_path / "in" / "*.txt"), "gone": str(tmp_path / "no" / "*.txt")})
    assert rows(got, "input", "found", "n_files", "n_lines") == [("gone", False, 0, 0), ("here", True, 2, 3)]


def test_an_empty_file_is_found_without_reading_anything(spark, tmp_path):
    write(str(tmp_path / "in" / "a.txt"), "")
    write(str(tmp_path / "some" / "deep" / "b.txt"), "1\n2\n")
    write(str(tmp_path / "some" / "_hidden" / "c.txt"), "x\n")
    paths = {"empty": str(tmp_path / "in"), "folder": str(tmp_path / "some"), "glob": str(tmp_path / "*" / "*.txt"), "gone": str(tmp_path / "no")}
    got = inputs_found(spark, paths, lines=False)
    assert rows(got, "input", "found", "n_files", "n_bytes") == [("empty", True, 1, 0), ("folder", True, 1, 4), ("glob", True, 1, 0), ("gone", False, 0, 0)]
    assert "Scan" not in plan_text(got, "simple")
    empty = inputs_found(spark, {"empty": paths["empty"], "gone": paths["gone"]})
    assert rows(empty, "input", "found", "n_files", "n_lines") == [("empty", True, 1, 0), ("gone", False, 0, 0)]
    required_inputs(spark, {"empty": paths["empty"]})
    with pytest.raises(FileNotFoundError, match="gone"):
        required_inputs(spark, paths)
