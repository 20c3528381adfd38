from starload.plans.marts import warehouse_flat_view
from starload.plans.refresh import load_processed, refresh, transform_daily, transform_weather, weather_globs
from starload.streaming.file_trigger import refresh_on_arrival
from tests.conftest import rows
from tests.test_sources import DAILY, write


def landing(tmp_path):
    write(str(tmp_path / "raw" / "daily" / "series.tsv"), DAILY)
    for folder, code, vals in (("air_temperature_mean", "tm", ("-1,5", "2,0")), ("precipitation", "rr", ("50", "60")),
                               ("sunshine_duration", "sd", ("40", "70"))):
        for m, v in zip((1, 2), vals):
            write(str(tmp_path / "raw" / "series" / folder / f"regional_averages_{code}_{m:02d}.txt"),
                  f"preamble\nJahr;Monat;Deutschland;\n2023;{m:02d};{v};\n")
    return str(tmp_path / "raw" / "daily"), weather_globs(str(tmp_path / "raw" / "series"))


EXPECTED = [(2023, 1, "S1", 3.0, -1.5, 50.0), (2023, 2, "S1", None, 2.0, 60.0)]


def test_csv_handover_equals_direct_refresh(spark, tmp_path):
    daily, globs = landing(tmp_path)
    proc = tmp_path / "processed"
    transform_daily(spark, daily, str(proc / "monthly_facts"))
    transform_weather(spark, globs, str(proc / "monthly_weather"))
    r1 = load_processed(spark, str(proc / "monthly_facts"), str(proc / "monthly_weather"), str(tmp_path / "wh1"))
    r2 = refresh(spark, daily, globs, str(tmp_path / "wh2"))
    assert r1.report == r2.report
    from starload.sources.warehouse import Warehouse

    for root in ("wh1", "wh2"):
        flat = warehouse_flat_view(Warehouse(spark, str(tmp_path / root)), register=False)
        assert rows(flat, "year", "month", "syndrome", "relative_cases", "temperature_mean", "precipitation") == EXPECTED


def test_refresh_on_arrival_runs_once_per_new_files(spark, tmp_path):
    daily, globs = landing(tmp_path)
    ck = str(tmp_path / "stream-ck")
    first = refresh_on_arrival(spark, daily, globs, str(tmp_path / "wh"), checkpoint=ck)
    assert [r["version"] for r in first] == [1]
    assert refresh_on_arrival(spark, daily, globs, str(tmp_path / "wh"), checkpoint=ck) == []
    write(str(tmp_path / "raw" / "daily" / "more.tsv"), DAILY.replace("2023-", "2024-"))
    third = refresh_on_arrival(spark, daily, globs, str(tmp_path / "wh"), checkpoint=ck)
    assert [r["version"] for r in third] == [2]


def test_command_line(spark, tmp_path, capsys):
    import json

    from starload.__main__ import main

    daily, _ = landing(tmp_path)
    series_root = str(tmp_path / "raw" / "series")
    main(["refresh", "--daily", daily, "--series", series_root, "--warehouse", str(tmp_path / "wh")])
    out = capsys.readouterr().out.strip().splitlines()[-1]
    assert json.loads(out)["version"] == 1 and json.loads(out)["facts_upserted"] == 2
    main(["report", "--warehouse", str(tmp_path / "wh"), "--out", str(tmp_path / "report")])
    text = capsys.readouterr().out
    assert '"version": 1' in text
    assert [json.loads(x)["table"] for x in text.splitlines() if '"table"' in x] == [
        "seasonality", "class_precipitation", "class_temperature_mean", "class_sunshine_duration",
    ]
    assert "Winter" in "".join(p.read_text() for p in (tmp_path / "report" / "seasonality").glob("*.csv"))
    main(["transform", "--daily", daily, "--series", series_root, "--processed", str(tmp_path / "proc")])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["weather"] == {"n_rows": 2, "min_year": 2023, "max_year": 2023}
    assert [r["month"] for r in out["first_months"]] == [1, 2]


def test_report_writes_every_row(spark, tmp_path):
    from starload.__main__ import main
    from starload.plans.load import load_frames
    from starload.sources.warehouse import Warehouse
    from tests.test_load import monthly, weather

    many = [(2023, m, f"S{i:03d}", "00+", "all", 1.0) for i in range(60) for m in (1, 4, 7, 10)]
    load_frames(spark, Warehouse(spark, str(tmp_path / "wh")), monthly(spark, many), weather(spark, []))
    main(["report", "--warehouse", str(tmp_path / "wh"), "--out", str(tmp_path / "report")])
    assert spark.read.option("header", True).csv(str(tmp_path / "report" / "seasonality")).count() == 240


def test_written_order(spark, tmp_path):
    """Handed-over files are in month order, and the facts in key order (O1, O3)."""
    daily, globs = landing(tmp_path)
    write(str(tmp_path / "raw" / "daily" / "more.tsv"), DAILY.replace("2023-", "2021-").replace("S1", "A0"))
    transform_daily(spark, daily, str(tmp_path / "m"))
    transform_weather(spark, globs, str(tmp_path / "w"))

    def written(folder, n):
        lines = [x for p in sorted((tmp_path / folder).glob("part-*.csv")) for x in p.read_text().splitlines() if not x.startswith("year")]
        return [tuple(x.split(",")[:n]) for x in lines]

    assert written("w", 2) == [("2023", "1"), ("2023", "2")]
    assert written("m", 3) == [("2021", "1", "A0"), ("2021", "2", "A0"), ("2023", "1", "S1"), ("2023", "2", "S1")]
