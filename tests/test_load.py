import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starload.operators.keys import assign_keys
from starload.operators.quality import DataQualityError
from starload.plans.load import load, load_frames, prepare_batch
from starload.plans.marts import class_average, seasonality, warehouse_flat_view
from starload.sources.warehouse import CommitConflict, Warehouse
from tests.conftest import plan_text, rows

MONTHLY_SCHEMA = (
    "year int, month int, syndrome string, age_group string, ed_type string, "
    "relative_cases_avg double, relative_cases_7day_ma_avg double, expected_value_avg double, "
    "expected_lowerbound_avg double, expected_upperbound_avg double, ed_count_avg double, "
    "ed_count_min double, ed_count_max double"
)
WEATHER_SCHEMA = "year int, month int, temperature_mean double, precipitation double, sunshine_duration double"


def monthly(spark, recs):
    """recs: (year, month, syndrome, age_group, ed_type, relative_cases)"""
    data = [(y, m, s, a, e, rc, None, 1.0, 0.5, 1.5, 10.0, 9.0, 11.0) for (y, m, s, a, e, rc) in recs]
    return spark.createDataFrame(data, MONTHLY_SCHEMA)


def weather(spark, recs):
    return spark.createDataFrame(recs, WEATHER_SCHEMA)


def facts(wh):
    flat = warehouse_flat_view(wh, register=False)
    return rows(flat, "year", "month", "syndrome", "age_group", "ed_type", "relative_cases", "temperature_mean")


def keys(wh):
    man = wh.manifest()
    out = {}
    for t, (k, v) in {"dim_syndrom": ("syndrom_key", "bezeichnung"), "dim_edtype": ("edtype_key", "typ"),
                      "dim_altersgruppe": ("altersgruppe_key", "altersgruppe")}.items():
        out[t] = sorted((r[v], r[k]) for r in wh.table(t, man).collect())
    out["dim_datum"] = sorted((r["datum"], r["datum_key"], r["saison"], r["woche"]) for r in wh.table("dim_datum", man).collect())
    out["fakt"] = sorted((r["datum_key"], r["syndrom_key"], r["altersgruppe_key"], r["edtype_key"], r["fakt_key"])
                         for r in wh.table("fakt_erkrankungen", man).collect())
    return out


BATCH = [
    (2023, 1, "S1", "00+", "all", 3.0),
    (2023, 1, "S2", "00+", "all", 4.0),
    (2023, 2, "S1", "00+", "all", 5.0),
    (2023, 6, "S1", "15-34", "all", None),
]
WEATHER = [(2023, 1, 1.0, 50.0, 40.0), (2023, 2, 2.0, 60.0, 70.0)]


def test_first_load_and_report(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    res = load_frames(spark, wh, monthly(spark, BATCH), weather(spark, WEATHER))
    assert res.version == 1
    assert res.report == {"n_syndrom": 2, "n_altersgruppe": 2, "n_edtype": 1, "n_datum": 3,
                          "facts_upserted": 4, "rows_skipped": 0}
    assert facts(wh) == sorted([
        (2023, 1, "S1", "00+", "all", 3.0, 1.0),
        (2023, 1, "S2", "00+", "all", 4.0, 1.0),
        (2023, 2, "S1", "00+", "all", 5.0, 2.0),
        (2023, 6, "S1", "15-34", "all", None, None),
    ], key=lambda r: tuple((x is None, x) for x in r))
    k = keys(wh)
    assert k["dim_syndrom"] == [("S1", 1), ("S2", 2)]
    assert [d[2] for d in k["dim_datum"]] == ["Winter", "Winter", "Sommer"]


def test_same_batch_twice_changes_nothing(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_frames(spark, wh, monthly(spark, BATCH), weather(spark, WEATHER))
    f1, k1 = facts(wh), keys(wh)
    res = load_frames(spark, wh, monthly(spark, BATCH), weather(spark, WEATHER))
    assert res.version == 2
    assert facts(wh) == f1 and keys(wh) == k1
    tables = wh.manifest().tables
    assert "/v00000001-" in tables["dim_syndrom"]     # no new value: carried forward, not rewritten
    assert "/v00000002-" in tables["dim_datum"]


def test_null_weather_overwrites_and_absent_rows_stay(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_frames(spark, wh, monthly(spark, BATCH), weather(spark, WEATHER))
    k1 = keys(wh)
    second = [(2023, 1, "S1", "00+", "all", 7.0), (2024, 3, "S3", "00+", "all", 1.0)]
    load_frames(spark, wh, monthly(spark, second), weather(spark, [(2023, 2, 2.0, 60.0, 70.0)]))
    got = facts(wh)
    assert (2023, 1, "S1", "00+", "all", 7.0, None) in got          # batch values win, NULL included
    assert (2023, 1, "S2", "00+", "all", 4.0, 1.0) in got           # absent from batch: stays
    assert (2024, 3, "S3", "00+", "all", 1.0, None) in got          # new grain
    assert len(got) == 5
    k2 = keys(wh)
    assert set(k1["fakt"]) <= set(k2["fakt"])                        # stored keys never change
    assert k2["dim_syndrom"] == [("S1", 1), ("S2", 2), ("S3", 3)]


def test_duplicate_grain_in_batch_is_an_error(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    dup = BATCH + [(2023, 1, " S1", "00+", "all", 9.0)]  # trimmed after grouping: same grain
    with pytest.raises(DataQualityError):
        load_frames(spark, wh, monthly(spark, dup), weather(spark, WEATHER))
    assert wh.current_version() == 0                                 # nothing published


def test_rejected_dimension_value_is_skipped(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    bad = BATCH + [(2023, 1, "nan", "00+", "all", 1.0), (2023, 1, "S1", " ", "all", 1.0)]
    res = load_frames(spark, wh, monthly(spark, bad), weather(spark, WEATHER))
    assert res.report["rows_skipped"] == 2 and res.report["facts_upserted"] == 4
    assert len(facts(wh)) == 4


def test_flat_view_plan_broadcasts_dimensions(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_frames(spark, wh, monthly(spark, BATCH), weather(spark, WEATHER))
    flat = warehouse_flat_view(wh)
    text = plan_text(flat)
    assert plan_text(flat, "simple").count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in text
    assert "EvalPython" not in text
    assert spark.sql("SELECT count(*) AS n FROM vw_erkrankungen_monatlich").first()["n"] == 4
    s = rows(seasonality(flat), "season", "syndrome", "avg_relative_cases")
    assert ("Winter", "S1", 4.0) in s and ("Sommer", "S1", None) in s
    c = rows(class_average(flat, "temperature_mean", (1.5,), ("cold", "warm")), "temperature_mean_class", "syndrome", "avg_relative_cases")
    assert c == [("cold", "S1", 3.0), ("cold", "S2", 4.0), ("warm", "S1", 5.0)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="abcXYZ é", min_size=0, max_size=4), min_size=0, max_size=40, unique=True),
       st.integers(min_value=0, max_value=50))
def test_ranged_keys_equal_window_keys(spark, values, start):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    small = assign_keys(df, ["v"], "k", start=start)
    ranged = assign_keys(df, ["v"], "k", start=start, num_partitions=3)
    expect = [(v, start + i + 1) for i, v in enumerate(sorted(values, key=lambda s: s.encode("utf-8")))]
    assert rows(small, "v", "k") == sorted(expect)
    assert rows(ranged, "v", "k") == sorted(expect)


def test_untouched_years_are_carried_forward(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_frames(spark, wh, monthly(spark, BATCH), weather(spark, WEATHER))
    load_frames(spark, wh, monthly(spark, [(2024, 3, "S3", "00+", "all", 1.0)]), weather(spark, []))
    man = wh.manifest()
    parts = man.partitions("fakt_erkrankungen")
    assert sorted(parts) == ["fakt_erkrankungen/jahr=2023/monat=0", "fakt_erkrankungen/jahr=2024/monat=0"]   # 0: a whole year
    assert "/v00000001-" in parts["fakt_erkrankungen/jahr=2023/monat=0"]
    assert "/v00000002-" in parts["fakt_erkrankungen/jahr=2024/monat=0"]
    assert man.max_key("fakt_erkrankungen") == 5 and man.max_key("dim_syndrom") == 3
    assert len(facts(wh)) == 5


def test_registered_view_equals_dataframe_view(spark, tmp_path):
    from starload.plans.marts import register_star

    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_frames(spark, wh, monthly(spark, BATCH), weather(spark, WEATHER))
    sql_flat = register_star(wh)
    df_flat = warehouse_flat_view(wh, register=False)
    assert sql_flat.columns == df_flat.columns
    assert rows(sql_flat) == rows(df_flat)
    assert spark.sql("SELECT count(*) AS n FROM dim_syndrom").first()["n"] == 2


def test_empty_batch_publishes_a_consistent_version(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_frames(spark, wh, monthly(spark, BATCH), weather(spark, WEATHER))
    res = load_frames(spark, wh, monthly(spark, []), weather(spark, []))
    assert res.version == 2 and res.report["facts_upserted"] == 0 and res.report["rows_skipped"] == 0
    assert len(facts(wh)) == 4                       # nothing lost, old years carried forward
    empty = Warehouse(spark, str(tmp_path / "empty"))
    load_frames(spark, empty, monthly(spark, []), weather(spark, []))
    assert facts(empty) == []


def test_second_load_on_a_file_system_that_is_not_the_default_disk(spark, tmp_path):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    before = hadoop.get("fs.defaultFS")
    hadoop.set("fs.viewfs.mounttable.stars.link./data", f"file://{tmp_path}")
    hadoop.set("fs.defaultFS", "viewfs://stars/")
    try:
        wh = Warehouse(spark, "/data/wh")
        first = load_frames(spark, wh, monthly(spark, BATCH), weather(spark, WEATHER))
        second = load_frames(spark, wh, monthly(spark, [(2024, 3, "S3", "00+", "all", 1.0)]), weather(spark, []))
        assert (first.version, second.version) == (1, 2)
        got = facts(wh)
    finally:
        hadoop.set("fs.defaultFS", before)
    assert len(got) == 5 and {r[0] for r in got} == {2023, 2024}


def test_crash_before_commit_publishes_nothing_and_the_retry_succeeds(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_frames(spark, wh, monthly(spark, BATCH), weather(spark, WEATHER))
    before = facts(wh)
    more = [(2024, 3, "S3", "00+", "all", 1.0)]
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            load_frames(spark, wh, monthly(spark, more), weather(spark, []))
    assert wh.current_version() == 1 and facts(wh) == before
    assert load_frames(spark, wh, monthly(spark, more), weather(spark, [])).version == 2
    assert len(facts(wh)) == 5
    assert len(list((tmp_path / "wh").glob("v00000002-*"))) == 2      # each try has a folder of its own


def test_two_loads_on_one_version_conflict(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    start = wh.manifest()
    batch = prepare_batch(monthly(spark, BATCH), weather(spark, WEATHER))
    load(spark, wh, batch, manifest=start)
    before = facts(wh)
    other = prepare_batch(monthly(spark, [(2023, 1, "S1", "00+", "all", 77.0)]), weather(spark, []))
    with pytest.raises(CommitConflict):
        load(spark, wh, other, manifest=start)
    assert wh.current_version() == 1 and facts(wh) == before


def test_a_load_leaves_no_cache_behind(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    dup = BATCH + [(2023, 1, " S1", "00+", "all", 9.0)]
    with pytest.raises(DataQualityError):
        load_frames(spark, wh, monthly(spark, dup), weather(spark, WEATHER))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept


def test_key_allocation_has_no_single_task_window_over_the_data(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("v"))
    text = plan_text(assign_keys(df, ["v"], "k"), "simple")
    assert "Window" not in text and "Exchange" not in text and "rowcount" not in text   # a scan with arithmetic
