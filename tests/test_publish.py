"""Commit records, the gate before publishing, months, retention and the lasting view."""

import json
import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from starload.operators.keys import assign_keys
from starload.operators.quality import ConstraintViolation, DataQualityError
from starload.plans.catalog_view import publish_view
from starload.plans.load import FACT_TABLE, load, load_frames, prepare_batch
from starload.plans.marts import warehouse_flat_view
from starload.sources.storage import Storage
from starload.sources.warehouse import CommitConflict, Warehouse
from tests.conftest import rows
from tests.test_load import BATCH, WEATHER, facts, keys, monthly, weather

MORE = [(2024, 3, "S3", "00+", "all", 1.0)]


def first(spark, tmp_path, name="wh"):
    wh = Warehouse(spark, str(tmp_path / name))
    load_frames(spark, wh, monthly(spark, BATCH), weather(spark, WEATHER))
    return wh


# ---------------------------------------------------------------- commit record --
def test_a_leftover_folder_of_a_dead_writer_does_not_block(spark, tmp_path):
    (tmp_path / "wh" / "_commits" / "commit-00000001" / "_temporary").mkdir(parents=True)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    assert wh.current_version() == 0
    assert load_frames(spark, wh, monthly(spark, BATCH), weather(spark, WEATHER)).version == 1
    assert wh.current_version() == 1


def test_a_writer_that_dies_in_the_commit_does_not_block(spark, tmp_path, monkeypatch):
    wh = first(spark, tmp_path)
    before = facts(wh)
    with monkeypatch.context() as m:
        m.setattr(Storage, "_linked", lambda *a: (_ for _ in ()).throw(SystemError("killed")))
        m.setattr(Storage, "delete", lambda *a: False)
        with pytest.raises(SystemError):
            load_frames(spark, wh, monthly(spark, MORE), weather(spark, []))
    drafts = [n for n in os.listdir(tmp_path / "wh" / "_commits") if n.startswith(".commit-00000002")]
    assert drafts and wh.current_version() == 1 and facts(wh) == before
    assert load_frames(spark, wh, monthly(spark, MORE), weather(spark, [])).version == 2
    assert len(facts(wh)) == 5


def test_of_many_writers_at_once_one_creates_the_record(spark, tmp_path):
    storage = Storage(spark)
    for k in range(5):
        path = str(tmp_path / "c" / f"commit-{k}.json")
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda i, p=path: storage.put_new(p, f"writer {i}"), range(8)))
        assert won.count(True) == 1 and storage.read(path) == f"writer {won.index(True)}"
    assert sorted(os.listdir(tmp_path / "c")) == [f"commit-{k}.json" for k in range(5)]


def test_a_rename_never_replaces_a_record(spark, tmp_path):
    storage = Storage(spark)
    target = str(tmp_path / "r" / "commit.json")
    for text, want in (("one", True), ("two", False)):
        draft = str(tmp_path / "r" / f".{text}")
        storage.write(draft, text)
        assert storage._renamed(draft, target) is want
    assert storage.read(target) == "one"


def test_a_commit_whose_answer_was_lost_is_recognised(spark, tmp_path, monkeypatch):
    wh = first(spark, tmp_path)
    real = Storage.put_new
    with monkeypatch.context() as m:
        m.setattr(Storage, "put_new", lambda self, p, t: real(self, p, t) and False)
        assert load_frames(spark, wh, monthly(spark, MORE), weather(spark, [])).version == 2
    assert wh.current_version() == 2


def test_the_newest_record_is_found_whatever_the_hint_says(spark, tmp_path):
    wh = first(spark, tmp_path)
    man = wh.manifest()
    wh.commit(wh.attempt(man), {}, man.tables, man.max_keys, man.held, man.hidden)
    hint = f"{wh.root}/_commits/newest"
    for text in ("1", "2", "77", "", "no number"):
        wh.storage.write(hint, text)
        assert wh.current_version() == 2
    wh.storage.delete(hint)
    assert wh.current_version() == 2 and wh.manifest(1).version == 1
    with pytest.raises(KeyError):
        wh.manifest(9)


def test_records_in_folders_are_still_read(spark, tmp_path):
    wh = first(spark, tmp_path)
    before = facts(wh)
    folder = tmp_path / "wh" / "_commits"
    record = json.loads((folder / "commit-00000001.json").read_text())
    (folder / "commit-00000001").mkdir()
    (folder / "commit-00000001" / "part-00000-x.json").write_text(json.dumps({k: record[k] for k in ("version", "tables", "max_keys")}))
    (folder / "commit-00000001.json").unlink()
    (folder / "newest").unlink()
    again = Warehouse(spark, str(tmp_path / "wh"))
    assert again.current_version() == 1 and facts(again) == before
    man = again.manifest()
    assert again.commit(again.attempt(man), {}, man.tables, man.max_keys) == 2 and facts(again) == before


def test_two_writers_on_one_version_conflict_and_the_loser_can_retry(spark, tmp_path):
    wh = first(spark, tmp_path)
    start = wh.manifest()
    batches = [prepare_batch(monthly(spark, [(2024, m, "S3", "00+", "all", 1.0)]), weather(spark, [])) for m in (3, 4)]

    def one(batch):
        try:
            return load(spark, wh, batch, manifest=start).version
        except CommitConflict:
            return None

    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(one, batches))
    assert sorted(done, key=str) == [2, None] and len(facts(wh)) == 5
    assert load(spark, wh, batches[done.index(None)]).version == 3
    assert len(facts(wh)) == 6


# ------------------------------------------------------------------------- gate --
def spoil(wh, name, df):
    """Publish a version with one table replaced, past the load."""
    man = wh.manifest()
    attempt = wh.attempt(man)
    wh.stage(attempt, name, df)
    staged = {name: wh.staged_path(attempt, name)}
    wh.commit(attempt, staged, {k: v for k, v in man.tables.items() if k != name}, man.max_keys, man.held, man.hidden)


def refused(spark, wh, batch):
    version, folders = wh.current_version(), set(os.listdir(wh.root))
    with pytest.raises(ConstraintViolation) as e:
        load_frames(spark, wh, monthly(spark, batch), weather(spark, []))
    assert wh.current_version() == version and set(os.listdir(wh.root)) == folders
    return {(v["rule"], v["subject"]): v["violations"] for v in e.value.violations}


def test_a_doubled_dimension_value_refuses_the_load(spark, tmp_path):
    wh = first(spark, tmp_path)
    dim = wh.table("dim_syndrom")
    spoil(wh, "dim_syndrom", dim.unionByName(dim.filter("bezeichnung = 'S1'").withColumn("syndrom_key", F.lit(50).cast("long"))))
    assert refused(spark, wh, [(2024, 3, "S2", "00+", "all", 1.0)]) == {("unique", "dim_syndrom.bezeichnung"): 1}
    # a batch that joins the doubled value is refused for the dimension, not for its own grain
    assert ("unique", "dim_syndrom.bezeichnung") in refused(spark, wh, [(2024, 3, "S1", "00+", "all", 1.0)])


def test_a_doubled_file_in_a_published_dimension_refuses_the_load(spark, tmp_path):
    wh = first(spark, tmp_path)
    path = wh.manifest().tables["dim_edtype"]
    spark.createDataFrame(spark.read.parquet(path).collect(), "edtype_key long, typ string").write.mode("append").parquet(path)
    assert set(refused(spark, wh, MORE)) == {("unique", "dim_edtype.edtype_key"), ("unique", "dim_edtype.typ")}


def test_a_dangling_key_in_a_touched_month_refuses_the_load(spark, tmp_path):
    wh = first(spark, tmp_path)
    spoil(wh, "dim_syndrom", wh.table("dim_syndrom").filter("bezeichnung <> 'S2'"))
    touched = [(2023, 1, "S1", "00+", "all", 9.0)]
    assert refused(spark, wh, touched) == {("foreign_key", f"{FACT_TABLE}.syndrom_key"): 1}
    # the months of another batch hold no dangling key
    assert load_frames(spark, wh, monthly(spark, [(2023, 2, "S1", "00+", "all", 9.0)]), weather(spark, [])).version == 3


def test_missing_attributes_and_doubled_facts_refuse_the_load(spark, tmp_path):
    wh = first(spark, tmp_path)
    spoil(wh, "dim_datum", wh.table("dim_datum").withColumn("saison", F.lit(None).cast("string")).withColumn("datum", F.when(F.col("monat") > 1, F.col("datum"))))
    assert refused(spark, wh, MORE) == {("not_null", "dim_datum.saison"): 3, ("not_null", "dim_datum.datum"): 1}
    other = first(spark, tmp_path, "other")
    path = next(iter(other.manifest().partitions(FACT_TABLE).values()))
    spark.createDataFrame(spark.read.parquet(path).filter("fakt_key = 1").collect(), spark.read.parquet(path).schema).write.mode("append").parquet(path)
    found = refused(spark, other, [(2023, 1, "S2", "00+", "all", 9.0)])
    assert [k[0] for k in found] == ["unique"] and list(found.values()) == [1]


def test_a_batch_that_breaks_the_grain_publishes_nothing(spark, tmp_path):
    wh = first(spark, tmp_path)
    with pytest.raises(DataQualityError):
        load_frames(spark, wh, monthly(spark, [(2023, 1, "S1 ", "00+", "all", 1.0), (2023, 1, " S1", "00+", "all", 2.0)]), weather(spark, []))
    assert wh.current_version() == 1


# ------------------------------------------------------------------------ months --
def snapshot(root):
    return {p: os.stat(p).st_mtime_ns for base, _, files in os.walk(root) for p in (os.path.join(base, f) for f in files)}


def test_a_month_rewrites_no_other_months_files(spark, tmp_path):
    wh = first(spark, tmp_path)
    files = snapshot(wh.root)
    load_frames(spark, wh, monthly(spark, [(2023, 1, "S1", "00+", "all", 8.0), (2023, 1, "S9", "00+", "all", 2.0)]), weather(spark, []))
    assert {p: t for p, t in snapshot(wh.root).items() if p in files and "newest" not in p} == {p: t for p, t in files.items() if "newest" not in p}
    man = wh.manifest()
    assert {k.split("/", 1)[1]: "/v00000002-" in v for k, v in man.partitions(FACT_TABLE).items()} == {
        "jahr=2023/monat=0": False, "jahr=2023/monat=1": True}
    assert wh.table(FACT_TABLE, man, [f"{FACT_TABLE}/jahr=2023/monat=1"]).count() == 3    # January alone was written
    assert man.hidden == {f"{FACT_TABLE}/jahr=2023/monat=0": [1]} and man.held[f"{FACT_TABLE}/jahr=2023/monat=0"] == [1, 2, 3]
    got = facts(wh)
    assert len(got) == 5 and (2023, 1, "S1", "00+", "all", 8.0, None) in got and (2023, 1, "S2", "00+", "all", 4.0, 1.0) in got
    assert sorted(k[4] for k in keys(wh)["fakt"]) == [1, 2, 3, 4, 5]


def test_months_one_by_one_equal_one_load(spark, tmp_path):
    recs = [(2023, m, s, "00+", "all", float(m)) for m in range(1, 7) for s in ("S1", "S2")]
    again = [(2023, m, "S1", "00+", "all", 10.0 * m) for m in (2, 5)] + [(2023, 5, "S3", "00+", "all", 1.0)]
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for batch in (recs[:6], recs[6:], again):
        load_frames(spark, wh, monthly(spark, batch), weather(spark, []))
    got = {(r[1], r[2]): r[5] for r in facts(wh)}
    assert got == {(m, s): float(m) for _, m, s, *_ in recs} | {(2, "S1"): 20.0, (5, "S1"): 50.0, (5, "S3"): 1.0}
    man = wh.manifest()
    live = [k for e in man.partitions(FACT_TABLE) for k in set(man.held[e]) - set(man.hidden.get(e, ()))]
    assert sorted(live) == [1, 2, 3, 4, 5, 6]                       # each month counts in one folder
    # a batch with every month of the year leaves one folder again, and the same rows
    load_frames(spark, wh, monthly(spark, recs), weather(spark, []))
    assert [k.split("/", 1)[1] for k in wh.manifest().partitions(FACT_TABLE)] == ["jahr=2023/monat=0"] and not wh.manifest().hidden
    assert {(r[1], r[2]): r[5] for r in facts(wh)} == {(m, s): float(m) for _, m, s, *_ in recs} | {(5, "S3"): 1.0}


def test_a_folder_of_which_nothing_is_known_is_written_anew(spark, tmp_path):
    wh = first(spark, tmp_path)
    man = wh.manifest()
    before = facts(wh)
    path = str(tmp_path / "wh" / "v00000002-0123456789ab" / FACT_TABLE / "jahr=2023")
    wh.table(FACT_TABLE, man).coalesce(1).write.parquet(path)
    carried = {k: v for k, v in man.tables.items() if not k.startswith(FACT_TABLE)}
    wh.commit(wh.attempt(man), {f"{FACT_TABLE}/jahr=2023": path}, carried, man.max_keys)
    assert facts(wh) == before
    load_frames(spark, wh, monthly(spark, [(2023, 2, "S1", "00+", "all", 6.0)]), weather(spark, []))
    assert list(wh.manifest().partitions(FACT_TABLE)) == [f"{FACT_TABLE}/jahr=2023/monat=0"]
    got = facts(wh)
    assert len(got) == 4 and (2023, 2, "S1", "00+", "all", 6.0, None) in got
    assert set(before) - set(got) == {(2023, 2, "S1", "00+", "all", 5.0, 2.0)}
    load_frames(spark, wh, monthly(spark, [(2023, 6, "S1", "15-34", "all", 9.0)]), weather(spark, []))
    assert len(facts(wh)) == 4


def jobs_of(spark, work):
    group = f"jobs-{time.time_ns()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = work()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_keys_take_a_sample_and_a_write(spark):
    df = spark.range(500).select(F.format_string("v%04d", "id").alias("v"))
    keyed, n = jobs_of(spark, lambda: assign_keys(df, ["v"], "k", start=7, num_partitions=4))
    assert n <= 3                                      # the sample, and the write with its shuffle
    assert rows(keyed, "v", "k") == [(f"v{i:04d}", 8 + i) for i in range(500)]


def test_keys_stand_when_files_are_bounded(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")
    try:
        keyed = assign_keys(spark.range(100).select(F.format_string("v%03d", "id").alias("v")), ["v"], "k", num_partitions=3)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert rows(keyed, "v", "k") == [(f"v{i:03d}", 1 + i) for i in range(100)]


# --------------------------------------------------------------------- retention --
def paths_below(root):
    return sorted(p for p in snapshot(root) if p.endswith(".parquet"))


def test_clean_keeps_the_files_of_kept_versions_only(spark, tmp_path):
    wh = first(spark, tmp_path)
    for m in (1, 2, 6):
        load_frames(spark, wh, monthly(spark, [(2023, m, "S1", "00+", "all", float(m))]), weather(spark, []))
    kept = {v: wh.manifest(v) for v in (3, 4)}
    readers = {v: [wh.table(t, m) for t in wh.schemas] for v, m in kept.items()}
    before = {v: [rows(t) for t in ts] for v, ts in readers.items()}
    current = facts(wh)
    gone = wh.clean(keep=2)
    assert gone and sorted(wh.commits()) == [3, 4]
    assert {v: [rows(t) for t in ts] for v, ts in readers.items()} == before and facts(wh) == current
    needed = {p.removeprefix("file:") for m in kept.values() for p in m.tables.values()}
    assert all(any(p.startswith(n + "/") for n in needed) for p in paths_below(wh.root))
    assert wh.clean(keep=2) == []
    assert load_frames(spark, wh, monthly(spark, MORE), weather(spark, [])).version == 5
    with pytest.raises(ValueError):
        wh.clean(keep=0)


def test_clean_leaves_a_load_at_work_alone(spark, tmp_path):
    wh = first(spark, tmp_path)
    attempt = wh.attempt(wh.manifest())
    wh.stage(attempt, "dim_edtype", wh.table("dim_edtype"))
    wh.storage.write(f"{wh.root}/_commits/.commit-00000002.json-x", "{")
    assert wh.clean(keep=1) == [] and os.path.isdir(attempt.folder)
    gone = wh.clean(keep=1, dead_after_s=-5)
    assert sorted(os.path.basename(g)[:8] for g in gone) == [".commit-", "v0000000"]
    assert not os.path.isdir(attempt.folder) and len(facts(wh)) == 4


def test_a_published_load_leaves_no_scratch(spark, tmp_path):
    wh = first(spark, tmp_path)
    assert not [p for p in snapshot(wh.root) if "_keys" in p]


# -------------------------------------------------------------------------- view --
def test_another_session_sees_the_newest_version(spark, tmp_path):
    wh = first(spark, tmp_path)
    db = f"bi_{time.time_ns()}"
    with pytest.raises(LookupError):
        publish_view(Warehouse(spark, str(tmp_path / "none")), db)
    assert publish_view(wh, db) == 1
    other = spark.newSession()
    view = f"{db}.vw_erkrankungen_monatlich"
    assert other.sql(f"SELECT count(*) AS n FROM {view}").first()["n"] == 4
    load_frames(spark, wh, monthly(spark, MORE), weather(spark, []))
    assert other.table(view).count() == 4              # as published, until published anew
    assert publish_view(wh, db, keep=1) == 2 and publish_view(wh, db, keep=1) == 2
    assert rows(other.table(view)) == rows(warehouse_flat_view(wh, register=False))
    assert other.table(view).columns == warehouse_flat_view(wh, register=False).columns
    tables = {r.tableName for r in other.sql(f"SHOW TABLES IN {db}").collect()}
    assert {t for t in tables if t.endswith("__v1")} == set() and len(tables) == 6
    plan = other.sql(f"SELECT syndrome FROM {view} WHERE year = 2024")._jdf.queryExecution().toString()
    assert "dim_datum__v2" in plan
    spark.sql(f"DROP DATABASE {db} CASCADE")
    assert len(facts(wh)) == 5                         # the catalog never owns the files
