"""Properties of the load on the smallest driver tables."""

from pyspark.sql import functions as F

from starload.plans.catalog import _batch, _monthly
from starload.plans.load import key_batch, load, stage_dimensions
from starload.plans.marts import warehouse_flat_view
from starload.operators.upsert import split_rejects
from starload.sources.warehouse import Manifest, Warehouse

SF = "/root/testdata/sf0.001"
COLS = ["year", "month", "syndrome", "age_group", "ed_type", "relative_cases", "ed_count", "temperature_mean"]


def flat_rows(wh):
    return sorted(tuple(r) for r in warehouse_flat_view(wh, register=False).select(*COLS).collect())


def test_left_join_keeps_left_row_count(spark):
    assert _batch(spark, SF).count() == _monthly(spark, SF).count()


def test_facts_plus_rejects_equal_batch(spark, tmp_path):
    batch = _batch(spark, SF)
    wh = Warehouse(spark, str(tmp_path / "w"))
    dims, _, _ = stage_dimensions(wh, wh.attempt(Manifest()), batch, Manifest())
    dims["dim_syndrom"] = dims["dim_syndrom"].filter(F.col("syndrom_key") % 2 == 0)
    ok, rej = split_rejects(key_batch(batch, dims))
    assert ok.count() + rej.count() == batch.count() and rej.count() > 0


def test_split_load_equals_single_load(spark, tmp_path):
    batch = _batch(spark, SF).persist()
    one = Warehouse(spark, str(tmp_path / "one"))
    load(spark, one, batch)
    two = Warehouse(spark, str(tmp_path / "two"))
    load(spark, two, batch.filter(F.col("year") < 1998))
    load(spark, two, batch.filter(F.col("year") >= 1998))
    assert flat_rows(one) == flat_rows(two)
    # keys never change on a re-load of the same batch
    keys = lambda wh: sorted(tuple(r) for r in wh.table("fakt_erkrankungen").select(
        "fakt_key", "datum_key", "syndrom_key", "altersgruppe_key", "edtype_key").collect())
    before = keys(two)
    load(spark, two, batch)
    assert keys(two) == before
    batch.unpersist()
