"""Registered queries over the driver tables, one per inventory item group.

Every query reads the driver tables (or files Spark writes from them into
the shared scratch folder) in full; ``ORACLES`` holds the DuckDB SQL that
must give the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions import (
    decimal_comma,
    na_token_to_null,
    nan_to_null,
    parse_date,
    season_of_month,
    to_double,
    to_int_key,
)
from starload.functions.patterns import FACT_GRAIN, MONTHLY_COLUMNS, WEATHER_MEASURES
from starload.operators.keys import assign_keys
from starload.operators.monthly import monthly_aggregate
from starload.operators.monthly_state import MonthlyState
from starload.operators.quality import (
    ConstraintViolation,
    column_coverage,
    duplicate_keys,
    not_constant_within,
    null_counts,
    orphan_keys,
    out_of_range,
)
from starload.operators.upsert import (
    all_resolved,
    date_rows,
    dimension_values,
    upsert_date_dimension,
    upsert_text_dimension,
)
from starload.plans import oracle_sql as O
from starload.plans.catalog_view import publish_view
from starload.plans.load import key_batch, load, prepare_batch, stage_dimensions
from starload.plans.marts import (
    DEFAULT_CLASSES,
    class_average,
    head_rows,
    integrity_checks,
    keyed_view,
    seasonality,
    star_tables,
    warehouse_flat_view,
)
from starload.plans.refresh import series_summary
from starload.plans.roles import (
    daily_from_tables,
    series_from_tables,
    table,
    write_series_family,
    write_series_files,
)
from starload.session import scratch_path
from starload.sources.csv_io import read_csv_typed, write_csv
from starload.sources.daily_tsv import read_daily_tsv, write_daily_tsv
from starload.sources.landing import landing_manifest
from starload.sources.paths import inputs_found
from starload.sources.series_files import (
    inner_join_series,
    load_series,
    load_weather,
    read_series_files,
    series_format_problems,
    series_long,
)
from starload.sources.warehouse import Manifest, Warehouse

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- helpers --
def _monthly(spark, sf):
    return monthly_aggregate(daily_from_tables(spark, sf))


def _batch(spark, sf):
    return prepare_batch(_monthly(spark, sf), series_from_tables(spark, sf))


def written_batch(spark, sf, wh: Warehouse) -> DataFrame:
    """The batch, computed once: written beside the warehouse and read back."""
    path = f"{wh.root}-batch"
    _batch(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def _loaded(spark, sf, name) -> Warehouse:
    wh = Warehouse(spark, scratch_path(spark, name))
    load(spark, wh, _batch(spark, sf))
    return wh


# ---------------------------------------------------------------- sources --
def src_tsv(spark, sf):
    """Daily series through tab-separated files, then A1."""
    path = scratch_path(spark, "daily-tsv")
    write_daily_tsv(daily_from_tables(spark, sf), path, null_token="NA")
    return monthly_aggregate(read_daily_tsv(spark, path))


def src_preamble_glob(spark, sf):
    """Three series through preamble files."""
    series = series_from_tables(spark, sf).persist()
    globs = write_series_family(series, scratch_path(spark, "series"), WEATHER_MEASURES)
    series.unpersist()
    return load_weather(spark, globs)


def csv_roundtrip(spark, sf):
    """Monthly facts through the processed CSV hand-over."""
    path = scratch_path(spark, "monthly-csv")
    write_csv(_monthly(spark, sf), path)
    types = {c: "string" for c in MONTHLY_COLUMNS}
    types.update(year="int", month="int")
    for c in MONTHLY_COLUMNS[5:]:
        types[c] = "double"
    return read_csv_typed(spark, path, types, "monthly facts csv")


def star_bootstrap(spark, sf):
    """Empty warehouse tables, first dimension values keyed."""
    wh = Warehouse(spark, scratch_path(spark, "bootstrap"))
    empty = wh.table("dim_syndrom")
    cust = table(spark, sf, "customer")
    values = dimension_values(cust, "c_mktsegment", "bezeichnung")
    return upsert_text_dimension(empty, values, "syndrom_key", "bezeichnung")


LEFT_OUT = (4, 9)


def landing_manifest_q(spark, sf):
    """Landed files per variable and month with their sizes, two months
    missing. The series hold whole numbers, so a file's length follows from the table."""
    o = table(spark, sf, "orders")
    series = o.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("temperature_mean"), F.max("o_custkey").alias("precipitation"), F.max("o_orderkey").alias("sunshine_duration")
    )
    globs = write_series_family(series, scratch_path(spark, "landing"), WEATHER_MEASURES, leave_out_months=LEFT_OUT)
    out = landing_manifest(spark, globs, month_pattern=r"file_month=(\d{2})/")
    return out.select("variable", "month", "n_files", "bytes")


# ---------------------------------------------------- scalar expressions --
def project_rename(spark, sf):
    """C1, C2."""
    n = table(spark, sf, "nation")
    return n.select(
        F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("nation_name"), F.col("n_regionkey").alias("region_key")
    )


def _dirty_segment():
    k = F.col("c_custkey") % 7
    seg = F.col("c_mktsegment")
    return (
        F.when(k == 0, F.concat(F.lit("  "), seg))
        .when(k == 1, F.concat(seg, F.lit("\t ")))
        .when(k == 2, F.lit("NaN"))
        .when(k == 3, F.lit(" \t "))
        .when(k == 4, F.lit(None).cast("string"))
        .when(k == 5, F.lit("nan"))
        .otherwise(seg)
    )


def clean_text_key(spark, sf):
    """Dimension values from dirty text."""
    c = table(spark, sf, "customer").select(_dirty_segment().alias("segment"))
    from starload.functions import dimension_text

    return (
        c.select(dimension_text("segment").alias("segment"))
        .filter(F.col("segment").isNotNull())
        .groupBy("segment")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def _dirty_number():
    k = F.col("p_partkey") % 9
    return (
        F.when(k == 0, F.lit("x"))
        .when(k == 1, F.lit("1.234,5"))
        .when(k == 2, F.lit(""))
        .when(k == 3, F.lit("nan"))
        .when(k == 4, F.lit("1d"))
        .when(k == 5, F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit("e1 ")))
        .when(k == 6, F.lit("0x10"))
        .otherwise(F.concat(F.col("p_size").cast("string"), F.lit(",5")))
    )


def parse_decimal_comma(spark, sf):
    """C5, C6, F2."""
    p = table(spark, sf, "part").select("p_partkey", _dirty_number().alias("txt"))
    return p.select("p_partkey", to_double(decimal_comma("txt")).alias("value")).dropna(subset=["value"])


def parse_int_key(spark, sf):
    """Tolerant integer keys."""
    k = F.col("n_nationkey") % 4
    txt = (
        F.when(k == 0, F.lit("x"))
        .when(k == 1, F.concat(F.col("n_nationkey").cast("string"), F.lit(".0")))
        .when(k == 2, F.concat(F.lit(" 0"), F.col("n_nationkey").cast("string"), F.lit(" ")))
        .otherwise(F.concat(F.col("n_nationkey").cast("string"), F.lit("e0")))
    )
    n = table(spark, sf, "nation").select("n_nationkey", txt.alias("txt"))
    return n.select("n_nationkey", to_int_key("txt").alias("parsed"))


def date_parts(spark, sf):
    """Dates parsed from text."""
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("txt"))
    d = parse_date("txt")
    return o.select("o_orderkey", F.year(d).cast("int").alias("year"), F.month(d).cast("int").alias("month"))


def season_of_month_q(spark, sf):
    """C10."""
    o = table(spark, sf, "orders").select(season_of_month(F.month("o_orderdate")).alias("season"))
    return o.groupBy("season").agg(F.count(F.lit(1)).alias("n_orders"))


def nan_to_null_q(spark, sf):
    """C11: NaN must not poison an average."""
    li = table(spark, sf, "lineitem")
    tax = F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))).otherwise(F.round(F.col("l_tax") * 100, 2) + F.lit(0.0))
    x = li.select("l_returnflag", nan_to_null(tax).alias("tax_pct"))
    return x.groupBy("l_returnflag").agg(F.avg("tax_pct").alias("avg_tax_pct"), F.count("tax_pct").alias("n_values"))


def na_tokens(spark, sf):
    """Reader tokens for missing values."""
    k = F.col("o_orderkey") % 5
    txt = (
        F.when(k == 0, F.lit("NA"))
        .when(k == 1, F.lit("#N/A"))
        .when(k == 2, F.lit(""))
        .when(k == 3, F.lit("n/a "))
        .otherwise(F.col("o_orderstatus"))
    )
    o = table(spark, sf, "orders").select(na_token_to_null(txt).alias("status"))
    return o.groupBy("status").agg(F.count(F.lit(1)).alias("n_orders"))


def date_dim(spark, sf):
    """Date-dimension rows of the order months; every order of
    1996 lacks its month, every order of a November its year."""
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    return date_rows(table(spark, sf, "orders").select(F.when(m != 11, y).alias("year"), F.when(y != 1996, m).alias("month")))


def drop_missing_keys(spark, sf):
    """F1."""
    o = table(spark, sf, "orders")
    y = F.when(F.col("o_orderkey") % 9 != 0, F.year("o_orderdate")).cast("int")
    m = F.when(F.col("o_orderkey") % 11 != 0, F.month("o_orderdate")).cast("int")
    return o.select("o_orderkey", y.alias("year"), m.alias("month")).dropna(subset=["year", "month"])


# ---------------------------------------------------- aggregates and joins --
def monthly_agg(spark, sf):
    """F4, A1, A2, V11."""
    return _monthly(spark, sf)


def left_join_month(spark, sf):
    """J1."""
    return _batch(spark, sf)


def inner_join_3(spark, sf):
    """J2 on separate frames, each missing other months."""
    s = series_from_tables(spark, sf)
    a = s.filter(F.col("month") != 1).select("year", "month", "temperature_mean")
    b = s.filter(F.col("month") != 2).select("year", "month", "precipitation")
    c = s.filter(F.col("year") != 1996).select("year", "month", "sunshine_duration")
    return inner_join_series([a, b, c])


def dim_key_lookup(spark, sf):
    """Natural keys with their surrogate keys."""
    wh = Warehouse(spark, scratch_path(spark, "lookup"))
    batch = written_batch(spark, sf, wh)
    dims, _, _ = stage_dimensions(wh, wh.attempt(Manifest()), batch, Manifest())
    keyed = key_batch(batch, dims)
    return keyed.select("year", "month", "syndrome", "age_group", "ed_type", "datum_key", "syndrom_key", "altersgruppe_key", "edtype_key")


def fact_rejects(spark, sf):
    """lookup against a syndrome dimension that lacks one value."""
    wh = Warehouse(spark, scratch_path(spark, "rejects"))
    batch = written_batch(spark, sf, wh)
    dims, _, _ = stage_dimensions(wh, wh.attempt(Manifest()), batch, Manifest())
    dims["dim_syndrom"] = dims["dim_syndrom"].filter(F.col("bezeichnung") != "STANDARD")
    resolved = all_resolved(FACT_GRAIN)
    return key_batch(batch, dims).groupBy("syndrome", resolved.alias("resolved")).agg(F.count(F.lit(1)).alias("n_rows"))


def dedup_keep_last(spark, sf):
    """A5, O1: last row per month by (status as file, order key as line)."""
    from starload.sources.series_files import keep_last

    o = table(spark, sf, "orders").select(
        F.year("o_orderdate").cast("int").alias("year"),
        F.month("o_orderdate").cast("int").alias("month"),
        F.col("o_orderstatus").alias("file"),
        F.col("o_orderkey").alias("n"),
        F.col("o_totalprice").alias("value"),
    )
    return keep_last(o, ["value"]).orderBy("year", "month")


def series_summary_q(spark, sf):
    """A6."""
    return series_summary(series_from_tables(spark, sf))


def load_report_q(spark, sf):
    """Counts of one load, with one syndrome blank in 1995 (skipped)."""
    m = _monthly(spark, sf)
    m = m.withColumn(
        "syndrome",
        F.when((F.col("syndrome") == "SMALL") & (F.col("year") == 1995), F.lit(" \t")).otherwise(F.col("syndrome")),
    )
    wh = Warehouse(spark, scratch_path(spark, "report"))
    res = load(spark, wh, prepare_batch(m, series_from_tables(spark, sf)))
    rep = res.report
    cols = ["n_syndrom", "n_altersgruppe", "n_edtype", "n_datum", "facts_upserted", "rows_skipped"]
    return spark.createDataFrame([tuple(int(rep[c]) for c in cols)], ", ".join(f"{c} long" for c in cols))


def seasonality_q(spark, sf):
    """A8 over the published star."""
    flat = warehouse_flat_view(_loaded(spark, sf, "season"))
    s = seasonality(flat)
    return s.select("season", "syndrome", F.round("avg_relative_cases", 6).alias("avg_relative_cases"), "n_months")


def _class_q(by):
    def q(spark, sf):
        flat = warehouse_flat_view(_loaded(spark, sf, f"class-{by}"))
        c = class_average(flat, by)
        return c.select(f"{by}_class", "syndrome", F.round("avg_relative_cases", 6).alias("avg_relative_cases"), "n_months")

    q.__doc__ = f"A9-A11: class average by {by}."
    return q


def head_n(spark, sf):
    """First five months of the series."""
    return head_rows(series_from_tables(spark, sf), ["year", "month"], 5)


def union_series(spark, sf):
    """The rows of three separate file series united, earlier lines of a month included."""
    globs = write_series_family(series_from_tables(spark, sf), scratch_path(spark, "united"), WEATHER_MEASURES)
    return series_long(spark, globs).select("series", "year", "month", "value")


# -------------------------------------------------------------- upserts --
def surrogate_keys(spark, sf):
    """U4: dense keys in name order by the partitioned method (range
    partitions, per-partition counts, broadcast offsets)."""
    c = table(spark, sf, "customer").select("c_name")
    return assign_keys(c, ["c_name"], "customer_key")


def surrogate_keys_grain(spark, sf):
    """U4 on a composite grain: every distinct (order, line) pair of lineitem."""
    g = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return assign_keys(g, ["l_orderkey", "l_linenumber"], "line_key")


def upsert_dim_text(spark, sf):
    """Stored even brands, batch all brands."""
    p = table(spark, sf, "part")
    brand_no = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    stored_vals = dimension_values(p.filter(brand_no % 2 == 0), "p_brand", "typ")
    empty = Warehouse(spark, scratch_path(spark, "dimtext")).table("dim_edtype")
    stored = upsert_text_dimension(empty, stored_vals, "edtype_key", "typ")
    batch = dimension_values(p, "p_brand", "typ")
    return upsert_text_dimension(stored, batch, "edtype_key", "typ")


def upsert_date_dim(spark, sf):
    """Stored months before 1998 carry a wrong season; batch from 1997."""
    o = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    empty = Warehouse(spark, scratch_path(spark, "datedim")).table("dim_datum")
    stored = upsert_date_dimension(empty, date_rows(o.filter(F.col("year") < 1998))).withColumn("saison", F.lit("?"))
    return upsert_date_dimension(stored, date_rows(o.filter(F.col("year") >= 1997)))


def upsert_fact(spark, sf):
    """U3 through two published loads: months before 1999 first, then months
    from 1998 on with some measures NULL (NULL must overwrite); keys included."""
    batch = _batch(spark, sf).persist()
    wh = Warehouse(spark, scratch_path(spark, "facts"))
    load(spark, wh, batch.filter(F.col("year") < 1999))
    even = F.col("month") % 2 == 0
    second = batch.filter(F.col("year") >= 1998)
    for c in ("relative_cases_avg", "temperature_mean"):
        second = second.withColumn(c, F.when(~even, F.col(c)))
    load(spark, wh, second)
    batch.unpersist()
    return keyed_view(wh).drop("season", "month_date")


def idempotent_reload(spark, sf):
    """The same load twice, published, read back with its keys."""
    wh = Warehouse(spark, scratch_path(spark, "reload"))
    batch = _batch(spark, sf).persist()
    load(spark, wh, batch)
    load(spark, wh, batch)
    batch.unpersist()
    return keyed_view(wh)


def month_rewrite(spark, sf):
    """U3 by month: a star loaded whole, then one month with a NULL measure; which
    months the second load wrote anew, and their facts."""
    batch = _batch(spark, sf).persist()
    wh = Warehouse(spark, scratch_path(spark, "months"))
    load(spark, wh, batch)
    load(spark, wh, batch.filter((F.col("year") == 1997) & (F.col("month") == 5)).withColumn("precipitation", F.lit(None).cast("double")))
    batch.unpersist()
    man = wh.manifest()
    anew = [k for k, v in man.partitions("fakt_erkrankungen").items() if "/v00000002-" in v]
    months = wh.table("fakt_erkrankungen", man, anew).select("datum_key").distinct().join(wh.table("dim_datum", man), "datum_key")
    flat = warehouse_flat_view(wh, register=False)
    counts = flat.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_facts"), F.count("precipitation").alias("n_precipitation"))
    anew = months.select(F.col("jahr").alias("year"), F.col("monat").alias("month"), F.lit(True).alias("written"))
    return counts.join(anew, ["year", "month"], "left").withColumn("rewritten", F.coalesce("written", F.lit(False))).drop("written")


def refused_load(spark, sf):
    """V5, V6 as a gate: a published star with one age group doubled and one syndrome
    removed; the next load is refused. The rules it names, and the newest version."""
    batch = _batch(spark, sf).persist()
    wh = Warehouse(spark, scratch_path(spark, "refused"))
    load(spark, wh, batch.filter(F.col("year") < 1999))
    man = wh.manifest()
    spoiled = wh.attempt(man)
    ages = wh.table("dim_altersgruppe", man)
    doubled = ages.unionByName(ages.filter("altersgruppe = 'A'").withColumn("altersgruppe_key", F.col("altersgruppe_key") + 1000))
    wh.stage(spoiled, "dim_altersgruppe", doubled)
    wh.stage(spoiled, "dim_syndrom", wh.table("dim_syndrom", man).filter("bezeichnung <> 'STANDARD'"))
    staged = {t: wh.staged_path(spoiled, t) for t in ("dim_altersgruppe", "dim_syndrom")}
    wh.commit(spoiled, staged, {k: v for k, v in man.tables.items() if k not in staged}, man.max_keys, man.held, man.hidden)
    try:
        load(spark, wh, batch.filter("year >= 1998 and age_group <> 'A' and syndrome <> 'STANDARD'"))
        raise AssertionError("the load was published")
    except ConstraintViolation as e:
        found = e.violations
    finally:
        batch.unpersist()
    told = F.array(*[F.struct(F.lit(v["rule"]).alias("rule"), F.lit(v["subject"]).alias("subject"), F.lit(v["violations"]).cast("long").alias("violations")) for v in found])
    return spark.range(1).select(F.inline(told)).withColumn("version", F.lit(wh.current_version()).cast("long"))


def monthly_incremental(spark, sf):
    """A1 as mergeable state: daily files of the years before 1998; then one of them
    replaced by its right content and the later years; only what is new is read."""
    daily = daily_from_tables(spark, sf).filter(F.col("date").isNotNull()).persist()
    root = scratch_path(spark, "daily-files")
    state = MonthlyState(spark, scratch_path(spark, "monthly-state"))
    year = F.year("date")
    write_daily_tsv(daily.filter(year < 1997), f"{root}/early")
    write_daily_tsv(daily.filter(year == 1997).withColumn("ed_count", F.lit(9e6)), f"{root}/1997")
    state.refresh(f"{root}/*")
    write_daily_tsv(daily.filter(year == 1997), f"{root}/1997")
    write_daily_tsv(daily.filter(year > 1997), f"{root}/late")
    state.refresh(f"{root}/*")
    daily.unpersist()
    return state.monthly()


def lasting_view(spark, sf):
    """The catalog view after two loads, as another session sees it."""
    batch = _batch(spark, sf).persist()
    wh = Warehouse(spark, scratch_path(spark, "lasting"))
    database = f"bi_{uuid.uuid4().hex[:12]}"
    load(spark, wh, batch.filter(F.col("year") < 1998))
    publish_view(wh, database)
    load(spark, wh, batch.filter(F.col("year") >= 1998))
    publish_view(wh, database, keep=1)
    batch.unpersist()
    return spark.newSession().table(f"{database}.vw_erkrankungen_monatlich")


def retained_versions(spark, sf):
    """Three loads, one try that died; clean-up keeps the files of the newest version, which reads as before."""
    batch = _batch(spark, sf).persist()
    wh = Warehouse(spark, scratch_path(spark, "retained"))
    load(spark, wh, batch.filter(F.col("year") < 1998))
    load(spark, wh, batch.filter(F.col("year") >= 1998))
    wh.stage(wh.attempt(wh.manifest()), "dim_edtype", wh.table("dim_edtype"))
    load(spark, wh, batch.filter(F.col("year") == 1998))
    batch.unpersist()
    wh.clean(keep=1, dead_after_s=0)
    return warehouse_flat_view(wh, register=False)


def single_series_build(spark, sf):
    """The one-series build through files."""
    series = series_from_tables(spark, sf)
    glob = write_series_files(series, scratch_path(spark, "single"), "temperature_mean")
    return load_series(spark, glob, "temperature_mean")


def bi_flat_view(spark, sf):
    """J3, S9, C2, C13."""
    return warehouse_flat_view(_loaded(spark, sf, "flat"))


# -------------------------------------------------------------- quality --
WANTED_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderdate", "o_shippriority", "o_clerk", "o_totalprice"]


def dq_required_columns(spark, sf):
    """V1: wanted columns of orders, with the rows that have a value in each."""
    o = table(spark, sf, "orders").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")))
    return column_coverage(o, WANTED_ORDER_COLUMNS)


def dq_inputs_found(spark, sf):
    """V2: expected inputs, one of them absent, with the lines of those that exist."""
    root = scratch_path(spark, "inputs")
    for name, col in (("orders", "o_orderkey"), ("customer", "c_custkey")):
        table(spark, sf, name).select(F.col(col).cast("string")).write.text(f"{root}/{name}")
    paths = {name: f"{root}/{name}/*.txt" for name in ("orders", "customer", "absent")}
    return inputs_found(spark, paths).select("input", "found", "n_lines")


def dq_file_format(spark, sf):
    """V3, V4: one file without header, one without the region column."""
    series = series_from_tables(spark, sf)
    from starload.plans.roles import series_file_text

    files = series_file_text(series, "temperature_mean")
    txt = (
        F.when(F.col("file_month") == 2, F.regexp_replace("text", "Jahr;Monat", "Year;Month"))
        .when(F.col("file_month") == 7, F.regexp_replace("text", "Deutschland", "Germany"))
        .otherwise(F.col("text"))
    )
    root = scratch_path(spark, "badfiles")
    files.select(F.lpad(F.col("file_month").cast("string"), 2, "0").alias("file_month"), txt.alias("text")).write.partitionBy(
        "file_month"
    ).text(root)
    probs = series_format_problems(read_series_files(spark, f"{root}/file_month=*/*.txt"))
    return probs.select(F.regexp_extract("file", r"file_month=(\d{2})", 1).cast("int").alias("file_month"), "problem")


def dq_unique_grain(spark, sf):
    """V5, V12."""
    li = table(spark, sf, "lineitem")
    return duplicate_keys(li, ["l_orderkey", "l_linenumber"])


def dq_foreign_keys(spark, sf):
    """V6: lineitem against the odd-key parts only."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = table(spark, sf, "part").filter(F.col("p_partkey") % 2 == 1)
    o = orphan_keys(li, "l_partkey", part, "p_partkey")
    return o.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n_rows"))


def dq_null_profile(spark, sf):
    """V7, V9: NULLs per column of the joined batch."""
    return null_counts(_batch(spark, sf))


def dq_percent_range(spark, sf):
    """V8: relative measures outside 0..100."""
    li = table(spark, sf, "lineitem").select(
        (F.round(F.col("l_discount") * 1100, 2) + F.lit(0.0)).alias("discount_pct"),
        (F.round(F.col("l_tax") * 100, 2) + F.lit(0.0)).alias("tax_pct"),
    )
    return out_of_range(li, ["discount_pct", "tax_pct"])


def dq_month_constant(spark, sf):
    """Weather must be constant within a month; one month perturbed."""
    b = _batch(spark, sf)
    b = b.withColumn(
        "precipitation",
        F.when((F.col("year") == 1997) & (F.col("month") == 5) & (F.col("age_group") == "A"), F.col("precipitation") + 1)
        .otherwise(F.col("precipitation")),
    )
    return not_constant_within(b, ["year", "month"], list(WEATHER_MEASURES))


def dq_star_integrity(spark, sf):
    """V5-V8 over a published star that is then corrupted: a syndrome stands twice,
    an age group is gone, the facts of every seventh month have no department type,
    those of every fifth month exceed 100 percent and those of month 1 stand twice."""
    t = star_tables(_loaded(spark, sf, "integrity"))
    fact, syn = t["fakt_erkrankungen"], t["dim_syndrom"]
    every = lambda n: F.col("datum_key") % n == 0
    fact = fact.withColumns(
        {
            "edtype_key": F.when(~every(7), F.col("edtype_key")),
            "relative_cases": F.when(every(5), F.col("relative_cases") + 100.5).otherwise(F.col("relative_cases")),
        }
    )
    t["fakt_erkrankungen"] = fact.unionByName(fact.where("datum_key = 1"))
    t["dim_syndrom"] = syn.unionByName(syn.where("syndrom_key = 1"))
    t["dim_altersgruppe"] = t["dim_altersgruppe"].where("altersgruppe_key <> 1")
    return integrity_checks(t)


QUERIES: dict[str, Query] = {
    "src_tsv": src_tsv,
    "src_preamble_glob": src_preamble_glob,
    "csv_roundtrip": csv_roundtrip,
    "star_bootstrap": star_bootstrap,
    "landing_manifest": landing_manifest_q,
    "project_rename": project_rename,
    "clean_text_key": clean_text_key,
    "parse_decimal_comma": parse_decimal_comma,
    "parse_int_key": parse_int_key,
    "date_parts": date_parts,
    "season_of_month": season_of_month_q,
    "nan_to_null": nan_to_null_q,
    "na_tokens": na_tokens,
    "date_dim": date_dim,
    "drop_missing_keys": drop_missing_keys,
    "monthly_agg": monthly_agg,
    "left_join_month": left_join_month,
    "inner_join_3": inner_join_3,
    "dim_key_lookup": dim_key_lookup,
    "fact_rejects": fact_rejects,
    "dedup_keep_last": dedup_keep_last,
    "series_summary": series_summary_q,
    "load_report": load_report_q,
    "seasonality": seasonality_q,
    "class_precipitation": _class_q("precipitation"),
    "class_temperature": _class_q("temperature_mean"),
    "class_sunshine": _class_q("sunshine_duration"),
    "head_n": head_n,
    "union_series": union_series,
    "surrogate_keys": surrogate_keys,
    "surrogate_keys_grain": surrogate_keys_grain,
    "upsert_dim_text": upsert_dim_text,
    "upsert_date_dim": upsert_date_dim,
    "upsert_fact": upsert_fact,
    "idempotent_reload": idempotent_reload,
    "single_series_build": single_series_build,
    "bi_flat_view": bi_flat_view,
    "dq_required_columns": dq_required_columns,
    "dq_inputs_found": dq_inputs_found,
    "month_rewrite": month_rewrite,
    "refused_load": refused_load,
    "monthly_incremental": monthly_incremental,
    "lasting_view": lasting_view,
    "retained_versions": retained_versions,
    "dq_file_format": dq_file_format,
    "dq_unique_grain": dq_unique_grain,
    "dq_foreign_keys": dq_foreign_keys,
    "dq_null_profile": dq_null_profile,
    "dq_percent_range": dq_percent_range,
    "dq_month_constant": dq_month_constant,
    "dq_star_integrity": dq_star_integrity,
}


_MONTHLY_SELECT = "SELECT * FROM monthly"
_FLAT_SELECT = "SELECT * FROM flat"


def _null_profile_sql() -> str:
    cols = ["year", "month", "syndrome", "age_group", "ed_type"] + list(MONTHLY_COLUMNS[5:]) + list(WEATHER_MEASURES)
    parts = ["count(*) AS n_rows"] + [f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in cols]
    return O.BASE_MERGED + "SELECT " + ", ".join(parts) + " FROM merged"


def _class_oracle(by):
    limits, labels = DEFAULT_CLASSES[by]
    return O.class_sql(by, limits, labels)


ORACLES: dict[str, str] = {
    "src_tsv": O.BASE + _MONTHLY_SELECT,
    "src_preamble_glob": "WITH " + O.SERIES.lstrip() + "\nSELECT * FROM series",
    "csv_roundtrip": O.BASE + _MONTHLY_SELECT,
    "star_bootstrap": """
SELECT CAST(row_number() OVER (ORDER BY c_mktsegment) AS BIGINT) AS syndrom_key, c_mktsegment AS bezeichnung
FROM (SELECT DISTINCT c_mktsegment FROM customer)""",
    "landing_manifest": """
WITH w AS (
  SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS temperature_mean,
         max(o_custkey) AS precipitation, max(o_orderkey) AS sunshine_duration FROM orders GROUP BY 1, 2),
l AS (UNPIVOT w ON temperature_mean, precipitation, sunshine_duration INTO NAME variable VALUE val),
f AS (
  SELECT variable, month,
         length('Monatswerte (generated from the order table)') + length('Jahr;Monat;Bayern;Deutschland;') + length('1800;MM;;;') + 4
         + sum(length('YYYY;MM;0;;') + 1 + length(CAST(val AS VARCHAR)) + CASE WHEN year % 2 = 0 THEN length('YYYY;MM;0;-999,5;') + 1 ELSE 0 END) AS bytes
  FROM l GROUP BY 1, 2)
SELECT variable, CAST(month AS INTEGER) AS month, CAST(CASE WHEN month IN (4, 9) THEN 0 ELSE 1 END AS BIGINT) AS n_files,
       CAST(CASE WHEN month IN (4, 9) THEN 0 ELSE bytes END AS BIGINT) AS bytes
FROM f""",
    "project_rename": "SELECT n_nationkey AS nation_key, n_name AS nation_name, n_regionkey AS region_key FROM nation",
    "clean_text_key": """
SELECT segment, count(*) AS n_rows FROM (
  SELECT CASE c_custkey % 7 WHEN 0 THEN c_mktsegment WHEN 1 THEN c_mktsegment WHEN 6 THEN c_mktsegment END AS segment
  FROM customer) WHERE segment IS NOT NULL GROUP BY 1""",
    "parse_decimal_comma": """
SELECT p_partkey, CASE p_partkey % 9 WHEN 5 THEN CAST(p_size * 10 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) + 0.5 END AS value
FROM part WHERE p_partkey % 9 NOT IN (0, 1, 2, 3, 4, 6)""",
    "parse_int_key": """
SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE CAST(n_nationkey AS INTEGER) END AS parsed FROM nation""",
    "date_parts": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""",
    "season_of_month": "SELECT " + O.SEASON.format(m="month(o_orderdate)") + " AS season, count(*) AS n_orders FROM orders GROUP BY 1",
    "nan_to_null": """
SELECT l_returnflag, avg(CASE WHEN l_linenumber = 3 THEN NULL ELSE round(l_tax * 100, 2) + 0.0 END) AS avg_tax_pct,
       count(CASE WHEN l_linenumber = 3 THEN NULL ELSE 1 END) AS n_values
FROM lineitem GROUP BY 1""",
    "na_tokens": """
SELECT CASE WHEN o_orderkey % 5 IN (0, 1, 2) THEN NULL WHEN o_orderkey % 5 = 3 THEN 'n/a ' ELSE o_orderstatus END AS status,
       count(*) AS n_orders FROM orders GROUP BY 1""",
    "date_dim": """
SELECT make_date(y, m, 1) AS datum, y AS jahr, m AS monat, CAST(weekofyear(make_date(y, m, 1)) AS INTEGER) AS woche,
       """ + O.SEASON.format(m="m") + """ AS saison
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m FROM orders)
WHERE y <> 1996 AND m <> 11""",
    "drop_missing_keys": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders WHERE o_orderkey % 9 <> 0 AND o_orderkey % 11 <> 0""",
    "monthly_agg": O.BASE + _MONTHLY_SELECT,
    "left_join_month": O.BASE_MERGED + "SELECT * FROM merged",
    "inner_join_3": "WITH " + O.SERIES.lstrip() + """
SELECT a.year, a.month, a.temperature_mean, b.precipitation, c.sunshine_duration
FROM (SELECT * FROM series WHERE month <> 1) a
JOIN (SELECT * FROM series WHERE month <> 2) b ON a.year = b.year AND a.month = b.month
JOIN (SELECT * FROM series WHERE year <> 1996) c ON a.year = c.year AND a.month = c.month""",
    "dim_key_lookup": O.BASE + """,
ds AS (SELECT syndrome, CAST(row_number() OVER (ORDER BY syndrome) AS BIGINT) AS syndrom_key FROM (SELECT DISTINCT syndrome FROM monthly)),
da AS (SELECT age_group, CAST(row_number() OVER (ORDER BY age_group) AS BIGINT) AS altersgruppe_key FROM (SELECT DISTINCT age_group FROM monthly)),
de AS (SELECT ed_type, CAST(row_number() OVER (ORDER BY ed_type) AS BIGINT) AS edtype_key FROM (SELECT DISTINCT ed_type FROM monthly)),
dd AS (SELECT year, month, CAST(row_number() OVER (ORDER BY year, month) AS BIGINT) AS datum_key FROM (SELECT DISTINCT year, month FROM monthly))
SELECT m.year, m.month, m.syndrome, m.age_group, m.ed_type, dd.datum_key, ds.syndrom_key, da.altersgruppe_key, de.edtype_key
FROM monthly m JOIN dd USING (year, month) JOIN ds USING (syndrome) JOIN da USING (age_group) JOIN de USING (ed_type)""",
    "fact_rejects": O.BASE + """
SELECT syndrome, syndrome <> 'STANDARD' AS resolved, count(*) AS n_rows FROM monthly GROUP BY 1, 2""",
    "dedup_keep_last": """
SELECT year, month, value FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, o_totalprice AS value,
         row_number() OVER (PARTITION BY year(o_orderdate), month(o_orderdate) ORDER BY o_orderstatus DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""",
    "series_summary": "WITH " + O.SERIES.lstrip() + """
SELECT count(*) AS n_rows, min(year) AS min_year, max(year) AS max_year FROM series""",
    "load_report": O.BASE + """,
b AS (SELECT year, month, CASE WHEN syndrome = 'SMALL' AND year = 1995 THEN NULL ELSE syndrome END AS syndrome, age_group, ed_type FROM monthly)
SELECT count(DISTINCT syndrome) AS n_syndrom, count(DISTINCT age_group) AS n_altersgruppe, count(DISTINCT ed_type) AS n_edtype,
       (SELECT count(*) FROM (SELECT DISTINCT year, month FROM b)) AS n_datum,
       count(syndrome) AS facts_upserted, count(*) - count(syndrome) AS rows_skipped
FROM b""",
    "seasonality": O.BASE_FLAT + """
SELECT season, syndrome, round(avg(relative_cases), 6) AS avg_relative_cases, count(relative_cases) AS n_months
FROM flat GROUP BY 1, 2""",
    "class_precipitation": _class_oracle("precipitation"),
    "class_temperature": _class_oracle("temperature_mean"),
    "class_sunshine": _class_oracle("sunshine_duration"),
    "head_n": "WITH " + O.SERIES.lstrip() + "\nSELECT * FROM series ORDER BY year, month LIMIT 5",
    "union_series": "WITH " + O.SERIES.lstrip() + """,
l AS (UNPIVOT series ON temperature_mean, precipitation, sunshine_duration INTO NAME series VALUE value)
SELECT series, year, month, value FROM l
UNION ALL SELECT series, year, month, -999.5 FROM l WHERE year % 2 = 0""",
    "surrogate_keys": "SELECT c_name, CAST(row_number() OVER (ORDER BY c_name) AS BIGINT) AS customer_key FROM customer",
    "surrogate_keys_grain": """
SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS BIGINT) AS line_key
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""",
    "upsert_dim_text": """
WITH b AS (SELECT DISTINCT p_brand FROM part),
ev AS (SELECT p_brand FROM b WHERE CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) % 2 = 0),
od AS (SELECT p_brand FROM b WHERE CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) % 2 = 1)
SELECT CAST(row_number() OVER (ORDER BY p_brand) AS BIGINT) AS edtype_key, p_brand AS typ FROM ev
UNION ALL
SELECT CAST((SELECT count(*) FROM ev) + row_number() OVER (ORDER BY p_brand) AS BIGINT) AS edtype_key, p_brand AS typ FROM od""",
    "upsert_date_dim": """
WITH ym AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m FROM orders),
st AS (SELECT y, m, row_number() OVER (ORDER BY y, m) AS k FROM ym WHERE y < 1998),
nw AS (SELECT y, m, (SELECT count(*) FROM st) + row_number() OVER (ORDER BY y, m) AS k FROM ym WHERE y >= 1998),
al AS (SELECT y, m, k, y >= 1997 AS fresh FROM st UNION ALL SELECT y, m, k, true FROM nw)
SELECT CAST(k AS BIGINT) AS datum_key, make_date(y, m, 1) AS datum, y AS jahr, m AS monat,
       CAST(weekofyear(make_date(y, m, 1)) AS INTEGER) AS woche,
       CASE WHEN fresh THEN """ + O.SEASON.format(m="m") + """ ELSE '?' END AS saison
FROM al""",
    "upsert_fact": O.BASE_MERGED + O.keys_sql("merged", "year < 1999") + """
SELECT fakt_key, datum_key, syndrom_key, altersgruppe_key, edtype_key, year, month, syndrome, age_group, ed_type,
       CASE WHEN year >= 1998 AND month % 2 = 0 THEN NULL ELSE relative_cases_avg END AS relative_cases,
       relative_cases_7day_ma_avg AS relative_cases_7day_ma, expected_value_avg AS expected_value,
       expected_lowerbound_avg AS expected_lowerbound, expected_upperbound_avg AS expected_upperbound,
       ed_count_avg AS ed_count,
       CASE WHEN year >= 1998 AND month % 2 = 0 THEN NULL ELSE temperature_mean END AS temperature_mean,
       precipitation, sunshine_duration
FROM keyed""",
    "idempotent_reload": O.BASE_FLAT + O.keys_sql("flat", "true") + "SELECT * EXCLUDE (stage) FROM keyed",
    "single_series_build": "WITH " + O.SERIES.lstrip() + "\nSELECT year, month, temperature_mean FROM series",
    "bi_flat_view": O.BASE_FLAT + _FLAT_SELECT,
    "dq_required_columns": """
SELECT c.column_name, c.present, o.n AS n_rows,
       CASE WHEN NOT c.present THEN 0 WHEN c.column_name = 'o_totalprice' THEN o.priced ELSE o.n END AS n_values
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 3 <> 0) AS priced FROM orders) o,
     (VALUES ('o_orderkey', true), ('o_custkey', true), ('o_orderdate', true), ('o_shippriority', false), ('o_clerk', false),
             ('o_totalprice', true)) c(column_name, present)""",
    "dq_inputs_found": """
SELECT 'orders' AS input, true AS found, count(*) AS n_lines FROM orders
UNION ALL SELECT 'customer', true, count(*) FROM customer
UNION ALL SELECT 'absent', false, 0""",
    "month_rewrite": O.BASE_FLAT + """
SELECT year, month, count(*) AS n_facts, CASE WHEN year = 1997 AND month = 5 THEN 0 ELSE count(precipitation) END AS n_precipitation,
       year = 1997 AND month = 5 AS rewritten
FROM flat GROUP BY year, month""",
    "refused_load": O.BASE + """
SELECT 'unique' AS rule, 'dim_altersgruppe.altersgruppe' AS subject, CAST(1 AS BIGINT) AS violations, CAST(2 AS BIGINT) AS version
UNION ALL
SELECT 'foreign_key', 'fakt_erkrankungen.syndrom_key', count(*), 2 FROM monthly m
WHERE syndrome = 'STANDARD' AND year = 1998 AND EXISTS (
  SELECT 1 FROM monthly b WHERE b.year = m.year AND b.month = m.month AND b.age_group <> 'A' AND b.syndrome <> 'STANDARD')""",
    "monthly_incremental": O.BASE + _MONTHLY_SELECT,
    "lasting_view": O.BASE_FLAT + _FLAT_SELECT,
    "retained_versions": O.BASE_FLAT + _FLAT_SELECT,
    "dq_file_format": """
SELECT * FROM (VALUES (2, 'header not found'), (7, 'column Deutschland not found')) t(file_month, problem)""",
    "dq_unique_grain": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_foreign_keys": """
SELECT l_partkey, count(*) AS n_rows FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_partkey % 2 = 1)
GROUP BY 1""",
    "dq_null_profile": _null_profile_sql(),
    "dq_percent_range": """
SELECT count(*) FILTER (WHERE NOT (round(l_discount * 1100, 2) + 0.0 BETWEEN 0 AND 100)) AS discount_pct,
       count(*) FILTER (WHERE NOT (round(l_tax * 100, 2) + 0.0 BETWEEN 0 AND 100)) AS tax_pct
FROM lineitem""",
    "dq_month_constant": O.BASE_MERGED + """
SELECT year, month, count(DISTINCT (temperature_mean,
       CASE WHEN year = 1997 AND month = 5 AND age_group = 'A' THEN precipitation + 1 ELSE precipitation END,
       sunshine_duration)) AS n_values
FROM merged GROUP BY 1, 2 HAVING n_values > 1""",
    "dq_star_integrity": O.BASE_MERGED + O.keys_sql("merged", "true") + """,
broken AS (
  SELECT datum_key, syndrom_key, altersgruppe_key, CASE WHEN datum_key % 7 <> 0 THEN edtype_key END AS edtype_key,
         relative_cases_avg + CASE WHEN datum_key % 5 = 0 THEN 100.5 ELSE 0 END AS rel, relative_cases_7day_ma_avg AS ma
  FROM keyed),
fact AS (SELECT * FROM broken UNION ALL SELECT * FROM broken WHERE datum_key = 1),
grains AS (SELECT count(*) AS n FROM (SELECT 1 FROM fact GROUP BY datum_key, syndrom_key, altersgruppe_key, edtype_key HAVING count(*) > 1)),
k AS (
  SELECT count(*) FILTER (WHERE altersgruppe_key = 1) AS lost, count(*) FILTER (WHERE edtype_key IS NULL) AS bare,
         count(*) FILTER (WHERE rel NOT BETWEEN 0 AND 100) AS over, count(*) FILTER (WHERE ma NOT BETWEEN 0 AND 100) AS ma_over
  FROM fact)
SELECT r.rule, r.subject,
       CAST(CASE r.what WHEN 'one' THEN 1 WHEN 'grains' THEN grains.n WHEN 'lost' THEN k.lost WHEN 'bare' THEN k.bare
                        WHEN 'over' THEN k.over WHEN 'ma_over' THEN k.ma_over ELSE 0 END AS BIGINT) AS violations
FROM k, grains, (VALUES
('unique', 'dim_datum.datum_key', 'none'),
('unique', 'dim_datum.datum', 'none'),
('foreign_key', 'dim_datum.datum_key', 'none'),
('unique', 'dim_syndrom.syndrom_key', 'one'),
('unique', 'dim_syndrom.bezeichnung', 'one'),
('foreign_key', 'dim_syndrom.syndrom_key', 'none'),
('unique', 'dim_altersgruppe.altersgruppe_key', 'none'),
('unique', 'dim_altersgruppe.altersgruppe', 'none'),
('foreign_key', 'dim_altersgruppe.altersgruppe_key', 'lost'),
('unique', 'dim_edtype.edtype_key', 'none'),
('unique', 'dim_edtype.typ', 'none'),
('foreign_key', 'dim_edtype.edtype_key', 'none'),
('unique', 'fact.datum_key+syndrom_key+altersgruppe_key+edtype_key', 'grains'),
('not_null', 'fact.datum_key', 'none'),
('not_null', 'fact.syndrom_key', 'none'),
('not_null', 'fact.altersgruppe_key', 'none'),
('not_null', 'fact.edtype_key', 'bare'),
('percent_range', 'fact.relative_cases', 'over'),
('percent_range', 'fact.relative_cases_7day_ma', 'ma_over')) r(rule, subject, what)""",
}
