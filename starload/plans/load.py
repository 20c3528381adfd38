"""The warehouse load: join weather to monthly facts, upsert the star, publish.

Order (one Spark application, each step a lazy plan):

1. ``prepare_batch``: required columns (V1), text keys trimmed (C4), tolerant
   year/month (C7) with incomplete pairs dropped (F1), measures NaN-free
   (C11), weather left-joined on (year, month) (J1).
2. Dimensions (U1, U2) are computed from the batch and written into the
   new, unpublished attempt first, so the fact lookup sees final keys.
3. Surrogate-key lookup (J4), rejects split off (F5), fact grain checked
   for duplicates (V12), fact upsert (U3) written to the same attempt.
4. The star's constraints (V5, V6, V7) are measured on what was written: the
   dimensions in one small job, the facts of the touched months while they are written.
   A violation, be it in the batch or in the stored star, refuses the load.
5. One commit record publishes all five tables at once (U5); running the
   same load again gives the same rows and keys (U6).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType

from starload.functions import dimension_text, nan_to_null, strip_text, to_double, to_int_key
from starload.functions.patterns import (
    DAILY_KEYS,
    FACT_GRAIN,
    FACT_MEASURES,
    MONTHLY_COLUMNS,
    WEATHER_COLUMNS,
    WEATHER_MEASURES,
)
from starload.operators.quality import (
    ConstraintViolation,
    assert_empty,
    columns_checked,
    dimension_violations,
    duplicate_keys,
)
from starload.operators.upsert import (
    all_resolved,
    date_rows,
    dimension_from_rows,
    merge_facts,
    resolve_keys,
    split_rejects,
    text_dimension_rows,
    upsert_date_dimension,
)
from starload.sources.warehouse import (
    FACT_PARTITION,
    TEXT_DIMENSIONS,
    WHOLE_YEAR,
    Attempt,
    Manifest,
    Warehouse,
    date_map,
    dimension_map,
    entry_values,
)

# batch column -> text dimension table
DIMENSION_OF = {"syndrome": "dim_syndrom", "age_group": "dim_altersgruppe", "ed_type": "dim_edtype"}

# monthly column -> fact column
FACT_SOURCE = {
    "relative_cases": "relative_cases_avg",
    "relative_cases_7day_ma": "relative_cases_7day_ma_avg",
    "expected_value": "expected_value_avg",
    "expected_lowerbound": "expected_lowerbound_avg",
    "expected_upperbound": "expected_upperbound_avg",
    "ed_count": "ed_count_avg",
    "temperature_mean": "temperature_mean",
    "precipitation": "precipitation",
    "sunshine_duration": "sunshine_duration",
}


def _as_int(df: DataFrame, c: str) -> F.Column:
    if isinstance(df.schema[c].dataType, IntegralType):
        return F.col(c).cast("int")
    return to_int_key(c, c)


def _as_double(df: DataFrame, c: str) -> F.Column:
    if isinstance(df.schema[c].dataType, NumericType):
        return nan_to_null(F.col(c).cast("double"))
    return to_double(c)


def prepare_batch(monthly: DataFrame, weather: DataFrame) -> DataFrame:
    """Monthly facts with the weather of their month."""
    columns_checked(monthly, MONTHLY_COLUMNS, "monthly facts")
    columns_checked(weather, WEATHER_COLUMNS, "monthly weather")
    measures = [c for c in MONTHLY_COLUMNS if c not in ("year", "month") + DAILY_KEYS]
    m = monthly.select(
        _as_int(monthly, "year").alias("year"),
        _as_int(monthly, "month").alias("month"),
        *[strip_text(F.col(k).cast("string")).alias(k) for k in DAILY_KEYS],
        *[_as_double(monthly, c).alias(c) for c in measures],
    ).dropna(subset=["year", "month"])
    w = weather.select(
        _as_int(weather, "year").alias("year"),
        _as_int(weather, "month").alias("month"),
        *[_as_double(weather, c).alias(c) for c in WEATHER_MEASURES],
    ).dropna(subset=["year", "month"])
    return m.join(w, ["year", "month"], "left")


@dataclass
class LoadResult:
    version: int
    report: dict


def load_report(keyed: DataFrame, keys=FACT_GRAIN) -> dict:
    """Counts of a load (A7) in one aggregate over the keyed batch.

    ``n_grains`` (distinct resolved grains) equals ``facts_upserted`` unless
    two batch rows share a grain (V12).
    """
    resolved = all_resolved(keys)
    row = keyed.agg(
        F.count_distinct(*keys).alias("n_grains"),
        F.count_distinct(dimension_text("syndrome")).alias("n_syndrom"),
        F.count_distinct(dimension_text("age_group")).alias("n_altersgruppe"),
        F.count_distinct(dimension_text("ed_type")).alias("n_edtype"),
        F.count_distinct("year", "month").alias("n_datum"),
        F.count_if(resolved).alias("facts_upserted"),
        F.count_if(~resolved).alias("rows_skipped"),
    ).first()
    return row.asDict()


def _side_by_side(spark: SparkSession, *jobs: Callable) -> list:
    """Run independent steps on driver threads that keep the caller's job group and pool."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(j)) for j in jobs]]


def stage_dimensions(
    wh: Warehouse, attempt: Attempt, batch: DataFrame, manifest: Manifest
) -> tuple[dict[str, DataFrame], dict[str, int], dict[str, str]]:
    """Upsert the four dimensions into ``attempt`` (U1, U2) and read them back.

    Returns the tables, their largest keys and their paths. The three text
    dimensions share one plan (one shuffle for their values); when the batch
    brings no new value they are not rewritten but carried forward by path.
    The text and date dimensions are independent, so their small Spark jobs
    are submitted from two driver threads and share the cluster.
    """
    carried: dict[str, str] = {}

    def text_dims():
        spec = {c: (t, *TEXT_DIMENSIONS[t]) for c, t in DIMENSION_OF.items()}
        stored = {t: wh.table(t, manifest) for t in DIMENSION_OF.values()}
        starts = {t: manifest.max_key(t) for t in DIMENSION_OF.values()}
        none = not any(manifest.has(t) for t in stored)
        known, new = text_dimension_rows(batch, spec, stored, starts, wh.key_scratch(attempt, "text"), stored_empty=none)
        if new is None and all(t in manifest.tables for t in stored):
            carried.update({t: manifest.tables[t] for t in stored})
            return {t: (stored[t], None) for t in stored}
        rows = known if new is None else known.unionByName(new)
        steps = [(lambda t=t, key=key, val=val: wh.stage(attempt, t, dimension_from_rows(rows, t, key, val), key)) for t, key, val in spec.values()]
        return dict(zip([t for t, _, _ in spec.values()], _side_by_side(wh.spark, *steps), strict=True))

    def date_dim():
        stored = wh.table("dim_datum", manifest)
        scratch, none = wh.key_scratch(attempt, "dim_datum"), not manifest.has("dim_datum")
        dates = upsert_date_dimension(stored, date_rows(batch), manifest.max_key("dim_datum"), scratch, stored_empty=none)
        return wh.stage(attempt, "dim_datum", dates, "datum_key")

    text, date = _side_by_side(wh.spark, text_dims, date_dim)
    done = {**text, "dim_datum": date}
    frames = {t: df for t, (df, _) in done.items()}
    keys = {t: max(manifest.max_key(t), mk or 0) for t, (_, mk) in done.items()}
    paths = {t: carried.get(t, wh.staged_path(attempt, t)) for t in done}
    return frames, keys, paths


def key_batch(batch: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The batch with its four surrogate keys (J4); misses stay NULL."""
    text_maps = {col: (dimension_map(dims[t], t), *TEXT_DIMENSIONS[t]) for col, t in DIMENSION_OF.items()}
    return resolve_keys(batch, date_map(dims["dim_datum"]), text_maps)


def fact_rows(keyed_ok: DataFrame) -> DataFrame:
    return keyed_ok.select(*FACT_GRAIN, *[F.col(FACT_SOURCE[m]).alias(m) for m in FACT_MEASURES])


FACT_TABLE = "fakt_erkrankungen"


@dataclass
class StagedFacts:
    """Fact partitions of an unpublished version: new and carried entries, which months
    they hold and which of them are replaced (by date key), largest key, broken rules."""

    entries: dict[str, str]
    carried: dict[str, str]
    held: dict[str, list[int]]
    hidden: dict[str, list[int]]
    max_key: int
    violations: list[dict]


@dataclass
class TouchedMonths:
    """What a batch's months mean for the stored fact partitions.

    ``rows`` counts the batch's rows by (year, month, date key). A stored year all of whose
    months are in the batch (or of which the record does not say what it holds) is
    ``whole``: its entries are replaced by one. Of another year only the batch's months are
    written, each to an entry of its own.
    """

    rows: dict[tuple[int, int, int], int]
    whole: set[int]
    unknown: set[int]  # of these, the years of which the record does not say what they hold
    read: list[str]  # stored entries to open
    unread: list[int]  # date keys in them that the batch does not touch

    @classmethod
    def of(cls, rows: dict[tuple[int, int, int], int], manifest: Manifest) -> TouchedMonths:
        touched: dict[int, set[int]] = {}
        for year, _, key in rows:
            touched.setdefault(year, set()).add(key)
        by_year: dict[int, list[str]] = {}
        for entry in manifest.partitions(FACT_TABLE):
            by_year.setdefault(entry_values(entry)[0], []).append(entry)
        whole, unknown, read, unread = set(), set(), [], []
        for year, keys in touched.items():
            entries = by_year.get(year, [])
            live = {e: set(manifest.held[e]) - set(manifest.hidden.get(e, ())) for e in entries if e in manifest.held}
            if len(live) < len(entries) or set().union(*live.values()) <= keys:
                whole.add(year)
                unknown |= {year} if len(live) < len(entries) else set()
                read += entries
            else:
                hit = [e for e in entries if live[e] & keys]
                read += hit
                unread += [k for e in hit for k in live[e] - keys]
        return cls(rows, whole, unknown, read, sorted(unread))

    def folder(self, year: int, month: int) -> tuple[int, int]:
        """Values of the partition that a row is written to."""
        return (year, WHOLE_YEAR if year in self.whole else month)

    def months(self) -> dict[tuple[int, int], list[int]]:
        """Date keys of each partition to write."""
        out: dict[tuple[int, int], list[int]] = {}
        for year, month, key in self.rows:
            out.setdefault(self.folder(year, month), []).append(key)
        return out

    def counts(self) -> dict[tuple[int, int], int]:
        out: dict[tuple[int, int], int] = {}
        for (year, month, _), n in self.rows.items():
            f = self.folder(year, month)
            out[f] = out.get(f, 0) + n
        return out


def _fact_rules(stored_empty: bool) -> dict[tuple[str, str], F.Column]:
    """Rule and subject -> count over the merged rows and the marks of found dimensions."""
    rules = {("not_null", f"{FACT_TABLE}.{k}"): F.count_if(F.col(k).isNull()) for k in FACT_GRAIN}
    if not stored_empty:
        rules[("unique", f"{FACT_TABLE}.{'+'.join(FACT_GRAIN)}")] = F.count_if((F.col("_stored") > 1) | (F.col("_batch") > 1))
        for k in FACT_GRAIN:
            rules[("foreign_key", f"{FACT_TABLE}.{k}")] = F.count_if(F.col(k).isNotNull() & F.col(f"_found_{k}").isNull())
    return rules


def stage_facts(
    wh: Warehouse, attempt: Attempt, facts: DataFrame, rows: dict[tuple[int, int, int], int], dims: dict[str, DataFrame], manifest: Manifest
) -> StagedFacts:
    """Fact upsert (U3) restricted to the months the batch touches.

    Only their stored rows are merged and written; other months are carried forward by
    path, also where one folder holds both: the record then says which of its months
    are replaced. NOT NULL, the grain's uniqueness and the foreign keys (V5-V7) are counted
    while the rows are written; rows of a first load have just got their keys from the
    dimensions, so those need no look-up. ``rows`` counts the batch's rows by (year,
    month, date key).
    """
    touched = TouchedMonths.of(rows, manifest)
    first = not touched.read
    stored = wh.table(FACT_TABLE, Manifest() if first else manifest, None if first else touched.read)
    if touched.unread:
        stored = stored.where(F.col("datum_key").isNull() | ~F.col("datum_key").isin(touched.unread))
    merged = merge_facts(stored, facts, start=manifest.max_key(FACT_TABLE), stored_empty=first, path=wh.key_scratch(attempt, FACT_TABLE))
    month = F.when(F.col("jahr").isin(sorted(touched.whole)), WHOLE_YEAR).otherwise(F.col("monat")) if touched.whole else F.col("monat")
    merged = merged.join(dims["dim_datum"].select("datum_key", "jahr", month.alias("monat"), F.lit(True).alias("_found_datum_key")), "datum_key", "left")
    if not first:
        for t, (key, _) in TEXT_DIMENSIONS.items():
            merged = merged.join(dims[t].select(key, F.lit(True).alias(f"_found_{key}")), key, "left")
    rules = _fact_rules(first)
    metrics = {"max_key": F.max("fakt_key"), **{f"m{i}": m for i, m in enumerate(rules.values())}}
    seen = wh.stage_partitions(attempt, FACT_TABLE, merged, FACT_PARTITION, metrics, touched.counts(), FACT_GRAIN)
    broken = [{"rule": rule, "subject": subject, "violations": seen[f"m{i}"]} for i, (rule, subject) in enumerate(rules) if seen.get(f"m{i}")]
    months = touched.months()
    for year in touched.unknown:  # what its old folders held is known now that it is written
        at = f"{wh.staged_path(attempt, FACT_TABLE)}/jahr={year}/monat={WHOLE_YEAR}"
        keys = wh.spark.read.schema(wh.schemas[FACT_TABLE]).parquet(at).select("datum_key").distinct()
        months[(year, WHOLE_YEAR)] = [r.datum_key for r in keys.collect()]
    entries = wh.partition_entries(attempt, FACT_TABLE, FACT_PARTITION, months)
    held = {**manifest.held, **dict(zip(entries, months.values(), strict=True))}
    replaced = {k for keys in months.values() for k in keys}
    carried, hidden = {}, {}
    for e, path in manifest.partitions(FACT_TABLE).items():
        gone = set(manifest.hidden.get(e, ())) | (set(manifest.held.get(e, ())) & replaced)
        if e in entries or entry_values(e)[0] in touched.whole or (e in manifest.held and gone >= set(manifest.held[e])):
            continue
        carried[e], hidden[e] = path, sorted(gone)
    return StagedFacts(entries, carried, held, hidden, max(manifest.max_key(FACT_TABLE), seen.get("max_key", 0)), broken)


def dimension_rules(dims: dict[str, DataFrame]) -> DataFrame:
    """Broken rules of the four dimensions (V5, V7)."""
    spec = {"dim_datum": (dims["dim_datum"], ["datum_key", "datum"], ["jahr", "monat", "woche", "saison"])}
    spec |= {t: (dims[t], [key, val], []) for t, (key, val) in TEXT_DIMENSIONS.items()}
    return dimension_violations(spec)


def load(spark: SparkSession, wh: Warehouse, batch: DataFrame, manifest: Manifest | None = None) -> LoadResult:
    """Load one prepared batch into the warehouse and publish it atomically.

    ``manifest`` is the version to build on (default: the current one); if another
    load has published on it in the meantime, this one raises ``CommitConflict``. If the
    version would break a constraint of the star, ``ConstraintViolation`` names the
    rules, nothing is published and what was written is removed. The rules cover all
    dimension rows and the facts of the months that the batch touches.
    """
    manifest = wh.manifest() if manifest is None else manifest
    attempt = wh.attempt(manifest)
    held = []
    if not batch.is_cached:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        held.append(batch)
    try:
        dims, max_keys, dim_paths = stage_dimensions(wh, attempt, batch, manifest)
        keyed = key_batch(batch, dims).persist(StorageLevel.MEMORY_AND_DISK)
        held.append(keyed)
        ok, _rejected = split_rejects(keyed)
        facts = fact_rows(ok)

        def staged() -> StagedFacts:
            months = ok.groupBy("year", "month", "datum_key").agg(F.count(F.lit(1)).alias("n")).collect()  # bounded by the calendar
            return stage_facts(wh, attempt, facts, {(r.year, r.month, r.datum_key): r.n for r in months}, dims, manifest)

        # the report (with the grain check), the rules of the dimensions and the fact upsert
        # run side by side; the version is committed only if all succeed
        facts_done, report, broken = _side_by_side(
            spark, staged, lambda: load_report(keyed), lambda: [r.asDict() for r in dimension_rules(dims).collect()]
        )
        if broken := broken + facts_done.violations:
            wh.discard(attempt)
            raise ConstraintViolation(broken)
        if report.pop("n_grains") != report["facts_upserted"]:
            assert_empty(duplicate_keys(facts, FACT_GRAIN), "two batch rows for one fact grain")
        max_keys[FACT_TABLE] = facts_done.max_key
        wh.commit(attempt, {**dim_paths, **facts_done.entries}, facts_done.carried, max_keys, facts_done.held, facts_done.hidden)
        return LoadResult(attempt.version, report)
    finally:
        for df in held:
            df.unpersist()


def load_frames(spark: SparkSession, wh: Warehouse, monthly: DataFrame, weather: DataFrame) -> LoadResult:
    return load(spark, wh, prepare_batch(monthly, weather))
