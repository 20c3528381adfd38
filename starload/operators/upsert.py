"""Dimension and fact upserts as DataFrame algebra.

Plain Parquet has no row-level MERGE, so each upsert computes the next full
table from the stored one and the batch: anti joins find conflicts, stored
keys are carried over for matches, and only new rows get keys (U4). The
result is written to a new version folder by the caller (see
``starload.sources.warehouse``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions import dimension_text, iso_week, month_start, season_of_month
from starload.functions.patterns import FACT_GRAIN, FACT_MEASURES
from starload.operators.keys import assign_keys, max_key


def dimension_values(batch: DataFrame, col: str, out: str) -> DataFrame:
    """Distinct cleaned values of one batch column."""
    v = dimension_text(col)
    return batch.select(v.alias(out)).filter(F.col(out).isNotNull()).distinct()


def _start(stored: DataFrame, key_col: str, start: int | None) -> int:
    return max_key(stored, key_col) if start is None else start


def upsert_text_dimension(
    stored: DataFrame, values: DataFrame, key_col: str, val_col: str, start: int | None = None
) -> DataFrame:
    """Insert values that are not stored yet; stored keys never change.

    ``start`` is the largest stored key when the caller knows it (0 for a
    table that does not exist yet); otherwise it is read from ``stored``.
    """
    new = values.select(val_col).join(stored.select(val_col), val_col, "left_anti")
    keyed = assign_keys(new, [val_col], key_col, start=_start(stored, key_col, start))
    return stored.select(key_col, val_col).unionByName(keyed.select(key_col, val_col))


def text_dimension_rows(
    batch: DataFrame,
    spec: Mapping[str, tuple[str, str, str]],
    stored: Mapping[str, DataFrame],
    starts: Mapping[str, int],
    path: str | None = None,
    stored_empty: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """U1 for several text dimensions in one plan: (stored, new) ``dim, key, value`` rows.

    ``spec`` maps a batch column to (dimension, key column, value column).
    The cleaned values of all columns are tagged with their dimension and
    de-duplicated in one shuffle, new values are found with one anti join
    against all stored values, ranked together in (dimension, value) order (in
    ``path``), and a dimension's keys are its ranks less those of the dimensions before
    it (one row for each dimension) plus its largest stored key. Where the anti join
    finds nothing there is nothing to rank, and ``new`` is None. When the caller knows
    that nothing is stored, every value is new.
    """
    tagged = F.array(
        *[F.struct(F.lit(d).alias("dim"), dimension_text(c).alias("value")) for c, (d, _, _) in spec.items()]
    )
    values = batch.select(F.explode(tagged).alias("t")).select("t.*").filter(F.col("value").isNotNull()).distinct()
    known = None
    for d, key, val in spec.values():
        part = stored[d].select(F.lit(d).alias("dim"), F.col(key).cast("long").alias("key"), F.col(val).alias("value"))
        known = part if known is None else known.unionByName(part)
    unknown = values if stored_empty else values.join(known.select("dim", "value"), ["dim", "value"], "left_anti")
    if not stored_empty and unknown.isEmpty():
        return known, None
    ranked = assign_keys(unknown, ["dim", "value"], "rank", path=path)
    first = {r.dim: r.least for r in ranked.groupBy("dim").agg(F.min("rank").alias("least")).collect()}  # a row for each dimension
    pairs = [x for d, _, _ in spec.values() for x in (F.lit(d), F.lit(int(starts.get(d, 0)) - first.get(d, 1) + 1).cast("long"))]
    shift = F.element_at(F.create_map(*pairs), F.col("dim"))
    return known, ranked.select("dim", (F.col("rank") + shift).alias("key"), "value")


def dimension_from_rows(rows: DataFrame, dim: str, key_col: str, val_col: str) -> DataFrame:
    """One dimension's (key, value) columns out of ``text_dimension_rows``."""
    return rows.filter(F.col("dim") == dim).select(F.col("key").alias(key_col), F.col("value").alias(val_col))


def date_rows(pairs: DataFrame, year: str = "year", month: str = "month") -> DataFrame:
    """One date-dimension row per distinct complete (year, month)."""
    ym = pairs.select(F.col(year).cast("int").alias("jahr"), F.col(month).cast("int").alias("monat"))
    ym = ym.filter(F.col("jahr").isNotNull() & F.col("monat").isNotNull()).distinct()
    d = month_start("jahr", "monat")
    return ym.select(
        d.alias("datum"),
        "jahr",
        "monat",
        iso_week(d).alias("woche"),
        season_of_month("monat").alias("saison"),
    )


_DATE_ATTRS = ("jahr", "monat", "woche", "saison")


def upsert_date_dimension(
    stored: DataFrame, batch_rows: DataFrame, start: int | None = None, path: str | None = None, stored_empty: bool = False
) -> DataFrame:
    """Update attributes of stored dates, keep their keys, add new dates.

    Only dates that are not stored are ranked (in ``path``); where there is none,
    nothing is."""
    b = batch_rows.select("datum", *[F.col(a).alias(f"_b_{a}") for a in _DATE_ATTRS])
    updated = stored.join(b, "datum", "left").select(
        "datum_key", "datum", *[F.coalesce(F.col(f"_b_{a}"), F.col(a)).alias(a) for a in _DATE_ATTRS]
    )
    cols = ["datum_key", "datum", *_DATE_ATTRS]
    new = batch_rows if stored_empty else batch_rows.join(stored.select("datum"), "datum", "left_anti")
    if not stored_empty and new.isEmpty():
        return updated.select(*cols)
    keyed = assign_keys(new, ["datum"], "datum_key", start=_start(stored, "datum_key", start), path=path)
    return keyed.select(*cols) if stored_empty else updated.select(*cols).unionByName(keyed.select(*cols))


def resolve_keys(
    merged: DataFrame,
    date_map: DataFrame,
    text_maps: Mapping[str, tuple[DataFrame, str, str]],
) -> DataFrame:
    """Surrogate-key lookup (J4, S6, S7): a miss leaves the key NULL.

    ``text_maps`` maps a batch column to (dimension, key column, value
    column). Dimensions are small materialised tables, so Spark broadcasts
    them when their file size is under the broadcast threshold and falls
    back to a sort-merge join otherwise.
    """
    out = merged.join(
        date_map.select("datum_key", F.col("jahr").alias("year"), F.col("monat").alias("month")),
        ["year", "month"],
        "left",
    )
    for col, (dim, key, val) in text_maps.items():
        out = out.join(dim.select(key, F.col(val).alias(col)), col, "left")
    return out


def all_resolved(keys: Sequence[str] = FACT_GRAIN):
    """Whether every key of a row was found."""
    ok = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return ok


def split_rejects(keyed: DataFrame, keys: Sequence[str] = FACT_GRAIN) -> tuple[DataFrame, DataFrame]:
    """Rows with every key resolved, and the rejected rest."""
    ok = all_resolved(keys)
    return keyed.filter(ok), keyed.filter(~ok)


def merge_facts(
    stored: DataFrame,
    batch: DataFrame,
    grain: Sequence[str] = FACT_GRAIN,
    measures: Sequence[str] = FACT_MEASURES,
    key_col: str = "fakt_key",
    start: int | None = None,
    stored_empty: bool = False,
    path: str | None = None,
) -> DataFrame:
    """Grain upsert (U3): batch rows overwrite all measures (NULL included), new grains
    get keys, stored rows absent from the batch stay.

    Grains that are not stored are ranked first (in ``path``; skipped where there is
    none). Then stored rows, batch rows and new keys meet in one grouped aggregate on
    the grain, the only shuffle of the stored table. It also counts the stored and the
    batch rows of each grain, so that a grain that stands twice in either is seen while
    the result is written (columns ``_stored``, ``_batch``). When the caller knows
    the stored table is empty (a first load), every batch row is new, keys are
    all there is to do, and the counts are 0 and 1 (V12 is the caller's check).
    """
    cols = [key_col, *grain, *measures]
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    if stored_empty:
        keyed = assign_keys(batch.select(*grain, *measures), list(grain), key_col, start=start or 0, path=path)
        return keyed.select(*cols, zero.alias("_stored"), one.alias("_batch"))
    new = batch.select(*grain).join(stored.select(*grain), list(grain), "left_anti")
    none = F.lit(None).cast("long").alias(key_col)
    rows = stored.select(*cols, F.lit(0).alias("_from")).unionByName(batch.select(none, *grain, *measures, F.lit(1).alias("_from")))
    if not new.isEmpty():
        keyed = assign_keys(new, list(grain), key_col, start=_start(stored, key_col, start), path=path)
        blank = [F.lit(None).cast(batch.schema[m].dataType).alias(m) for m in measures]
        rows = rows.unionByName(keyed.select(key_col, *grain, *blank, F.lit(-1).alias("_from")))
    return rows.groupBy(*grain).agg(
        F.max(key_col).alias(key_col),
        *[F.max_by(m, "_from").alias(m) for m in measures],
        F.count_if(F.col("_from") == 0).alias("_stored"),
        F.count_if(F.col("_from") == 1).alias("_batch"),
    ).select(*cols, "_stored", "_batch")


def upsert_facts(stored: DataFrame, batch: DataFrame, **options) -> DataFrame:
    """The rows of ``merge_facts`` without its counts."""
    return merge_facts(stored, batch, **options).drop("_stored", "_batch")
