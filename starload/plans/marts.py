"""BI layer: the flattened star (J3, S9) and the dashboard aggregates.

The flat view inner-joins the fact table with its four dimensions on the
surrogate keys. Dimensions are small published Parquet tables, so Spark's
size check broadcasts them (no fact shuffle); the plan falls back to a
sort-merge join by itself if a dimension ever outgrows the threshold.
The dashboard aggregates select only what they need, so unused columns
are pruned from the fact scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.functions import month_start
from starload.functions.patterns import FACT_GRAIN
from starload.operators.quality import star_checks
from starload.sources.warehouse import TABLE_SCHEMAS, TEXT_DIMENSIONS, Warehouse

FLAT_VIEW_NAME = "vw_erkrankungen_monatlich"

FLAT_COLUMNS = (
    "year",
    "month",
    "season",
    "syndrome",
    "age_group",
    "ed_type",
    "relative_cases",
    "relative_cases_7day_ma",
    "expected_value",
    "expected_lowerbound",
    "expected_upperbound",
    "ed_count",
    "temperature_mean",
    "precipitation",
    "sunshine_duration",
    "month_date",
)

# --- our own class limits (not in the source; labelled as our choice) -------
# measure -> ascending upper limits and labels; a value below limits[i] gets
# labels[i], the rest the last label. NULL measures get no class.
DEFAULT_CLASSES = {
    "precipitation": ((40.0, 80.0), ("low", "medium", "high")),
    "temperature_mean": ((5.0, 15.0), ("cold", "mild", "warm")),
    "sunshine_duration": ((100.0, 200.0), ("low", "medium", "high")),
}


# Dimension attribute of the flat view -> (dimension table, its column)
FLAT_ATTRIBUTES = {
    "year": ("dim_datum", "jahr"),
    "month": ("dim_datum", "monat"),
    "season": ("dim_datum", "saison"),
    "syndrome": ("dim_syndrom", TEXT_DIMENSIONS["dim_syndrom"][1]),
    "age_group": ("dim_altersgruppe", TEXT_DIMENSIONS["dim_altersgruppe"][1]),
    "ed_type": ("dim_edtype", TEXT_DIMENSIONS["dim_edtype"][1]),
}
DIMENSION_KEYS = {"dim_datum": "datum_key", **{t: key for t, (key, _) in TEXT_DIMENSIONS.items()}}


def star_join(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The fact rows with the flat view's attributes beside their own columns."""
    out = tables["fakt_erkrankungen"]
    for name, key in DIMENSION_KEYS.items():
        named = {col: attr for attr, (t, col) in FLAT_ATTRIBUTES.items() if t == name}
        out = out.join(tables[name].select(key, *[F.col(c).alias(a) for c, a in named.items()]), key)
    return out.withColumn("month_date", month_start("year", "month"))


def flat_view(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Fact joined with its dimensions, English column names, month date."""
    return star_join(tables).select(*FLAT_COLUMNS)


def star_tables(wh: Warehouse) -> dict[str, DataFrame]:
    """The five tables of one published version."""
    man = wh.manifest()
    return {name: wh.table(name, man) for name in TABLE_SCHEMAS}


def warehouse_flat_view(wh: Warehouse, register: bool = True) -> DataFrame:
    """The flat view over the published tables, registered as a temp view."""
    df = flat_view(star_tables(wh))
    if register:
        df.createOrReplaceTempView(FLAT_VIEW_NAME)
    return df


def keyed_view(wh: Warehouse) -> DataFrame:
    """The flat view with the fact's and the dimensions' surrogate keys before it."""
    return star_join(star_tables(wh)).select("fakt_key", *DIMENSION_KEYS.values(), *FLAT_COLUMNS)


def seasonality(flat: DataFrame, measure: str = "relative_cases") -> DataFrame:
    """Mean relative frequency by season and syndrome."""
    return flat.groupBy("season", "syndrome").agg(
        F.avg(measure).alias(f"avg_{measure}"),
        F.count(measure).alias("n_months"),
    )


def class_of(c: Column | str, limits: Sequence[float], labels: Sequence[str]) -> Column:
    """Bucket a measure by ascending limits; NULL stays without class."""
    c = F.col(c) if isinstance(c, str) else c
    out = None
    for lim, lab in zip(limits, labels):
        out = F.when(c < F.lit(lim), F.lit(lab)) if out is None else out.when(c < F.lit(lim), F.lit(lab))
    return F.when(c.isNotNull(), out.otherwise(F.lit(labels[-1])))


def class_average(
    flat: DataFrame,
    by: str,
    limits: Sequence[float] | None = None,
    labels: Sequence[str] | None = None,
    measure: str = "relative_cases",
) -> DataFrame:
    """Mean relative frequency by weather class and syndrome."""
    if limits is None or labels is None:
        limits, labels = DEFAULT_CLASSES[by]
    cls = f"{by}_class"
    return (
        flat.select(class_of(by, limits, labels).alias(cls), "syndrome", measure)
        .filter(F.col(cls).isNotNull())
        .groupBy(cls, "syndrome")
        .agg(F.avg(measure).alias(f"avg_{measure}"), F.count(measure).alias("n_months"))
    )


def head_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First n rows by order (O4); planned as a top-n per task, not a full sort."""
    return df.orderBy(*order).limit(n)


def integrity_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Integrity rules of a star (V5-V8), one row per rule."""
    dims = {"dim_datum": (tables["dim_datum"], "datum_key", ("datum",))}
    dims |= {t: (tables[t], key, (val,)) for t, (key, val) in TEXT_DIMENSIONS.items()}
    return star_checks(
        tables["fakt_erkrankungen"], dims, list(FACT_GRAIN), percent_cols=("relative_cases", "relative_cases_7day_ma")
    )


def warehouse_checks(wh: Warehouse) -> DataFrame:
    """Integrity rules of the published star."""
    return integrity_checks(star_tables(wh))


def register_star(wh: Warehouse) -> DataFrame:
    """Register the five published tables and the flat view as temp views."""
    tables = star_tables(wh)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    flat = flat_view(tables)
    flat.createOrReplaceTempView(FLAT_VIEW_NAME)
    return flat


def report_tables(wh: Warehouse) -> dict[str, DataFrame]:
    """The dashboard aggregates (A8-A11) by name, in a fixed order of rows."""
    flat = warehouse_flat_view(wh)
    out = {"seasonality": seasonality(flat).orderBy("syndrome", "season")}
    for by in DEFAULT_CLASSES:
        out[f"class_{by}"] = class_average(flat, by).orderBy("syndrome", f"{by}_class")
    return out
