"""Data-quality checks.

Each check returns a DataFrame of violations (empty when the data is clean),
so it can be inspected, written or asserted. Only ``columns_checked`` works
on the schema alone; the rest are distributed aggregates or anti joins --
nothing is collected except, in ``assert_empty``, a handful of sample rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DataQualityError(ValueError):
    """A data-quality rule is violated."""


class ColumnsMissing(DataQualityError):
    """An input lacks columns; ``missing`` and ``found`` hold the names."""

    def __init__(self, source: str, missing: list[str], found: list[str]):
        super().__init__(f"{source}: no column {', '.join(missing)} among {', '.join(found) or 'none'}")
        self.source, self.missing, self.found = source, missing, found


class ConstraintViolation(DataQualityError):
    """A version of the star would break its constraints; ``violations`` holds a
    ``rule, subject, violations`` mapping for each broken one."""

    def __init__(self, violations: list[dict]):
        told = "; ".join(f"{v['rule']} {v['subject']}: {v['violations']}" for v in violations)
        super().__init__(f"nothing published, constraints broken: {told}")
        self.violations = violations


def columns_checked(df: DataFrame, wanted: Iterable[str], source: str) -> DataFrame:
    """The frame itself if it has the wanted columns (V1), else ``ColumnsMissing``."""
    absent = sorted(set(wanted).difference(df.columns))
    if absent:
        raise ColumnsMissing(source, absent, df.columns)
    return df


def column_coverage(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """For each wanted column how many rows have, lack or miss a value (V1, V7):
    ``column_name, present, n_rows, n_values``; an absent column has no values."""
    have = set(df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"v_{i}") for i, c in enumerate(wanted) if c in have])
    items = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit(c in have).alias("present"), F.col("n").alias("n_rows"),
            (F.col(f"v_{i}") if c in have else F.lit(0)).cast("long").alias("n_values"),
        )
        for i, c in enumerate(wanted)
    ]
    return counts.select(F.inline(F.array(*items)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def orphan_keys(fact: DataFrame, key: str, dim: DataFrame, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose foreign key finds no dimension row (V6)."""
    dim_key = dim_key or key
    d = dim.select(F.col(dim_key).alias(key)).distinct()
    return fact.join(d, key, "left_anti")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: ``<col>`` = number of NULLs per column, plus ``n_rows`` (V7, V9)."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    return df.agg(*aggs)


def out_of_range(df: DataFrame, cols: Sequence[str], low: float = 0.0, high: float = 100.0) -> DataFrame:
    """One row: per column, non-NULL values outside [low, high] (V8)."""
    aggs = [F.count_if(~F.col(c).between(low, high)).alias(c) for c in cols]
    return df.agg(*aggs)


def not_constant_within(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Keys whose columns take more than one value combination.

    The values are compared as a struct so that NULL fields count as a value.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count_distinct(F.struct(*cols)).alias("n_values"))
        .filter(F.col("n_values") > 1)
    )


def assert_empty(violations: DataFrame, message: str, sample: int = 5) -> None:
    """Raise DataQualityError with a few sample rows when violations exist."""
    rows = violations.limit(sample).collect()
    if rows:
        raise DataQualityError(f"{message}: {[r.asDict() for r in rows]}")


def _rows(counts: DataFrame, named: list[tuple[str, str, str]]) -> DataFrame:
    """One-row frame of counts -> rows of (rule, subject, violations)."""
    items = [
        F.struct(F.lit(rule).alias("rule"), F.lit(subject).alias("subject"), F.col(col).cast("long").alias("violations"))
        for rule, subject, col in named
    ]
    return counts.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def dimension_violations(spec: Mapping[str, tuple[DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """Broken rules of several dimensions as ``rule, subject, violations`` (V5, V7), in one aggregate.

    ``spec`` maps a dimension to (table, unique columns, other required columns).
    Unique columns may not be NULL either. No row means that every rule holds.
    """
    rows = None
    for name, (dim, unique, required) in spec.items():
        cells = [F.struct(F.lit(f"{name}.{c}").alias("subject"), F.lit(True).alias("one"), F.col(c).cast("string").alias("value")) for c in unique]
        missing = [F.struct(F.lit(f"{name}.{c}").alias("subject"), F.lit(False).alias("one"), F.when(F.col(c).isNotNull(), "").alias("value")) for c in required]
        part = dim.select(F.inline(F.array(*cells, *missing)))
        rows = part if rows is None else rows.unionByName(part)
    values = rows.groupBy("subject", "one", "value").agg(F.count(F.lit(1)).alias("n"))
    found = values.groupBy("subject").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("not_null"),
        F.count_if(F.col("one") & F.col("value").isNotNull() & (F.col("n") > 1)).alias("unique"),
    )
    return found.select("subject", F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("violations")) for r in ("not_null", "unique")]))).where(
        "violations > 0"
    ).select("rule", "subject", "violations").orderBy("subject", "rule")


def star_checks(
    fact: DataFrame,
    dims: dict[str, tuple[DataFrame, str, Sequence[str]]],
    grain: Sequence[str],
    percent_cols: Sequence[str] = (),
) -> DataFrame:
    """The star's integrity rules as one table of violation counts.

    ``dims`` maps a dimension name to (table, key column, natural-key
    columns). Rules: unique surrogate and natural keys per dimension (V5),
    every fact key found in its dimension (V6), unique fact grain (V5),
    NOT NULL fact keys (V7), percent measures within 0..100 (V8). One row per
    rule and subject; all counts are 0 for a consistent star.

    The fact table is read twice whatever the number of rules: once for the
    grain check (a grouped count) and once for everything else (left joins
    to the dimensions' key sets, which Spark broadcasts when small, then a
    single aggregate of conditional counts).
    """
    parts = []
    for name, (dim, key, natural) in dims.items():
        for cols in ([key], list(natural)):
            d = duplicate_keys(dim, cols).agg(F.count(F.lit(1)).alias("n"))
            parts.append(_rows(d, [("unique", f"{name}.{'+'.join(cols)}", "n")]))
    g = duplicate_keys(fact, list(grain)).agg(F.count(F.lit(1)).alias("n"))
    parts.append(_rows(g, [("unique", "fact." + "+".join(grain), "n")]))

    probe = fact
    aggs, named = [], []
    for i, (name, (dim, key, _)) in enumerate(dims.items()):
        marker = f"_found_{i}"
        probe = probe.join(dim.select(F.col(key), F.lit(True).alias(marker)).distinct(), key, "left")
        aggs.append(F.count_if(F.col(key).isNotNull() & F.col(marker).isNull()).alias(f"fk_{i}"))
        named.append(("foreign_key", f"{name}.{key}", f"fk_{i}"))
    for i, k in enumerate(grain):
        aggs.append(F.count_if(F.col(k).isNull()).alias(f"nn_{i}"))
        named.append(("not_null", f"fact.{k}", f"nn_{i}"))
    for i, c in enumerate(percent_cols):
        aggs.append(F.count_if(~F.col(c).between(0, 100)).alias(f"pr_{i}"))
        named.append(("percent_range", f"fact.{c}", f"pr_{i}"))
    parts.append(_rows(probe.agg(*aggs), named))

    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
