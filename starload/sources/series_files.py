"""Monthly series files: ``;``-separated tables with a free preamble.

Each file is read whole (one row per file, parallel over files), split into
lines, and the header line is located inside the row with higher-order array
functions, so header detection, column lookup by name and the format checks
(V3, V4) need no join and no shuffle. Data lines are exploded and parsed
with the tolerant casts (C5-C7) and rows missing a key or value are dropped
(F2). The only shuffle is the keep-last de-duplication (A5), a partial
aggregate with ``max_by`` that stays balanced even if one key is hot.

Limit: a single file is one row, so one file must fit a task (the monthly
files are kilobytes).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions import decimal_comma, strip_text, to_double, to_int_key
from starload.functions.patterns import (
    LINE_BREAK,
    SERIES_HEADER_PREFIX,
    SERIES_MONTH_COL,
    SERIES_REGION_COL,
    SERIES_SEP,
    SERIES_YEAR_COL,
)
from starload.sources.paths import read_input


def read_series_files(spark: SparkSession, path_glob: str | list[str]) -> DataFrame:
    """One row per file: ``file`` (full path) and ``text``."""
    paths = [path_glob] if isinstance(path_glob, str) else list(path_glob)
    df = read_input(lambda: spark.read.text(paths, wholetext=True), str(path_glob), "series files")
    return df.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def _header_index(lines: Column) -> Column:
    """1-based index of the first line whose stripped text starts the header; 0 if none."""
    flags = F.transform(lines, lambda x: strip_text(x).startswith(SERIES_HEADER_PREFIX))
    return F.array_position(flags, True).cast("int")


def _header_names(lines: Column, idx: Column) -> Column:
    header_line = F.when(idx > 0, F.element_at(lines, idx))
    return F.transform(F.split(header_line, SERIES_SEP), lambda x: strip_text(x))


def _with_layout(files: DataFrame, region: str) -> DataFrame:
    lines = F.split(F.col("text"), LINE_BREAK)
    return (
        files.select("file", lines.alias("lines"))
        .withColumn("hdr", _header_index(F.col("lines")))
        .withColumn("names", _header_names(F.col("lines"), F.col("hdr")))
        .withColumn("pos_year", F.array_position("names", SERIES_YEAR_COL).cast("int"))
        .withColumn("pos_month", F.array_position("names", SERIES_MONTH_COL).cast("int"))
        .withColumn("pos_value", F.array_position("names", region).cast("int"))
    )


def series_format_problems(files: DataFrame, region: str = SERIES_REGION_COL) -> DataFrame:
    """Files without a header line (V3) or without the region column (V4)."""
    lay = _with_layout(files, region)
    problem = (
        F.when(F.col("hdr") == 0, F.lit("header not found"))
        .when(F.col("pos_value") == 0, F.lit(f"column {region} not found"))
    )
    return lay.select("file", problem.alias("problem")).filter(F.col("problem").isNotNull())


def parse_series(files: DataFrame, value_col: str, region: str = SERIES_REGION_COL) -> DataFrame:
    """Data rows of every file: ``file, n, year, month, <value_col>``.

    A file without header or region column fails the job with a message
    naming the file, like the source pipeline.
    """
    lay = _with_layout(files, region)
    hdr_err = F.raise_error(F.concat(F.lit(f"header '{SERIES_HEADER_PREFIX}' not found in "), F.col("file")))
    reg_err = F.raise_error(F.concat(F.lit(f"column '{region}' not found in "), F.col("file")))
    checked = lay.select(
        "file",
        "lines",
        F.when(F.col("hdr") == 0, hdr_err.cast("int")).otherwise(F.col("hdr")).alias("hdr"),
        "pos_year",
        "pos_month",
        F.when(F.col("pos_value") == 0, reg_err.cast("int")).otherwise(F.col("pos_value")).alias("pos_value"),
    )
    rows = checked.select(
        "file", "hdr", "pos_year", "pos_month", "pos_value", F.posexplode("lines").alias("n", "line")
    ).filter((F.col("n") >= F.col("hdr")) & (strip_text("line") != ""))
    fields = F.split(F.col("line"), SERIES_SEP)

    def field(pos: str) -> Column:
        return F.when(F.col(pos) > 0, F.try_element_at(fields, F.col(pos)))

    parsed = rows.select(
        "file",
        F.col("n").cast("int").alias("n"),
        to_int_key(field("pos_year"), "year").alias("year"),
        to_int_key(field("pos_month"), "month").alias("month"),
        to_double(decimal_comma(field("pos_value"))).alias(value_col),
    )
    return parsed.dropna(subset=["year", "month", value_col])


def keep_last(parsed: DataFrame, value_cols: list[str], keys=("year", "month")) -> DataFrame:
    """Per key keep the row that comes last by file name, then line (A5).

    ``max_by`` over (file, n) is a partial aggregate: each task pre-reduces
    its rows before the shuffle, so a key with many repeats costs no more
    than one row per task.
    """
    order = F.struct("file", "n")
    aggs = [F.max_by(c, order).alias(c) for c in value_cols]
    return parsed.groupBy(*keys).agg(*aggs)


def load_series(spark: SparkSession, path_glob: str, value_col: str, region: str = SERIES_REGION_COL) -> DataFrame:
    """One monthly series, de-duplicated: ``year, month, <value_col>``."""
    files = read_series_files(spark, path_glob)
    return keep_last(parse_series(files, value_col, region), [value_col])


def series_long(spark: SparkSession, globs: Mapping[str, str], region: str = SERIES_REGION_COL) -> DataFrame:
    """The data rows of several series one behind the other (X1): ``series, file, n,
    year, month, value``; nothing is lost or merged."""
    parts = [
        parse_series(read_series_files(spark, glob), "value", region).withColumn("series", F.lit(name))
        for name, glob in globs.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def load_weather(spark: SparkSession, globs: Mapping[str, str], region: str = SERIES_REGION_COL) -> DataFrame:
    """Several series de-duplicated and inner-joined on (year, month).

    All files go through one union of narrow scans and one aggregate: per
    (year, month) each series keeps its last value, and only months present
    in every series survive -- the result of two inner joins without the
    joins' shuffles.
    """
    names = list(globs)
    long = series_long(spark, globs, region)
    order = F.struct("file", "n")
    aggs = [
        F.max_by(F.when(F.col("series") == n, F.col("value")), F.when(F.col("series") == n, order)).alias(n)
        for n in names
    ]
    wide = long.groupBy("year", "month").agg(*aggs)
    return wide.dropna(subset=names)


def inner_join_series(frames: list[DataFrame], keys=("year", "month")) -> DataFrame:
    """Inner equi-join of series that already exist as separate frames."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, list(keys), "inner")
    return out
