"""End-to-end refresh: the three steps of the source pipeline as one Spark
application.

* ``transform_daily``: daily tab-separated series -> monthly facts (S1, A1);
* ``transform_weather``: monthly series files -> one weather table (S2, S3, J2);
* ``load_processed``: both -> star schema, published atomically (U1-U6).

Each step can write its result as CSV (S4) for hand-over, as the source
pipeline does, or pass the DataFrame straight on (``refresh``), which lets
Spark plan the aggregate and the join together without the CSV round trip.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from starload.functions.patterns import MONTHLY_COLUMNS, SERIES_GLOBS, WEATHER_COLUMNS
from starload.operators.monthly import monthly_aggregate
from starload.operators.monthly_state import MonthlyState
from starload.plans.load import LoadResult, load_frames
from starload.plans.marts import head_rows
from starload.sources.csv_io import read_csv_typed, write_csv
from starload.sources.daily_tsv import read_daily_tsv
from starload.sources.paths import required_inputs
from starload.sources.series_files import load_weather
from starload.sources.warehouse import Warehouse

# --- fixed values: sub-folders of the raw landing area ---------------------
SERIES_FOLDERS = {
    "temperature_mean": "air_temperature_mean",
    "precipitation": "precipitation",
    "sunshine_duration": "sunshine_duration",
}


def weather_globs(series_root: str, folders: Mapping[str, str] = SERIES_FOLDERS) -> dict[str, str]:
    root = series_root.rstrip("/")
    return {v: f"{root}/{folders[v]}/{SERIES_GLOBS[v]}" for v in SERIES_GLOBS}


def transform_daily(spark: SparkSession, daily_path: str, out_csv: str | None = None) -> DataFrame:
    monthly = monthly_aggregate(read_daily_tsv(spark, daily_path))
    if out_csv:
        write_csv(monthly.orderBy(*MONTHLY_COLUMNS[:5]), out_csv)
    return monthly


def series_summary(series: DataFrame) -> DataFrame:
    """Rows and year range of a monthly series (A6), one row."""
    return series.agg(F.count(F.lit(1)).alias("n_rows"), F.min("year").alias("min_year"), F.max("year").alias("max_year"))


@dataclass
class WeatherRun:
    """What the weather step built: the table, its summary (A6) and its first months."""

    weather: DataFrame
    summary: Row
    preview: list[Row]


def transform_weather(spark: SparkSession, globs: Mapping[str, str], out_csv: str | None = None) -> WeatherRun:
    """Monthly series files to one weather table, in month order (O1) when written."""
    weather = load_weather(spark, globs)
    if out_csv:
        write_csv(weather.orderBy("year", "month"), out_csv)
        weather = read_weather(spark, out_csv)
    return WeatherRun(weather, series_summary(weather).first(), head_rows(weather, ["year", "month"], 5).collect())


def read_weather(spark: SparkSession, weather_csv: str) -> DataFrame:
    types = {c: "double" for c in WEATHER_COLUMNS}
    types.update(year="int", month="int")
    return read_csv_typed(spark, weather_csv, types, "monthly weather csv")


def read_processed(spark: SparkSession, monthly_csv: str, weather_csv: str) -> tuple[DataFrame, DataFrame]:
    m_types = {c: "double" for c in MONTHLY_COLUMNS}
    m_types.update(year="int", month="int", syndrome="string", age_group="string", ed_type="string")
    return read_csv_typed(spark, monthly_csv, m_types, "monthly facts csv"), read_weather(spark, weather_csv)


def load_processed(spark: SparkSession, monthly_csv: str, weather_csv: str, warehouse_root: str) -> LoadResult:
    monthly, weather = read_processed(spark, monthly_csv, weather_csv)
    return load_frames(spark, Warehouse(spark, warehouse_root), monthly, weather)


def refresh(
    spark: SparkSession, daily_path: str, globs: Mapping[str, str], warehouse_root: str, state_root: str | None = None
) -> LoadResult:
    """Transform and load in one plan, without the CSV hand-over.

    With ``state_root`` the monthly aggregate is kept there, and only daily files that
    are new or have changed since the last refresh are read.
    """
    required_inputs(spark, {"daily series": daily_path, **globs})
    if state_root:
        state = MonthlyState(spark, state_root)
        state.refresh(daily_path)
        monthly = state.monthly()
    else:
        monthly = transform_daily(spark, daily_path)
    weather = load_weather(spark, globs)
    return load_frames(spark, Warehouse(spark, warehouse_root), monthly, weather)
