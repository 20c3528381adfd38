"""Daily surveillance series: tab-separated text with a header.

Columns are located by header name (all read as text, no inference; a file
with another header or a line with surplus fields fails the read), the reader's missing tokens become NULL (C12), then the date is parsed (C8) and
the measures are converted tolerantly (C6). Everything stays one narrow
scan stage: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from starload.functions import na_token_to_null, parse_date, to_double
from starload.functions.patterns import DAILY_COLUMNS, DAILY_KEYS, DAILY_MEASURES
from starload.operators.quality import columns_checked
from starload.sources.paths import read_headed_text


def read_daily_text(spark: SparkSession, path: str | list[str], further: Sequence[Column] = ()) -> DataFrame:
    """All columns as text, bound by each file's own header line; ``further`` columns
    may be of the file's ``_metadata``."""
    return read_headed_text(spark, path, "daily series", "\t", further)


def clean_daily(raw: DataFrame, further: Sequence[str] = ()) -> DataFrame:
    """Typed daily frame: date, 3 text keys, 6 double measures, and ``further`` columns as they are.

    No missing token spells a number, so the measures need no token test.
    """
    columns_checked(raw, DAILY_COLUMNS, "daily series")
    cols = [parse_date(na_token_to_null("date")).alias("date")]
    cols += [na_token_to_null(k).alias(k) for k in DAILY_KEYS]
    cols += [to_double(m).alias(m) for m in DAILY_MEASURES]
    return raw.select(*cols, *further)


def read_daily_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Read and type the daily series from tab-separated files."""
    return clean_daily(read_daily_text(spark, path))


def write_daily_tsv(daily: DataFrame, path: str, null_token: str = "NA") -> None:
    """Write a daily frame in the source's tab-separated form (used by tests)."""
    (
        daily.select(*DAILY_COLUMNS)
        .write.mode("overwrite")
        .option("sep", "\t")
        .option("header", True)
        .option("nullValue", null_token)
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


__all__ = ["clean_daily", "read_daily_text", "read_daily_tsv", "write_daily_tsv"]
