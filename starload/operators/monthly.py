"""Daily series to month grain.

One grouped aggregate over (year, month, syndrome, age group, department
type). Spark plans it as partial aggregation in every scan task followed by
one shuffle of at most (groups x tasks) rows, so a hot group never lands
whole in one task. NaN is turned into NULL first so that averages skip it,
rows with a missing group key form no group, and an all-missing group keeps
its row with NULL averages (no imputation anywhere).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions import month_of, nan_to_null, year_of
from starload.functions.patterns import DAILY_KEYS, DAILY_MEASURES, MONTHLY_KEYS


def monthly_aggregate(daily: DataFrame) -> DataFrame:
    """``year, month, syndrome, age_group, ed_type`` + 6 means, min and max of ``ed_count``."""
    base = daily.select(
        year_of("date").alias("year"),
        month_of("date").alias("month"),
        *[F.col(k) for k in DAILY_KEYS],
        *[nan_to_null(F.col(m).cast("double")).alias(m) for m in DAILY_MEASURES],
    ).dropna(subset=list(MONTHLY_KEYS))
    aggs = [F.avg(m).alias(f"{m}_avg") for m in DAILY_MEASURES]
    aggs += [F.min("ed_count").alias("ed_count_min"), F.max("ed_count").alias("ed_count_max")]
    return base.groupBy(*MONTHLY_KEYS).agg(*aggs)
