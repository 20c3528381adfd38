"""Landed-file completeness (S10, re-aimed from the downloaders).

The source pipeline downloads one file per calendar month and variable. Here
the files are read where they landed: a ``binaryFile`` listing that selects
only path and length (the content column is pruned, no bytes are read), the
month taken from the path, and every expected month reported with its file
count and size -- a month with no file shows ``n_files = 0``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: month number in a landed file's path --------------------
MONTH_IN_NAME = r"_(\d{2})\.txt$"


def landing_manifest(
    spark: SparkSession,
    globs: Mapping[str, str],
    month_pattern: str = MONTH_IN_NAME,
) -> DataFrame:
    """``variable, month, n_files, bytes`` for months 1..12 of every variable."""
    listed = None
    for var, glob in globs.items():
        try:
            part = spark.read.format("binaryFile").load(glob).select("path", "length")
        except Exception as e:  # an empty glob means no file for any month
            if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
                raise
            part = spark.createDataFrame([], "path string, length long")
        part = part.select(
            F.lit(var).alias("variable"),
            F.regexp_extract("path", month_pattern, 1).alias("m"),
            "length",
        )
        listed = part if listed is None else listed.unionByName(part)
    found = (
        listed.filter(F.col("m") != "")
        .groupBy("variable", F.col("m").cast("int").alias("month"))
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"))
    )
    # 12 months per variable: a fixed, tiny grid (variables x 12 rows).
    grid = spark.range(1).select(
        F.explode(F.array(*[F.lit(v) for v in globs])).alias("variable"),
    ).select("variable", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    return grid.join(found, ["variable", "month"], "left").select(
        "variable",
        "month",
        F.coalesce("n_files", F.lit(0)).cast("long").alias("n_files"),
        F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"),
    )
