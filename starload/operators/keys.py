"""Dense surrogate keys in value order (U4).

A window without partition key would move every row into one task. Here the rows are
written once, range-partitioned and sorted on the order columns, and read back: a row's
key is its number in its file (``_metadata.row_index``) behind the rows of the files
before it,

    key = start + rows in earlier files + row number in the file + 1

The rows of each file are counted by the write itself (observed, no further job), so
ranking costs the sample that finds the ranges and the write, whatever the size, and the
keyed rows are a plain scan however often they are used. The number of partitions is
Spark's (adaptive execution joins small ones). The files stand in a shared folder, so
keys cannot change on a recomputation after a lost executor. One count for each file
reaches the driver: that is bounded by the partition count, not by the data. One method
serves every input size.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starload.session import scratch_path

MOST_PARTITIONS = 100_000  # more would be counted by approximation
_PART = r"part-(\d+)-"


def assign_keys(
    df: DataFrame, order_by: Sequence[str], key_col: str, start: int = 0, num_partitions: int | None = None, path: str | None = None
) -> DataFrame:
    """Add ``key_col`` = start + 1, start + 2, ... in ascending ``order_by`` order.

    ``order_by`` should be unique (dimension values, a fact grain); ties get
    distinct keys in an unspecified order. The ranked rows are written to ``path``, a
    folder that does not exist yet (default: one below the session's checkpoint folder).
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "keys")
    ranged = df.repartitionByRange(num_partitions, *order_by) if num_partitions else df.repartitionByRange(*order_by)
    counted = Observation(f"rows-{uuid.uuid4().hex}")
    # A histogram with a bin for each value is their exact count.
    numbered = ranged.sortWithinPartitions(*order_by).withColumn("_pid", F.spark_partition_id())
    numbered = numbered.observe(counted, F.histogram_numeric("_pid", F.lit(MOST_PARTITIONS)).alias("rows")).drop("_pid")
    numbered.write.option("maxRecordsPerFile", 0).parquet(path)
    rows = sorted((int(r["x"]), int(r["y"])) for r in counted.get["rows"] or [])
    before = dict(zip([p for p, _ in rows], accumulate((n for _, n in rows), initial=0)))
    ranked = spark.read.schema(df.schema).parquet(path).select(
        "*", F.regexp_extract(F.col("_metadata.file_name"), _PART, 1).cast("int").alias("_pid"), F.col("_metadata.row_index").alias("_pos")
    )
    base = F.element_at(F.map_from_arrays(F.array(*[F.lit(p) for p in before]), F.array(*[F.lit(n) for n in before.values()])), F.col("_pid")) if before else F.lit(0)
    return ranked.withColumn(key_col, (F.lit(start) + base + F.col("_pos") + F.lit(1)).cast("long")).drop("_pid", "_pos")


def max_key(df: DataFrame, key_col: str) -> int:
    """Largest stored key (0 for an empty table): one scalar to the driver."""
    v = df.agg(F.max(key_col)).first()[0]
    return int(v) if v is not None else 0
