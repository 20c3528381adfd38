"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BYTES = 2 << 20
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_import(spark: SparkSession) -> None:
    """Let Python workers started from this session import the package, and bound
    the Arrow batches they get.

    On a cluster the package is shipped with ``--py-files``; the path covers local
    sessions that were started from another folder. A batch holds ``ARROW_BYTES`` or
    one long row, not 10,000 rows of any length; a smaller limit of the session stays.
    """
    limit = spark.conf.get(ARROW_LIMIT, "67108864b").removesuffix("b")
    if not limit.isdigit() or int(limit) > ARROW_BYTES:
        spark.conf.set(ARROW_LIMIT, str(ARROW_BYTES))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        env["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts the lineage,
    fixes the rows once and for all and gives the planner a true size."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(c: str = "text"):
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def texts(column: pa.Array) -> tuple[memoryview, list[int]]:
    """UTF-8 bytes and offsets of an Arrow string column (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = memoryview(offsets).cast("q")[column.offset : column.offset + len(column) + 1] if offsets else [0]
    return memoryview(data) if data is not None else memoryview(b""), at


def runs(offsets, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``most`` bytes; a longer row stands alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = lo + 1
        while hi < n and offsets[hi + 1] - offsets[lo] <= most:
            hi += 1
        yield lo, hi
        lo = hi


def with_columns(batch: pa.RecordBatch, new: dict[str, pa.Array], keep: Iterable[str] | None = None) -> pa.RecordBatch:
    """The batch's columns with ``new`` ones behind; a new one replaces its namesake."""
    names = [c for c in (batch.schema.names if keep is None else keep) if c not in new]
    cols = [batch.column(batch.schema.get_field_index(c)) for c in names] + list(new.values())
    return pa.RecordBatch.from_arrays(cols, names=names + list(new))


def added(df: DataFrame, new: dict[str, str]) -> str:
    """Schema of ``with_columns``' batches as DDL."""
    from pyspark.sql.types import StructType

    kept = StructType([f for f in df.schema.fields if f.name not in new])
    ddl = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.fields]
    return ", ".join(ddl + [f"`{k}` {v}" for k, v in new.items()])


def keyed_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of a stream sorted by ``keys``; holds one group at a time."""
    have: list[pa.RecordBatch] = []
    now: tuple | None = None
    for b in batches:
        cols = [b.column(b.schema.get_field_index(k)).to_pylist() for k in keys]
        lo = 0
        ids = list(zip(*cols, strict=True))
        for i, k in enumerate(ids):
            if now is None:
                now = k
            elif k != now:
                if i > lo:
                    have.append(b.slice(lo, i - lo))
                yield now, pa.Table.from_batches(have)
                have, now, lo = [], k, i
        if lo < b.num_rows:
            have.append(b.slice(lo))
    if now is not None:
        yield now, pa.Table.from_batches(have)
