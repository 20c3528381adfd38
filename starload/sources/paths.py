"""Input checks shared by the sources (V2)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starload.sources.storage import Storage


def read_input(make: Callable[[], DataFrame], path: str, what: str) -> DataFrame:
    """Run a reader; a missing path or an empty glob becomes FileNotFoundError."""
    try:
        return make()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"{what}: no input found at {path}") from e
        raise


def inputs_found(spark: SparkSession, paths: Mapping[str, str], what: str = "input", lines: bool = True) -> DataFrame:
    """Which expected inputs exist (V2): ``input, found, n_files, n_bytes`` and, on request, ``n_lines``.

    An input is found if its path or glob names a file, be it empty. That is answered by
    listing names; no file is opened. Lines are counted apart, by one text scan for each
    input that has bytes. An absent path or an empty glob is a row with ``found`` false.
    """
    storage = Storage(spark)
    out = None
    for name, path in sorted(paths.items()):
        files = storage.files(path)
        size = sum(f.size for f in files)
        seen = [F.lit(name).alias("input"), F.lit(bool(files)).alias("found"), F.lit(len(files)).cast("long").alias("n_files"), F.lit(size).cast("long").alias("n_bytes")]
        if not lines:
            row = spark.range(1).select(*seen)
        else:
            text = read_input(lambda p=path: spark.read.text(p), path, what) if size else spark.range(0)
            row = text.agg(F.count(F.lit(1)).alias("n_lines")).select(*seen, "n_lines")
        out = row if out is None else out.unionByName(row)
    return out


def required_inputs(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """Raise ``FileNotFoundError`` with every input that does not exist (V2), by listing names only."""
    storage = Storage(spark)
    absent = {name: path for name, path in sorted(paths.items()) if not storage.files(path)}
    if absent:
        raise FileNotFoundError("no input found at " + ", ".join(f"{path} ({name})" for name, path in absent.items()))


def read_headed_text(spark: SparkSession, path: str | list[str], what: str, sep: str, further: Sequence[Column] = ()) -> DataFrame:
    """Delimited files with a header line each, every column as text, and ``further`` columns.

    The column order is that of the header Spark meets first; a file whose header
    differs from it fails the read with that file's name (columns are never bound
    by position to another file's names). A line with more fields than the header
    fails too; missing trailing fields are NULL, as in the source's reader.
    """
    options = {"sep": sep, "header": True, "quote": '"', "escape": '"', "inferSchema": False}
    names = read_input(lambda: spark.read.options(**options).csv(path), path, what).columns
    broken = "_broken_line"
    schema = StructType([StructField(n, StringType()) for n in [*names, broken]])
    raw = (
        spark.read.options(**options)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", broken)
        .option("columnPruning", False)
        .schema(schema)
        .csv(path)
    )
    # Spark hands over lines with too few or too many fields; quoted parts do not count.
    plain = F.regexp_replace(broken, '"(""|[^"])*"', "")
    fields = F.length(plain) - F.length(F.replace(plain, F.lit(sep), F.lit(""))) + 1
    fault = F.raise_error(F.concat(F.lit(f"{what}: more than {len(names)} fields in "), F.input_file_name(), F.lit(": "), F.col(broken)))
    fits = F.when(F.col(broken).isNotNull() & (fields > len(names)), fault.cast("boolean")).otherwise(F.lit(True))
    return raw.where(fits).select(*[F.col(f"`{n}`") for n in names], *further)
