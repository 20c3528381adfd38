"""Domain roles played by the driver's benchmark tables.

The domain inputs (a daily surveillance series and monthly weather series)
are not among the driver tables, so the tables are mapped onto the roles
with deterministic expressions that an SQL oracle can repeat exactly:

* daily series = ``lineitem`` joined with ``part``: ship date as the day,
  ``p_type`` as syndrome, ``l_returnflag`` as age group, ``l_linestatus``
  as department type, whole-number measures (discount and tax in percent,
  quantity and quantity -/+ line number, line number as department count);
* missing values are injected the way the real series has them: the moving
  average is missing on line 1, the expected values on line 2, one syndrome
  has no measures at all in March, and the syndrome key is missing for
  orders whose key is a multiple of 101 (so those rows form no group);
* monthly series = ``orders`` by order month: means of whole-number
  expressions, so sums are exact and every engine gets the same doubles.

All measures are whole numbers per row, so averages do not depend on the
summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.patterns import SERIES_REGION_COL

# --- fixed values of the role mapping (shared with the SQL oracles) --------
GAP_SYNDROME = "PROMO"   # syndrome with no measures ...
GAP_MONTH = 3            # ... in this calendar month
NULL_KEY_EVERY = 101     # syndrome missing when l_orderkey is a multiple of this
SERIES_CODES = {"temperature_mean": "tm", "precipitation": "rr", "sunshine_duration": "sd"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pct(c: str) -> Column:
    # whole percent; + 0.0 turns a negative zero into zero
    return F.rint(F.col(c) * 100) + F.lit(0.0)


def daily_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed daily series (date, 3 keys, 6 double measures)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    j = li.join(part, li["l_partkey"] == part["p_partkey"], "inner")
    gap = (F.col("p_type") == GAP_SYNDROME) & (F.month("l_shipdate") == GAP_MONTH)
    line1 = F.col("l_linenumber") == 1
    line2 = F.col("l_linenumber") == 2
    qty = F.col("l_quantity").cast("double")
    ln = F.col("l_linenumber").cast("double")
    return j.select(
        F.to_date("l_shipdate").alias("date"),
        F.when(F.col("l_orderkey") % NULL_KEY_EVERY != 0, F.col("p_type")).alias("syndrome"),
        F.col("l_returnflag").alias("age_group"),
        F.col("l_linestatus").alias("ed_type"),
        F.when(~gap, _pct("l_discount")).alias("relative_cases"),
        F.when(~gap & ~line1, _pct("l_tax")).alias("relative_cases_7day_ma"),
        F.when(~gap & ~line2, qty).alias("expected_value"),
        F.when(~gap & ~line2, qty - ln).alias("expected_lowerbound"),
        F.when(~gap & ~line2, qty + ln).alias("expected_upperbound"),
        ln.alias("ed_count"),
    )


def series_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: year, month and the three whole-number series values."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    m = F.month("o_orderdate")
    return o.select(
        F.year("o_orderdate").cast("int").alias("year"),
        m.cast("int").alias("month"),
        ((F.col("o_custkey") % 10) + 2 * m - 10).cast("double").alias("temperature_mean"),
        ((F.col("o_orderkey") % 60) + 3 * m).cast("double").alias("precipitation"),
        ((F.col("o_orderkey") % 100) + 15 * m).cast("double").alias("sunshine_duration"),
    )


def series_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly series: year, month, temperature_mean, precipitation, sunshine_duration."""
    v = series_values(spark, sf_dir)
    return v.groupBy("year", "month").agg(
        F.avg("temperature_mean").alias("temperature_mean"),
        F.avg("precipitation").alias("precipitation"),
        F.avg("sunshine_duration").alias("sunshine_duration"),
    )


def series_file_text(series: DataFrame, value_col: str, stale_every: int = 2) -> DataFrame:
    """One row per calendar month with the text of its series file.

    Layout like the published monthly files: a preamble line, a header with
    a second region column and a trailing ``;``, decimal commas, and two
    kinds of noise that the reader must survive: a stale earlier line for
    every ``stale_every``-th year (the later line must win) and a line with
    an empty value (dropped). The lines of one file are one calendar month
    over all years, so a file's size is bounded by the year range.
    """
    val = F.replace(F.col(value_col).cast("string"), F.lit("."), F.lit(","))
    mm = F.lpad(F.col("month").cast("string"), 2, "0")
    good = F.concat_ws(";", F.col("year").cast("string"), mm, F.lit("0"), val, F.lit(""))
    stale = F.concat_ws(";", F.col("year").cast("string"), mm, F.lit("0"), F.lit("-999,5"), F.lit(""))
    lines = series.select(
        "month",
        F.struct(F.col("year"), F.lit(1).alias("k"), good.alias("line")).alias("g"),
        F.when(F.col("year") % stale_every == 0, F.struct(F.col("year"), F.lit(0).alias("k"), stale.alias("line"))).alias("s"),
    )
    per_line = lines.select("month", F.explode(F.array("g", "s")).alias("l")).filter(F.col("l").isNotNull())
    body = per_line.groupBy("month").agg(F.array_sort(F.collect_list("l")).alias("ls"))
    header = f"Jahr;Monat;Bayern;{SERIES_REGION_COL};"
    text = F.concat_ws(
        "\n",
        F.lit("Monatswerte (generated from the order table)"),
        F.lit(header),
        F.concat(F.lit("1800;"), mm, F.lit(";;;")),
        F.concat_ws("\n", F.transform("ls", lambda x: x["line"])),
    )
    return body.select(F.col("month").alias("file_month"), F.concat(text, F.lit("\n")).alias("text"))


def write_series_files(series: DataFrame, root: str, value_col: str, leave_out_months=()) -> str:
    """Write one text file per calendar month below ``root``; returns the glob."""
    files = series_file_text(series, value_col)
    if leave_out_months:
        files = files.filter(~F.col("file_month").isin(*leave_out_months))
    files = files.select(F.lpad(F.col("file_month").cast("string"), 2, "0").alias("file_month"), "text")
    files.write.mode("overwrite").partitionBy("file_month").text(root)
    return f"{root.rstrip('/')}/file_month=*/*.txt"


def write_series_family(series: DataFrame, root: str, value_cols, leave_out_months=()) -> dict[str, str]:
    """Write the files of several series in one job: ``root/series=<col>/file_month=<mm>/``.

    Returns one glob per series.
    """
    files = None
    for c in value_cols:
        f = series_file_text(series, c).withColumn("series", F.lit(c))
        files = f if files is None else files.unionByName(f)
    if leave_out_months:
        files = files.filter(~F.col("file_month").isin(*leave_out_months))
    files = files.select("series", F.lpad(F.col("file_month").cast("string"), 2, "0").alias("file_month"), "text")
    files.write.mode("overwrite").partitionBy("series", "file_month").text(root)
    return {c: f"{root.rstrip('/')}/series={c}/file_month=*/*.txt" for c in value_cols}
