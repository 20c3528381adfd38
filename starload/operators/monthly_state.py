"""Monthly aggregate kept as mergeable state (A1, A2 without reading old files again).

For each daily file the state holds what the monthly aggregate needs of it: by group
the sums and counts of the measures and the least and greatest ``ed_count``. A ledger
says which files, in which size and of which change time, have been taken in. A refresh

* lists the files and compares them with the ledger by joins;
* aggregates only files that are new or changed, in one partial aggregate for each task;
* puts the new state rows beside the old ones and writes the ledger anew; both are
  published by one commit record, so a refresh that fails leaves the state as it was.

State rows count only if the ledger names their very file, size and change time: a
replaced or removed file is taken out by that join, without touching old state. The
monthly facts are one aggregate over the live state rows, whose number is that of groups
in files, not of daily rows. Sums of doubles are added file by file; where they are
exact (whole numbers, say) the result is that of the full aggregate to the last bit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions import month_of, nan_to_null, year_of
from starload.functions.patterns import DAILY_KEYS, DAILY_MEASURES, MONTHLY_KEYS
from starload.sources.daily_tsv import clean_daily, read_daily_text
from starload.sources.paths import read_input
from starload.sources.warehouse import Manifest, Warehouse

LEDGER, PARTS = "daily_files", "monthly_parts"
FILE = ("file", "length", "modified")
TAKE = "take"  # the state rows of one refresh
_FILE_TYPES = "file string, length long, modified timestamp"
STATE_SCHEMAS = {
    LEDGER: _FILE_TYPES,
    PARTS: ", ".join([
        _FILE_TYPES, "year int, month int", *[f"{k} string" for k in DAILY_KEYS],
        *[f"{m}_sum double, {m}_n long" for m in DAILY_MEASURES], "ed_count_min double, ed_count_max double",
    ]),
}


def _file_columns() -> list:
    m = F.col("_metadata")
    return [m["file_path"].alias("file"), m["file_size"].alias("length"), m["file_modification_time"].alias("modified")]


def listed(spark: SparkSession, path: str) -> DataFrame:
    """``file, length, modified, path`` of the daily files; names are listed, no file is opened."""
    files = read_input(lambda: spark.read.format("binaryFile").load(path), path, "daily series")
    return files.select(*_file_columns(), "path")


def partial_rows(daily: DataFrame) -> DataFrame:
    """State rows of daily rows that carry their file's columns."""
    base = daily.select(
        *FILE, year_of("date").alias("year"), month_of("date").alias("month"), *DAILY_KEYS,
        *[nan_to_null(F.col(m).cast("double")).alias(m) for m in DAILY_MEASURES],
    ).dropna(subset=list(MONTHLY_KEYS))
    aggs = [a for m in DAILY_MEASURES for a in (F.sum(m).alias(f"{m}_sum"), F.count(m).alias(f"{m}_n"))]
    aggs += [F.min("ed_count").alias("ed_count_min"), F.max("ed_count").alias("ed_count_max")]
    return base.groupBy(*FILE, *MONTHLY_KEYS).agg(*aggs)


def merged(parts: DataFrame) -> DataFrame:
    """Monthly facts of state rows, in the columns of ``monthly_aggregate``."""
    means = [(F.sum(f"{m}_sum") / F.nullif(F.sum(f"{m}_n"), F.lit(0))).alias(f"{m}_avg") for m in DAILY_MEASURES]
    ends = [F.min("ed_count_min").alias("ed_count_min"), F.max("ed_count_max").alias("ed_count_max")]
    return parts.groupBy(*MONTHLY_KEYS).agg(*means, *ends)


@dataclass(frozen=True)
class Taken:
    """What a refresh did: files it read, files it took out, files in the state."""

    version: int
    read: int
    removed: int
    files: int


class MonthlyState:
    """The state below a folder of its own."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.store = Warehouse(spark, root, STATE_SCHEMAS)

    def monthly(self, manifest: Manifest | None = None) -> DataFrame:
        """Monthly facts of all files in the ledger."""
        man = self.store.manifest() if manifest is None else manifest
        live = self.store.table(LEDGER, man)
        return merged(self.store.table(PARTS, man).join(live, list(FILE), "left_semi"))

    def refresh(self, path: str) -> Taken:
        """Bring the state up to the daily files at ``path`` and publish it.

        The paths of the files to read reach the driver: as many as have arrived since
        the last refresh. Another refresh that published meanwhile makes this one raise
        ``CommitConflict``. A file that changes while it is read is read again by the
        next refresh, as the ledger holds its state from before.
        """
        man = self.store.manifest()
        attempt = self.store.attempt(man)
        now, _ = self.store.stage(attempt, LEDGER, listed(self.spark, path).select(*FILE))
        known = self.store.table(LEDGER, man)
        # Both joins by the ledger's own listing: what arrives or changes from here on is not
        # of this refresh, neither its path nor its rows.
        fresh = listed(self.spark, path).join(now, list(FILE), "left_semi").join(known, list(FILE), "left_anti").select("path").distinct()
        paths = sorted(r.path for r in fresh.collect())
        removed = known.join(now, list(FILE), "left_anti").count()
        entries = {}
        if paths:
            text = read_daily_text(self.spark, paths, further=_file_columns())
            parts = partial_rows(clean_daily(text, further=FILE)).join(now, list(FILE), "left_semi").withColumn(TAKE, F.lit(attempt.version))
            self.store.stage_partitions(attempt, PARTS, parts, [TAKE])
            entry = self.store.partition_entries(attempt, PARTS, [TAKE], [(attempt.version,)])
            entries = {k: v for k, v in entry.items() if self.store.storage.exists(v)}  # no row had a complete key
        carried = man.partitions(PARTS)
        version = self.store.commit(attempt, {LEDGER: self.store.staged_path(attempt, LEDGER), **entries}, carried)
        return Taken(version, len(paths), removed, now.count())

    def compact(self) -> int:
        """Write the live state rows into one folder and drop the others from the state."""
        man = self.store.manifest()
        attempt = self.store.attempt(man)
        live = self.store.table(PARTS, man).join(self.store.table(LEDGER, man), list(FILE), "left_semi")
        self.store.stage_partitions(attempt, PARTS, live.withColumn(TAKE, F.lit(attempt.version)), [TAKE])
        entry = self.store.partition_entries(attempt, PARTS, [TAKE], [(attempt.version,)])
        entries = {k: v for k, v in entry.items() if self.store.storage.exists(v)}
        return self.store.commit(attempt, {LEDGER: man.tables[LEDGER], **entries} if LEDGER in man.tables else entries)
