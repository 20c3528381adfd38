"""Star-schema storage: table schemas (S8), table scans (S6, S7), the
all-or-nothing publish of a load (U5) and the removal of what no kept version needs.

Tables are Parquet directories. A load writes every changed table to a folder of
its own, ``v<n>-<attempt>/<table>``, beside the current one (nothing is ever
overwritten, so a retry or a second writer never mixes files with another) and
then puts one commit record, the file ``_commits/commit-<n>.json``, in a single step
that fails where the file exists: of two loads that start from the same version one
fails with ``CommitConflict`` and publishes nothing, and a load that dies at any
moment leaves nothing that a reader sees or that blocks the next load. Readers take
the highest committed version. All paths may name any file system that Spark opens.

The fact table lies in folders by year and, where a load touched only some months of a
stored year, by month. The record says for each folder which months it holds and
which of them a younger folder has replaced. A load opens only the folders that its batch
can touch, writes the touched months, and carries everything else forward by path,
without reading or copying it; replaced rows are passed over when the folder is read.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starload.sources.storage import Storage

# --- fixed values: warehouse table layouts -----------------------------------
TABLE_SCHEMAS = {
    "dim_syndrom": "syndrom_key long, bezeichnung string",
    "dim_edtype": "edtype_key long, typ string",
    "dim_altersgruppe": "altersgruppe_key long, altersgruppe string",
    "dim_datum": "datum_key long, datum date, jahr int, monat int, woche int, saison string",
    "fakt_erkrankungen": (
        "fakt_key long, datum_key long, syndrom_key long, altersgruppe_key long, edtype_key long, "
        "relative_cases double, relative_cases_7day_ma double, expected_value double, "
        "expected_lowerbound double, expected_upperbound double, ed_count double, "
        "temperature_mean double, precipitation double, sunshine_duration double"
    ),
}
# Text dimensions: table -> (key column, value column)
TEXT_DIMENSIONS = {
    "dim_syndrom": ("syndrom_key", "bezeichnung"),
    "dim_altersgruppe": ("altersgruppe_key", "altersgruppe"),
    "dim_edtype": ("edtype_key", "typ"),
}

# Columns that the fact table's folders are named by, outermost first; month 0: a whole year
FACT_PARTITION = ("jahr", "monat")
WHOLE_YEAR = 0
# Partitioned table -> the column whose values a folder holds
HELD_COLUMN = {"fakt_erkrankungen": "datum_key"}

COMMITS = "_commits"
HINT = "newest"  # version of a recent commit; only saves a listing
KEY_SCRATCH = "_keys"  # ranked rows of a load, of no use once it is published
DEAD_AFTER_S = 24 * 3600
FILE_ROWS = 4_000_000  # rows of one partition value that one task writes


def empty_table(spark: SparkSession, ddl: str) -> DataFrame:
    """An empty table with a fixed schema that the optimizer knows is empty,
    so joins and unions with it are simplified away at planning time."""
    cols = [c.split(" ", 1) for c in ddl.split(", ")]
    return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in cols])


class CommitConflict(RuntimeError):
    """Another writer has published, or is publishing, the same version."""


@dataclass(frozen=True)
class Attempt:
    """One load's try at a version, with a folder that no other try uses."""

    version: int
    folder: str


def entry_values(entry: str) -> tuple[int, ...]:
    """Partition values that an entry ``table/col=value/...`` names, outermost first."""
    return tuple(int(p.split("=", 1)[1]) for p in entry.split("/")[1:])


@dataclass(frozen=True)
class Manifest:
    """One committed version: table (or table partition) paths and the largest
    surrogate key of every table, recorded at commit so no load has to scan a
    table for it. ``held`` and ``hidden`` say for a partition's entry which values of the
    table's ``HELD_COLUMN`` its files have, and which of them count no more."""

    version: int = 0
    tables: Mapping[str, str] = field(default_factory=dict)
    max_keys: Mapping[str, int] = field(default_factory=dict)
    held: Mapping[str, list[int]] = field(default_factory=dict)
    hidden: Mapping[str, list[int]] = field(default_factory=dict)

    def partitions(self, name: str) -> dict[str, str]:
        """Entries ``name/col=value/...`` of a partitioned table with their paths."""
        return {k: v for k, v in sorted(self.tables.items()) if k.startswith(name + "/")}

    def paths(self, name: str) -> list[str]:
        return [self.tables[name]] if name in self.tables else list(self.partitions(name).values())

    def has(self, name: str) -> bool:
        return bool(self.paths(name))

    def max_key(self, name: str) -> int:
        return int(self.max_keys.get(name, 0))


def dimension_map(dim: DataFrame, name: str) -> DataFrame:
    """(key, value) pairs of a stored text dimension."""
    return dim.select(*TEXT_DIMENSIONS[name])


def date_map(dim_datum: DataFrame) -> DataFrame:
    """(datum_key, jahr, monat) of the stored date dimension."""
    return dim_datum.select("datum_key", "jahr", "monat")


class Warehouse:
    """A versioned set of tables with fixed schemas below one root folder."""

    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, str] = TABLE_SCHEMAS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = dict(schemas)
        self.storage = Storage(spark)

    # -- reading -------------------------------------------------------------
    def _record_path(self, version: int) -> str:
        return f"{self.root}/{COMMITS}/commit-{version:08d}.json"

    def commits(self) -> dict[int, str]:
        """Version and record path of every commit, by listing names.

        Earlier releases wrote a record as a folder with one file in it; a folder
        without one is what a writer of theirs left when it died, and counts as nothing.
        """
        out = {}
        for e in self.storage.entries(f"{self.root}/{COMMITS}"):
            m = re.fullmatch(r"commit-(\d+)(\.json)?", e.name)
            if m and not e.folder and m[2]:
                out[int(m[1])] = f"{self.root}/{COMMITS}/{e.name}"
            elif m and e.folder and int(m[1]) not in out:
                inside = [x.name for x in self.storage.entries(f"{self.root}/{COMMITS}/{e.name}")]
                if parts := [n for n in inside if n.startswith("part-") and n.endswith(".json")]:
                    out[int(m[1])] = f"{self.root}/{COMMITS}/{e.name}/{parts[0]}"
        return out

    def _newest(self) -> str | None:
        """Path of the newest commit record: from the hinted version onwards, one look for
        each version since; a listing where there is no hint."""
        hint = self.storage.read(f"{self.root}/{COMMITS}/{HINT}") or ""
        if hint.strip().isdigit() and self.storage.exists(self._record_path(int(hint))):
            n = int(hint)
            while self.storage.exists(self._record_path(n + 1)):
                n += 1
            return self._record_path(n)
        found = self.commits()
        return found[max(found)] if found else None

    def _read_record(self, path: str) -> dict | None:
        text = self.storage.read(path)
        return None if text is None else json.loads(text)

    def manifest(self, version: int | None = None) -> Manifest:
        """A committed version (default: the newest); version 0 (no tables) when nothing is published."""
        path = self._newest() if version is None else self.commits().get(version)
        row = self._read_record(path) if path else None
        if row is None:
            if version:
                raise KeyError(f"version {version} is not among the commits of {self.root}")
            return Manifest()
        return Manifest(int(row["version"]), *[row.get(k) or {} for k in ("tables", "max_keys", "held", "hidden")])

    def current_version(self) -> int:
        return self.manifest().version

    def table(self, name: str, manifest: Manifest | None = None, entries: Iterable[str] | None = None) -> DataFrame:
        """Stored table of the current version; empty with the fixed schema if absent.

        For a partitioned table ``entries`` selects partitions by path, so the others are
        never listed or scanned. Rows that a younger partition replaced are left out.
        """
        man = manifest if manifest is not None else self.manifest()
        if name in man.tables:
            plain, masked = [man.tables[name]], {}
        else:
            found = man.partitions(name)
            found = found if entries is None else {k: found[k] for k in entries}
            masked = {k: v for k, v in found.items() if man.hidden.get(k)}
            plain = [v for k, v in found.items() if k not in masked]
        parts = [self.spark.read.schema(self.schemas[name]).parquet(*p) for p in (plain, list(masked.values())) if p]
        if masked:  # a value lies in one partition of those that overlap, so one filter serves all
            parts[-1] = parts[-1].where(~F.col(HELD_COLUMN[name]).isin(sorted({x for k in masked for x in man.hidden[k]})))
        if not parts:
            return empty_table(self.spark, self.schemas[name])
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return out.select(*self._columns(name))

    # -- writing -------------------------------------------------------------
    def attempt(self, manifest: Manifest) -> Attempt:
        """A new try at the version behind the manifest's."""
        version = manifest.version + 1
        return Attempt(version, f"{self.root}/v{version:08d}-{uuid.uuid4().hex[:12]}")

    def staged_path(self, attempt: Attempt, name: str) -> str:
        return f"{attempt.folder}/{name}"

    def key_scratch(self, attempt: Attempt, name: str) -> str:
        """A folder for the ranked rows of one table; goes when the load is published."""
        return f"{attempt.folder}/{KEY_SCRATCH}/{name}"

    def _columns(self, name: str) -> list[str]:
        return [c.split()[0] for c in self.schemas[name].split(", ")]

    def _write(self, df: DataFrame, path: str, metrics: Mapping[str, Column], partition_by: Sequence[str] = ()) -> dict:
        """Write; the metrics are observed during the write (no extra job)."""
        obs = None
        if metrics:
            obs = Observation(f"written-{uuid.uuid4().hex}")
            df = df.observe(obs, *[m.alias(n) for n, m in metrics.items()])
        w = df.drop(*[c for c in df.columns if c.startswith("_")]).write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        return {k: int(v) for k, v in obs.get.items() if v is not None} if obs else {}

    def stage(self, attempt: Attempt, name: str, df: DataFrame, key_col: str | None = None) -> tuple[DataFrame, int | None]:
        """Write one table of an unpublished version; return it read back and its largest key."""
        path = self.staged_path(attempt, name)
        seen = self._write(df.select(*self._columns(name)), path, {"max_key": F.max(key_col)} if key_col else {})
        return self.spark.read.schema(self.schemas[name]).parquet(path), seen.get("max_key")

    def stage_partitions(
        self,
        attempt: Attempt,
        name: str,
        df: DataFrame,
        part_cols: Sequence[str],
        metrics: Mapping[str, Column] | None = None,
        counts: Mapping[tuple, int] | None = None,
        spread_by: Sequence[str] = (),
    ) -> dict:
        """Write the given rows partitioned by ``part_cols`` (only the partitions present)
        and return the metrics, which may use further columns named ``_...``.

        Rows are brought together by partition value, so that a value gets few files and
        the values are written side by side. ``counts`` says about how many rows the
        large values have: one of more than ``FILE_ROWS`` rows is dealt to as many tasks
        (and files) as it holds that number, by a hash of ``spread_by``.
        """
        path = self.staged_path(attempt, name)
        own = [*self._columns(name), *part_cols]
        rows = df.select(*own, *[c for c in df.columns if c.startswith("_")])
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        large = {v: -(-n // FILE_ROWS) for v, n in (counts or {}).items() if n > FILE_ROWS}
        share = F.lit(1)
        for v, n in large.items():
            share = F.when(_all(F.col(c).eqNullSafe(x) for c, x in zip(part_cols, v, strict=True)), n).otherwise(share)
        salt = [F.pmod(F.xxhash64(*spread_by), share)] if large else []
        return self._write(rows.repartition(tasks, *part_cols, *salt), path, metrics or {}, part_cols)

    def partition_entries(self, attempt: Attempt, name: str, part_cols: Sequence[str], values: Iterable[Sequence]) -> dict[str, str]:
        """Entries of the partitions that ``stage_partitions`` wrote, and their paths."""
        folders = ["/".join(f"{c}={x}" for c, x in zip(part_cols, v, strict=True)) for v in values]
        return {f"{name}/{f}": f"{self.staged_path(attempt, name)}/{f}" for f in folders}

    def commit(
        self,
        attempt: Attempt,
        staged: Mapping[str, str],
        carried: Mapping[str, str] | None = None,
        max_keys: Mapping[str, int] | None = None,
        held: Mapping[str, list[int]] | None = None,
        hidden: Mapping[str, list[int]] | None = None,
    ) -> int:
        """Publish a version: one small commit record put last, never over another."""
        tables = {**(carried or {}), **staged}
        record = {
            "version": attempt.version,
            "attempt": attempt.folder,
            "tables": tables,
            "max_keys": {k: int(v) for k, v in (max_keys or {}).items()},
            "held": {k: sorted(v) for k, v in (held or {}).items() if k in tables},
            "hidden": {k: sorted(v) for k, v in (hidden or {}).items() if k in tables and v},
        }
        path = self._record_path(attempt.version)
        taken = not self.storage.put_new(path, json.dumps(record, sort_keys=True))
        if taken and (self._read_record(path) or {}).get("attempt") != attempt.folder:
            raise CommitConflict(f"version {attempt.version} is taken by another load ({path})")
        try:
            self.storage.write(f"{self.root}/{COMMITS}/{HINT}", str(attempt.version))
            self.storage.delete(f"{attempt.folder}/{KEY_SCRATCH}")
        except Exception:  # noqa: BLE001 - the version is published; the next load or clean-up sees to these
            pass
        return attempt.version

    def discard(self, attempt: Attempt) -> None:
        """Remove what a refused try has written."""
        self.storage.delete(attempt.folder)

    # -- retention -----------------------------------------------------------
    def clean(self, keep: int = 2, dead_after_s: float = DEAD_AFTER_S) -> list[str]:
        """Remove the files that none of the newest ``keep`` versions needs; return what went.

        A path goes if no kept record names it, one above it or one below it. Folders of
        tries that were never published, and drafts of records, go when nothing in them
        changed for ``dead_after_s`` seconds: a younger one may be a load at work. Records
        of older versions go last, so a clean-up that dies is taken up by the next one.
        """
        if keep < 1:
            raise ValueError("the newest version is always kept")
        records = self.commits()
        newest = sorted(records)[-keep:]
        kept = {_plain(p) for v in newest for p in self.manifest(v).tables.values()}
        published = {_plain(r["attempt"]) for r in map(self._read_record, records.values()) if r and r.get("attempt")}
        above = {_up(p, n) for p in kept for n in range(1, p.count("/"))}
        limit = (time.time() - dead_after_s) * 1000
        gone: list[str] = []

        def prune(path: str) -> None:
            if _plain(path) in kept:
                return
            if _plain(path) not in above:
                self.storage.delete(path)
                gone.append(path)
                return
            for e in self.storage.entries(path):
                if e.folder:
                    prune(f"{path}/{e.name}")

        for e in self.storage.entries(self.root):
            path = f"{self.root}/{e.name}"
            if not (e.folder and re.fullmatch(r"v\d{8}-[0-9a-f]{12}", e.name)):
                continue
            tried = _plain(path) not in published and _plain(path) not in above
            if not tried or self._last_change(path, e.modified) < limit:
                prune(path)
        for e in self.storage.entries(f"{self.root}/{COMMITS}"):
            if e.name.startswith(".commit-") and e.modified < limit:
                self.storage.delete(f"{self.root}/{COMMITS}/{e.name}")
                gone.append(f"{self.root}/{COMMITS}/{e.name}")
        for v in sorted(set(records) - set(newest)):
            folder = records[v].rsplit("/", 1)[0] if "/part-" in records[v] else records[v]
            self.storage.delete(folder)
            gone.append(folder)
        return gone

    def _last_change(self, path: str, modified: int) -> int:
        """Latest change of a folder or anything in it."""
        for e in self.storage.entries(path):
            modified = max(modified, self._last_change(f"{path}/{e.name}", e.modified) if e.folder else e.modified)
        return modified

    def describe(self) -> str:
        m = self.manifest()
        return json.dumps({"version": m.version, "tables": dict(m.tables), "max_keys": dict(m.max_keys)}, sort_keys=True)


def _all(conditions: Iterable[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _plain(path: str) -> str:
    """A path without scheme and authority, to compare paths that were written either way."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/")


def _up(path: str, n: int) -> str:
    return path.rsplit("/", n)[0]
