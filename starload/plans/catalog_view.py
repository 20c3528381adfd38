"""The flat view in the session catalog (S9): it lasts and is seen by every session.

``publish_view`` registers the tables of the newest commit under names that carry their
version and then replaces the view in one statement, so a query sees one version whole.
Nothing is copied: tables and fact partitions point to the published folders. With a
persistent catalog (a Hive metastore) the view serves other applications too; Spark's
in-memory catalog serves the sessions of one application.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from starload.plans.marts import DIMENSION_KEYS, FLAT_ATTRIBUTES, FLAT_COLUMNS, FLAT_VIEW_NAME
from starload.sources.warehouse import FACT_PARTITION, HELD_COLUMN, TABLE_SCHEMAS, WHOLE_YEAR, Manifest, Warehouse, entry_values

DATABASE = "bi"
FACTS = "fakt_erkrankungen"
PER_STATEMENT = 200


def _name(*parts: str) -> str:
    return ".".join(f"`{p}`" for p in parts)


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _versioned(table: str, version: int) -> str:
    return f"{table}__v{version}"


def _register_tables(spark: SparkSession, wh: Warehouse, man: Manifest, database: str) -> None:
    for table in DIMENSION_KEYS:
        at = man.paths(table)[0]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(database, _versioned(table, man.version))} ({TABLE_SCHEMAS[table]}) USING parquet LOCATION {_text(at)}")
    facts = _name(database, _versioned(FACTS, man.version))
    folders = ", ".join(f"{c} int" for c in FACT_PARTITION)
    home = f"{wh.root}/_catalog/{_versioned(FACTS, man.version)}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {facts} ({TABLE_SCHEMAS[FACTS]}, {folders}) USING parquet"
        f" PARTITIONED BY ({', '.join(FACT_PARTITION)}) LOCATION {_text(home)}"
    )
    specs = []
    for entry, path in man.partitions(FACTS).items():
        values = (*entry_values(entry), WHOLE_YEAR)[: len(FACT_PARTITION)]  # an entry without a month is a whole year
        specs.append(f"PARTITION ({', '.join(f'{c} = {v}' for c, v in zip(FACT_PARTITION, values, strict=True))}) LOCATION {_text(path)}")
    for i in range(0, len(specs), PER_STATEMENT):
        spark.sql(f"ALTER TABLE {facts} ADD IF NOT EXISTS {' '.join(specs[i : i + PER_STATEMENT])}")


def view_sql(database: str, man: Manifest) -> str:
    """The flat view's query over one version's tables, from the same metadata as
    ``flat_view``; months that a younger partition replaced are left out."""
    version = man.version
    columns = []
    for c in FLAT_COLUMNS:
        if c in FLAT_ATTRIBUTES:
            table, col = FLAT_ATTRIBUTES[c]
            columns.append(f"{_name(table, col)} AS {c}")
        elif c == "month_date":
            columns.append(f"make_date({_name('dim_datum', 'jahr')}, {_name('dim_datum', 'monat')}, 1) AS {c}")
        else:
            columns.append(f"{_name(FACTS, c)} AS {c}")
    joins = [
        f"JOIN {_name(database, _versioned(t, version))} AS {_name(t)} ON {_name(FACTS, key)} = {_name(t, key)}" for t, key in DIMENSION_KEYS.items()
    ]
    query = f"SELECT {', '.join(columns)} FROM {_name(database, _versioned(FACTS, version))} AS {_name(FACTS)} {' '.join(joins)}"
    gone = sorted({k for keys in man.hidden.values() for k in keys})
    if gone:
        held = ", ".join(str(int(k)) for k in gone)
        query += f" WHERE NOT ({_name(FACTS, 'monat')} = {WHOLE_YEAR} AND {_name(FACTS, HELD_COLUMN[FACTS])} IN ({held}))"
    return query


def publish_view(wh: Warehouse, database: str = DATABASE, keep: int = 2) -> int:
    """Point the view at the newest commit; return its version.

    Tables of the newest ``keep`` versions stay registered, so queries that began before
    the change can end. If a load commits meanwhile, the view follows it.
    """
    spark = wh.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)} LOCATION {_text(wh.root + '/_catalog')}")
    while True:
        man = wh.manifest()
        if not man.version:
            raise LookupError(f"nothing is published in {wh.root}")
        _register_tables(spark, wh, man, database)
        spark.sql(f"CREATE OR REPLACE VIEW {_name(database, FLAT_VIEW_NAME)} AS {view_sql(database, man)}")
        if wh.current_version() == man.version:
            break
    tables = [r.tableName for r in spark.sql(f"SHOW TABLES IN {_name(database)}").collect()]
    dated = {t: int(m[1]) for t in tables if (m := re.fullmatch(r".+__v(\d+)", t))}
    kept = sorted(set(dated.values()))[-keep:]
    for t, v in dated.items():
        if v not in kept:
            spark.sql(f"DROP TABLE IF EXISTS {_name(database, t)}")
    return man.version
