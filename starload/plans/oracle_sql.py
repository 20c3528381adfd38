"""DuckDB SQL that computes, from the driver tables, what each registered query
must return. The common table expressions repeat the role mapping of
``starload.plans.roles`` in SQL.
"""

from __future__ import annotations

DAILY = """
daily AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date,
         CASE WHEN l.l_orderkey % 101 <> 0 THEN p.p_type END AS syndrome,
         l.l_returnflag AS age_group,
         l.l_linestatus AS ed_type,
         CASE WHEN NOT (p.p_type = 'PROMO' AND month(l.l_shipdate) = 3)
              THEN round(l.l_discount * 100) + 0.0 END AS relative_cases,
         CASE WHEN NOT (p.p_type = 'PROMO' AND month(l.l_shipdate) = 3) AND l.l_linenumber <> 1
              THEN round(l.l_tax * 100) + 0.0 END AS relative_cases_7day_ma,
         CASE WHEN NOT (p.p_type = 'PROMO' AND month(l.l_shipdate) = 3) AND l.l_linenumber <> 2
              THEN CAST(l.l_quantity AS DOUBLE) END AS expected_value,
         CASE WHEN NOT (p.p_type = 'PROMO' AND month(l.l_shipdate) = 3) AND l.l_linenumber <> 2
              THEN CAST(l.l_quantity AS DOUBLE) - CAST(l.l_linenumber AS DOUBLE) END AS expected_lowerbound,
         CASE WHEN NOT (p.p_type = 'PROMO' AND month(l.l_shipdate) = 3) AND l.l_linenumber <> 2
              THEN CAST(l.l_quantity AS DOUBLE) + CAST(l.l_linenumber AS DOUBLE) END AS expected_upperbound,
         CAST(l.l_linenumber AS DOUBLE) AS ed_count
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""

MONTHLY = """
monthly AS (
  SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         syndrome, age_group, ed_type,
         avg(relative_cases) AS relative_cases_avg,
         avg(relative_cases_7day_ma) AS relative_cases_7day_ma_avg,
         avg(expected_value) AS expected_value_avg,
         avg(expected_lowerbound) AS expected_lowerbound_avg,
         avg(expected_upperbound) AS expected_upperbound_avg,
         avg(ed_count) AS ed_count_avg,
         min(ed_count) AS ed_count_min,
         max(ed_count) AS ed_count_max
  FROM daily
  WHERE date IS NOT NULL AND syndrome IS NOT NULL AND age_group IS NOT NULL AND ed_type IS NOT NULL
  GROUP BY 1, 2, 3, 4, 5
)"""

SERIES_VALUES = """
series_values AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         CAST(o_custkey % 10 + 2 * month(o_orderdate) - 10 AS DOUBLE) AS temperature_mean,
         CAST(o_orderkey % 60 + 3 * month(o_orderdate) AS DOUBLE) AS precipitation,
         CAST(o_orderkey % 100 + 15 * month(o_orderdate) AS DOUBLE) AS sunshine_duration
  FROM orders
)"""

SERIES = SERIES_VALUES + """,
series AS (
  SELECT year, month, avg(temperature_mean) AS temperature_mean, avg(precipitation) AS precipitation,
         avg(sunshine_duration) AS sunshine_duration
  FROM series_values GROUP BY 1, 2
)"""

MERGED = """
merged AS (
  SELECT m.*, s.temperature_mean, s.precipitation, s.sunshine_duration
  FROM monthly m LEFT JOIN series s ON m.year = s.year AND m.month = s.month
)"""

SEASON = """CASE WHEN {m} IN (12, 1, 2) THEN 'Winter' WHEN {m} IN (3, 4, 5) THEN 'Frühling'
     WHEN {m} IN (6, 7, 8) THEN 'Sommer' ELSE 'Herbst' END"""

FLAT = """
flat AS (
  SELECT year, month, """ + SEASON.format(m="month") + """ AS season,
         syndrome, age_group, ed_type,
         relative_cases_avg AS relative_cases, relative_cases_7day_ma_avg AS relative_cases_7day_ma,
         expected_value_avg AS expected_value, expected_lowerbound_avg AS expected_lowerbound,
         expected_upperbound_avg AS expected_upperbound, ed_count_avg AS ed_count,
         temperature_mean, precipitation, sunshine_duration,
         make_date(year, month, 1) AS month_date
  FROM merged
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = with_(DAILY, MONTHLY)
BASE_MERGED = with_(DAILY, MONTHLY, SERIES, MERGED)
BASE_FLAT = with_(DAILY, MONTHLY, SERIES, MERGED, FLAT)


def class_sql(by: str, limits, labels) -> str:
    case = "CASE " + " ".join(f"WHEN {by} < {lim} THEN '{lab}'" for lim, lab in zip(limits, labels))
    case += f" ELSE '{labels[-1]}' END"
    return BASE_FLAT + f"""
SELECT {by}_class, syndrome, round(avg(relative_cases), 6) AS avg_relative_cases,
       count(relative_cases) AS n_months
FROM (SELECT {case} AS {by}_class, syndrome, relative_cases FROM flat WHERE {by} IS NOT NULL)
GROUP BY 1, 2"""


def keys_sql(frame: str, first_load: str) -> str:
    """Surrogate keys of ``frame``'s rows as ``keyed``: rows for which ``first_load``
    holds were loaded before the others; values and grains get keys in value order,
    those new to the second load behind those of the first."""
    stage = f"CASE WHEN {first_load} THEN 0 ELSE 1 END"
    dims = {"syndrom_key": "syndrome", "altersgruppe_key": "age_group", "edtype_key": "ed_type", "datum_key": "year, month"}
    ctes = [
        f"""
{key}s AS (SELECT {cols}, CAST(row_number() OVER (ORDER BY stage, {cols}) AS BIGINT) AS {key}
  FROM (SELECT {cols}, min({stage}) AS stage FROM {frame} GROUP BY {cols}))"""
        for key, cols in dims.items()
    ]
    joins = " ".join(f"JOIN {key}s USING ({cols})" for key, cols in dims.items())
    order = "datum_key, syndrom_key, altersgruppe_key, edtype_key"
    return "," + ",".join(ctes) + f""",
numbered AS (SELECT f.*, {stage} AS stage, {order} FROM {frame} f {joins}),
keyed AS (SELECT *, CAST(row_number() OVER (ORDER BY stage, {order}) AS BIGINT) AS fakt_key FROM numbered)
"""
