"""Fixed values the rebuild must share with the source pipeline.

Everything in this module is a constant that decides results (text
patterns, token lists, season names, column names). They are kept
together, in natural order, so they can be read and checked at a glance.
"""

# --- fixed values: text patterns ------------------------------------------

# Line breaks of a whole-file text, as Python's ``str.splitlines()`` sees them.
LINE_BREAK = r"\r\n|[\n\x0b\f\r\x1c\x1d\x1e\x85\u2028\u2029]"

# Leading/trailing whitespace as Python's ``str.strip()`` sees it: Unicode
# white space plus the ASCII separators 0x1c-0x1f.
EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"

# What ``pandas.to_numeric`` accepts as a float: optional sign, digits with an
# optional point (or a leading point), optional exponent, or inf/infinity;
# surrounding white space allowed. ``nan``, ``1d``, ``0x10``, ``1_000`` and
# non-ASCII digits do not match.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"

# The numbers without exponent of at most 300 digits before the point: none overflows.
PLAIN_NUMBER = r"^\s*[+-]?(\d{1,300}(\.\d*)?|\.\d+)\s*$"

# Calendar date as the sources spell it.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"

# Text that spells an infinity (used to tell an overflow from a literal).
INF_LITERAL = r"(?i)^\s*[+-]?inf(inity)?\s*$"

# --- fixed values: missing-value tokens of the tab-separated reader --------
# The default list of the pandas 2.x CSV reader (the empty string included).
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# --- fixed values: seasons by calendar month --------------------------------
SEASON_WINTER = "Winter"      # months 12, 1, 2
SEASON_SPRING = "Frühling"    # months 3, 4, 5
SEASON_SUMMER = "Sommer"      # months 6, 7, 8
SEASON_AUTUMN = "Herbst"      # every other month
WINTER_MONTHS = (12, 1, 2)
SPRING_MONTHS = (3, 4, 5)
SUMMER_MONTHS = (6, 7, 8)

# --- fixed values: monthly series file format --------------------------------
SERIES_HEADER_PREFIX = "Jahr;Monat"
SERIES_SEP = ";"
SERIES_YEAR_COL = "Jahr"
SERIES_MONTH_COL = "Monat"
SERIES_REGION_COL = "Deutschland"
# File-name globs of the three monthly series, one file per calendar month.
SERIES_GLOBS = {
    "temperature_mean": "regional_averages_tm_*.txt",
    "precipitation": "regional_averages_rr_*.txt",
    "sunshine_duration": "regional_averages_sd_*.txt",
}

# --- fixed values: column sets ----------------------------------------------
DAILY_KEYS = ("syndrome", "age_group", "ed_type")
DAILY_MEASURES = (
    "relative_cases",
    "relative_cases_7day_ma",
    "expected_value",
    "expected_lowerbound",
    "expected_upperbound",
    "ed_count",
)
DAILY_COLUMNS = ("date",) + DAILY_KEYS + DAILY_MEASURES
MONTHLY_KEYS = ("year", "month") + DAILY_KEYS
MONTHLY_COLUMNS = MONTHLY_KEYS + (
    "relative_cases_avg",
    "relative_cases_7day_ma_avg",
    "expected_value_avg",
    "expected_lowerbound_avg",
    "expected_upperbound_avg",
    "ed_count_avg",
    "ed_count_min",
    "ed_count_max",
)
WEATHER_MEASURES = ("temperature_mean", "precipitation", "sunshine_duration")
WEATHER_COLUMNS = ("year", "month") + WEATHER_MEASURES
FACT_GRAIN = ("datum_key", "syndrom_key", "altersgruppe_key", "edtype_key")
FACT_MEASURES = (
    "relative_cases",
    "relative_cases_7day_ma",
    "expected_value",
    "expected_lowerbound",
    "expected_upperbound",
    "ed_count",
    "temperature_mean",
    "precipitation",
    "sunshine_duration",
)
