"""Column-returning scalar functions (all built-in expressions)."""

from starload.functions.dates import (
    iso_week,
    month_of,
    month_start,
    parse_date,
    season_of_month,
    year_of,
)
from starload.functions.numeric import decimal_comma, nan_to_null, to_double, to_int_key
from starload.functions.text import (
    dimension_text,
    is_nan_text,
    na_token_to_null,
    strip_text,
    valid_dimension_text,
)

__all__ = [
    "decimal_comma",
    "dimension_text",
    "is_nan_text",
    "iso_week",
    "month_of",
    "month_start",
    "na_token_to_null",
    "nan_to_null",
    "parse_date",
    "season_of_month",
    "strip_text",
    "to_double",
    "to_int_key",
    "valid_dimension_text",
    "year_of",
]
