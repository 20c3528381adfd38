"""Text cleaning expressions (all JVM-side, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starload.functions.patterns import EDGE_SPACE, NA_TOKENS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c: Column | str) -> Column:
    """Trim all white space at both ends, as ``str.strip()`` does (C4).

    ``F.trim`` removes spaces only; tabs and other white space stay.
    """
    return F.regexp_replace(_col(c), EDGE_SPACE, "")


def na_token_to_null(c: Column | str, tokens=NA_TOKENS) -> Column:
    """Missing-value tokens of the source reader become NULL."""
    c = _col(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def is_nan_text(c: Column | str) -> Column:
    """Case-insensitive comparison with ``nan``."""
    return F.lower(_col(c)) == F.lit("nan")


def dimension_text(c: Column | str) -> Column:
    """Cleaned dimension value, or NULL when rejected (C4 + F3 + C15).

    Missing, blank and ``nan`` (any letter case) are rejected.
    """
    s = strip_text(c)
    return F.when(s.isNull() | (s == "") | is_nan_text(s), F.lit(None).cast("string")).otherwise(s)


def valid_dimension_text(c: Column | str) -> Column:
    """Predicate form of the dimension value filter."""
    return dimension_text(c).isNotNull()
