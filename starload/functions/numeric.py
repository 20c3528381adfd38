"""Tolerant numeric parsing.

Spark's ``try_cast`` is close to ``pandas.to_numeric(errors="coerce")`` but
accepts more (``nan``, Java suffixes such as ``1d``); the ``NUMBER`` guard
keeps exactly the accepted spellings, and an overflow of a digit string to
infinity becomes missing, as in pandas. Almost all numbers match ``PLAIN_NUMBER``,
which cannot overflow, so a cell usually costs one match and one cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starload.functions.patterns import INF_LITERAL, NUMBER, PLAIN_NUMBER
from starload.functions.text import strip_text

_INF = float("inf")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decimal_comma(c: Column | str) -> Column:
    """Decimal comma to point after trimming."""
    return F.replace(strip_text(_col(c)), F.lit(","), F.lit("."))


def to_double(c: Column | str) -> Column:
    """Text to double; text that is not a number becomes NULL."""
    s = _col(c).cast("string")
    v = s.try_cast("double")
    finite = F.abs(v) != F.lit(_INF)
    return F.when(s.rlike(PLAIN_NUMBER), v).when(s.rlike(NUMBER) & (finite | s.rlike(INF_LITERAL)), v)


def to_int_key(c: Column | str, what: str = "value") -> Column:
    """Tolerant integer (C7): missing/bad text is NULL; ``2020.0`` is 2020.

    A fraction or an infinity is an error, as the nullable-integer
    conversion of the source raises there.
    """
    d = to_double(c)
    bad = (F.abs(d) == F.lit(_INF)) | (d != F.floor(d)) | (F.abs(d) > F.lit(2147483647.0))
    err = F.raise_error(F.concat(F.lit(f"cannot convert {what} to integer: "), _col(c).cast("string")))
    return F.when(d.isNull(), F.lit(None).cast("int")).when(bad, err.cast("int")).otherwise(d.cast("int"))


def nan_to_null(c: Column | str) -> Column:
    """Floating NaN becomes NULL (C11); NULL is the only missing value."""
    return F.nanvl(_col(c), F.lit(None).cast("double"))
