"""Date expressions: parse, parts, season, month start, ISO week."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starload.functions.patterns import (
    ISO_DATE,
    SEASON_AUTUMN,
    SEASON_SPRING,
    SEASON_SUMMER,
    SEASON_WINTER,
    SPRING_MONTHS,
    SUMMER_MONTHS,
    WINTER_MONTHS,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str) -> Column:
    """Text ``yyyy-MM-dd`` to date (C8): other text is an error, NULL stays NULL.

    The error does not depend on the session's ANSI setting: text that does
    not parse raises explicitly.
    """
    c = _col(c)
    d = F.when(c.rlike(ISO_DATE), c.try_cast("date"))
    err = F.raise_error(F.concat(F.lit("cannot parse date: "), c)).cast("date")
    return F.when(c.isNull(), F.lit(None).cast("date")).otherwise(F.coalesce(d, err))


def year_of(c: Column | str) -> Column:
    """Calendar year as int."""
    return F.year(_col(c)).cast("int")


def month_of(c: Column | str) -> Column:
    """Calendar month as int."""
    return F.month(_col(c)).cast("int")


def season_of_month(m: Column | str) -> Column:
    """Season name of a calendar month (C10); months outside 1-8 and 12 are autumn."""
    m = _col(m)
    return (
        F.when(m.isin(*WINTER_MONTHS), F.lit(SEASON_WINTER))
        .when(m.isin(*SPRING_MONTHS), F.lit(SEASON_SPRING))
        .when(m.isin(*SUMMER_MONTHS), F.lit(SEASON_SUMMER))
        .otherwise(F.lit(SEASON_AUTUMN))
    )


def month_start(year: Column | str, month: Column | str) -> Column:
    """First day of the month (C13); a month outside 1..12 is an error."""
    y, m = _col(year), _col(month)
    err = F.raise_error(F.concat(F.lit("month must be in 1..12: "), m.cast("string"))).cast("date")
    return F.when(m.isNotNull() & ~m.between(1, 12), err).otherwise(F.make_date(y, m, F.lit(1)))


def iso_week(c: Column | str) -> Column:
    """ISO-8601 week number (C14): 2021-01-01 is week 53."""
    return F.weekofyear(_col(c)).cast("int")
