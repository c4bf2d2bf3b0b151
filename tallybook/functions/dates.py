"""Dates out of feed text, and calendar columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value: date | str | Column) -> Column:
    """A date literal from a Python date or ISO text; columns pass through."""
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def normalize_snapshot_date(c: ColumnOrName) -> Column:
    """Day of a feed stamp written as ISO text or as ``M/d/yyyy`` text, else null.

    The ``try_`` forms keep malformed text null under ANSI mode.
    """
    head = F.substring_index(F.substring(as_column(c).cast("string"), 1, 10), " ", 1)
    return F.coalesce(head.try_cast("date"), F.try_to_date(head, "M/d/yyyy"))


def parse_datetime(c: ColumnOrName, fmt: str) -> Column:
    """Day of a text timestamp in a known format; text that does not match is null."""
    return F.to_date(F.try_to_timestamp(as_column(c), F.lit(fmt)))


def date_prefix(c: ColumnOrName, n: int = 10) -> Column:
    """Leading day part of a text timestamp."""
    return F.substring(as_column(c).cast("string"), 1, n)


def date_window(c: ColumnOrName, as_of: date | str | Column, days: int) -> Column:
    """True for dates in the closed window of ``days`` days before ``as_of``."""
    end = as_date(as_of)
    return as_column(c).between(F.date_sub(end, days), end)


def period_columns(c: ColumnOrName) -> dict[str, Column]:
    """Calendar columns of a date, for ``withColumns`` or ``select``."""
    day = as_column(c)
    return {
        "year": F.year(day),
        "month": F.month(day),
        "month_start": F.date_format(day, "yyyy-MM-01"),
        "month_end": F.last_day(day),
        "quarter": F.date_format(day, "yyyy_Q"),
        "prior_month_end": F.last_day(F.add_months(day, -1)),
    }
