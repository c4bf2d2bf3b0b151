"""Ordered rules and yes/no flags."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.functions.dates import ColumnOrName, as_column, as_date


def classify(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first rule that holds, else the default."""
    out = F.lit(default)
    for test, value in reversed(rules):
        out = F.when(test, value).otherwise(out)
    return out


def active_within(c: ColumnOrName, as_of: date | str | Column, days: int = 30) -> Column:
    """``yes`` when the date is newer than ``as_of - days``; older or null is ``no``."""
    return F.when(as_column(c) > F.date_sub(as_date(as_of), days), "yes").otherwise("no")
