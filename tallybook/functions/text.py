"""Text tests and clean-up."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.functions.dates import ColumnOrName, as_column


def contains_any(c: ColumnOrName, phrases: Iterable[str], case_sensitive: bool = False) -> Column:
    """True when the text holds any phrase. Plain byte searches, no regular expression."""
    text, phrases = as_column(c), list(phrases)
    if not case_sensitive:
        text, phrases = F.lower(text), [p.lower() for p in phrases]
    if not phrases:
        return F.lit(False)
    return functools.reduce(operator.or_, [text.contains(p) for p in phrases])


def starts_with_any(c: ColumnOrName, prefixes: Iterable[str]) -> Column:
    """True when the text starts with any prefix (case-sensitive)."""
    return functools.reduce(operator.or_, [as_column(c).startswith(p) for p in prefixes])


def first_non_blank(cols: Iterable[ColumnOrName], default: str = "ERROR") -> Column:
    """First column with visible length, else the default."""
    filled = [F.when(F.length(as_column(c)) > 0, as_column(c)) for c in cols]
    return F.coalesce(*filled, F.lit(default))


def trim_suffix_when(c: ColumnOrName, marker: str, n: int) -> Column:
    """Drop the last ``n`` characters of texts that contain the marker."""
    text = as_column(c)
    return F.when(
        text.contains(marker), F.substring(text, F.lit(1), F.length(text) - n)
    ).otherwise(text)
