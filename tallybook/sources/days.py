"""Processing days of a snapshot tree, taken from folder names without opening a data file.

Two layouts are known: ``folders`` (``base/yyyy/MM/dd``) and ``partitioned``
(``base/snapshot_date=yyyy-MM-dd``, as written by ``write_snapshot``). A range of days or
a choice of years is followed down the tree, so folders outside it are not listed.
"""

from __future__ import annotations

import calendar
import re
from collections.abc import Iterable, Iterator
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tallybook.operators.spines import spine_of_days

_PARTITION = re.compile(r"snapshot_date=(\d{4}-\d{2}-\d{2})")


def _day(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def _subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path; none if it does not exist."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]


def _numbered(spark: SparkSession, path: str, digits: int) -> Iterator[tuple[int, str]]:
    for name in sorted(_subfolders(spark, path)):
        if re.fullmatch(rf"\d{{{digits}}}", name):
            yield int(name), f"{path}/{name}"


def _walk(spark, base, first: date, last: date, years) -> Iterator[tuple[date, str]]:
    for year, in_year in _numbered(spark, base, 4):
        if not first.year <= year <= last.year or (years is not None and year not in years):
            continue
        for month, in_month in _numbered(spark, in_year, 2):
            if not (first.year, first.month) <= (year, month) <= (last.year, last.month):
                continue
            for day, path in _numbered(spark, in_month, 2):
                if 1 <= month <= 12 and 1 <= day <= calendar.monthrange(year, month)[1]:
                    yield date(year, month, day), path


def _partitions(spark, base, years) -> Iterator[tuple[date, str]]:
    for name in sorted(_subfolders(spark, base)):
        found = _PARTITION.fullmatch(name)
        if found:
            day = date.fromisoformat(found.group(1))
            if years is None or day.year in years:
                yield day, f"{base}/{name}"


def list_days(
    spark: SparkSession,
    base: str,
    start: date | str | None = None,
    end: date | str | None = None,
    years: Iterable[int] | None = None,
    layout: str = "folders",
) -> dict[date, str]:
    """Days of the tree in order, each with its folder; at most one entry per calendar day.

    Names that are no day are passed over. A tree that does not exist has no days.
    """
    first = date.min if start is None else _day(start)
    last = date.max if end is None else _day(end)
    wanted = None if years is None else set(years)
    base = base.rstrip("/")
    if layout == "partitioned":
        found = _partitions(spark, base, wanted)
    else:
        found = _walk(spark, base, first, last, wanted)
    return {day: path for day, path in found if first <= day <= last}


def snapshot_spine(
    spark: SparkSession,
    base: str,
    start: date | str | None = None,
    end: date | str | None = None,
    years: Iterable[int] | None = None,
    layout: str = "folders",
) -> DataFrame:
    """The spine of a tree's processing days, from its folder names alone."""
    return spine_of_days(spark, list_days(spark, base, start, end, years, layout))
