"""Processing-day spines.

A spine holds one row per processing day: ``snapshot_date``, its position ``seq``
(from 1), and the neighbouring days ``prior_date`` and ``next_date``. A spine and
the calendars made from it hold at most one row per calendar day (DATE has under
four million values), which is the size bound for every broadcast and for every
window without partition keys in this module.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tallybook.functions.dates import as_date


def require_date(df: DataFrame, column: str) -> None:
    """Refuse stamps that are not whole days; normalize_snapshot_date makes them so."""
    kind = df.schema[column].dataType
    if not isinstance(kind, DateType):
        raise TypeError(f"{column} must be a DATE, not {kind.simpleString()}")


def processing_dates(
    df: DataFrame, date_col: str = "snapshot_date", since: date | str | None = None
) -> DataFrame:
    """Distinct processing days in order, with their neighbours.

    The column must be a DATE: finer stamps would not be bounded by the calendar.
    """
    require_date(df, date_col)
    days = df.select(F.col(date_col).alias("snapshot_date")).where(F.col(date_col).isNotNull())
    if since is not None:
        days = days.where(F.col("snapshot_date") >= as_date(since))
    order = Window.orderBy("snapshot_date")
    return days.distinct().select(
        "snapshot_date",
        F.row_number().over(order).alias("seq"),
        F.lag("snapshot_date").over(order).alias("prior_date"),
        F.lead("snapshot_date").over(order).alias("next_date"),
    )


def spine_of_days(spark: SparkSession, days: Iterable[date]) -> DataFrame:
    """The spine of known days, as a local relation: no scan and no window, however often it is read."""
    known = sorted({d for d in days if d is not None})
    days = pa.array(known, pa.date32())
    none = pa.nulls(min(1, len(known)), pa.date32())
    table = {
        "snapshot_date": days,
        "seq": pa.array(range(1, len(known) + 1), pa.int32()),
        "prior_date": pa.concat_arrays([none, days[:-1]]),
        "next_date": pa.concat_arrays([days[1:], none]),
    }
    return spark.createDataFrame(pa.table(table))


def settled_spine(spine: DataFrame) -> DataFrame:
    """A spine computed once and kept as a local relation, with all its columns.

    For plans that read a spine several times. Its rows pass through the driver: one per
    calendar day at most.
    """
    return spine.sparkSession.createDataFrame(spine.toArrow(), spine.schema)


def latest_two_dates(spine: DataFrame, as_of: date | str) -> DataFrame:
    """Newest and previous day; no row when the newest day is not ``as_of``."""
    newest = spine.where(F.col("next_date").isNull() & (F.col("snapshot_date") == as_date(as_of)))
    return newest.select(F.col("snapshot_date").alias("latest_date"), "prior_date")


def day_positions(spine: DataFrame, before: int = 0, after: int = 0) -> DataFrame:
    """Every calendar day with the position of the first processing day on or after it.

    Covers ``before`` days ahead of the first processing day, and ``after`` days past
    the last one, which read the position after the last.
    """
    first = F.coalesce(F.date_add("prior_date", 1), F.date_sub("snapshot_date", before))
    last = F.when(F.col("next_date").isNull(), F.date_add("snapshot_date", after)).otherwise(
        F.col("snapshot_date")
    )
    days = spine.select(
        F.explode(F.sequence(first, last)).alias("day"), "seq", F.col("snapshot_date").alias("_own")
    )
    return days.select(
        "day", F.when(F.col("day") > F.col("_own"), F.col("seq") + 1).otherwise(F.col("seq"))
        .alias("seq"),
    )


def last_position(spine: DataFrame) -> Column:
    """Position of the last processing day, as a scalar subquery (run once, no join)."""
    return spine.agg(F.max("seq")).scalar()


def asof_dates(
    targets: DataFrame, spine: DataFrame, target: str, resolved: str = "resolved_date"
) -> DataFrame:
    """For each distinct target date the last processing day on or before it, else null."""
    wanted = targets.select(F.col(target).alias("_d"), F.lit(None).cast("date").alias("_s"))
    known = spine.select(F.col("snapshot_date").alias("_d"), F.col("snapshot_date").alias("_s"))
    upto = Window.orderBy("_d").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    days = wanted.distinct().unionByName(known)
    filled = days.withColumn(resolved, F.max("_s").over(upto)).where(F.col("_s").isNull())
    return filled.select(F.col("_d").alias(target), resolved)
