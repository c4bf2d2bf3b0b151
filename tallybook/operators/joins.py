"""Membership splits, trailing-window joins and as-of joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from tallybook.operators.picks import latest_per_key
from tallybook.operators.spines import day_positions


def split_by_membership(
    df: DataFrame, keys_df: DataFrame, key: str | Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is known, and rows whose key is new (a null key is new)."""
    names = [key] if isinstance(key, str) else list(key)
    keys = keys_df.select(*names)
    return df.join(keys, names, "left_semi"), df.join(keys, names, "left_anti")


def range_join_trailing(
    events: DataFrame, spine: DataFrame, date_col: str, days: int
) -> DataFrame:
    """Give each event the run of processing days whose trailing window holds it.

    An event on day ``d`` is in the window of every processing day in
    ``[d, d + days]``. These are consecutive positions ``seq_from`` up to, not
    including, ``seq_until``, so instead of one row per (event, day) the event
    keeps one row and two numbers. Both ends are equality lookups in a calendar;
    events outside every window are dropped. Expand with
    ``explode(sequence(seq_from, seq_until - 1))`` after pre-aggregating.
    """
    # bounded by the number of calendar days, see spines
    calendar = F.broadcast(day_positions(spine, before=days, after=days + 1))
    opens = calendar.select(F.col("day").alias("_opens"), F.col("seq").alias("seq_from"))
    closes = calendar.select(F.col("day").alias("_closes"), F.col("seq").alias("seq_until"))
    return (
        events.withColumns(
            {"_opens": F.col(date_col), "_closes": F.date_add(date_col, days + 1)}
        )
        .join(opens, "_opens")
        .join(closes, "_closes")
        .where(F.col("seq_from") < F.col("seq_until"))
        .drop("_opens", "_closes")
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_date: str,
    right_date: str,
    tiebreak: Sequence[str] = (),
    direction: str = "backward",
    slices: int | None = None,
) -> DataFrame:
    """Left rows with the closest right row on or before (``backward``) or on or
    after (``forward``) the left date; null columns where there is none.

    Both sides are first reduced to one row per key and date, so the carry window
    of a key is bounded by the calendar whatever the key's row count, and no pairs
    within a key are formed. The result goes back to the left rows by equality.

    Times may be TIMESTAMPs too, of which a key can have any number. They are cut into ``slices`` of about
    equal row counts (the shuffle partitions, if not given), a key's rows into as many groups at most;
    the last row of each slice is carried into the following ones.
    """
    kinds = left.schema[left_date].dataType, right.schema[right_date].dataType
    if kinds[0] != kinds[1] or not isinstance(kinds[0], (DateType, TimestampType, TimestampNTZType)):
        names = " and ".join(k.simpleString() for k in kinds)
        raise TypeError(f"as-of times must be DATE or TIMESTAMP, the same on both sides, not {names}")
    payload = [c for c in right.columns if c not in keys]
    best = latest_per_key(
        right.where(F.col(right_date).isNotNull()), [*keys, right_date], right_date, tiebreak
    )
    marks = best.select(
        *keys, F.col(right_date).alias("_day"), F.struct(*payload).alias("_row")
    )
    asked = left.select(*keys, F.col(left_date).alias("_day")).distinct()
    asked = asked.withColumn("_row", F.lit(None).cast(marks.schema["_row"].dataType))
    both = marks.withColumn("_asked", F.lit(False)).unionByName(
        asked.withColumn("_asked", F.lit(True))
    )
    backward = direction == "backward"
    if isinstance(kinds[0], DateType):
        order = F.col("_day").asc() if backward else F.col("_day").desc()
        carried = Window.partitionBy(*keys).orderBy(order, F.col("_asked").asc())
        hits = both.withColumn("_hit", F.last("_row", ignorenulls=True).over(carried))
    else:
        hits = _carried_over_slices(both, keys, _time_bounds(left, left_date, right, right_date, slices), backward)
    found = (
        hits.where(F.col("_asked") & F.col("_hit").isNotNull())
        .select(*keys, F.col("_day").alias(left_date), "_hit")
    )
    joined = left.join(found, [*keys, left_date], "left")
    return joined.select(*left.columns, *[F.col("_hit")[c].alias(c) for c in payload])


def _micros(time: Column) -> Column:
    """Microseconds since 1970; a time without zone is counted as it reads."""
    day = F.unix_date(time.cast("date")).cast("bigint") * 86_400
    seconds = day + F.hour(time) * 3600 + F.minute(time) * 60
    wall = seconds * 1_000_000 + (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("bigint")
    return F.when(F.typeof(time) == "timestamp_ntz", wall).otherwise(F.unix_micros(time.cast("timestamp")))


def _time_bounds(
    left: DataFrame, left_time: str, right: DataFrame, right_time: str, slices: int | None
) -> list[int]:
    """Inner bounds of time slices with about equal numbers of rows, in microseconds: a number a slice."""
    wanted = slices or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    times = left.select(_micros(F.col(left_time)).alias("t")).union(right.select(_micros(F.col(right_time))))
    steps = [i / wanted for i in range(1, wanted)]
    if not steps:
        return []
    cut = times.agg(F.percentile_approx("t", steps, max(10_000, 20 * wanted))).first()[0]
    return sorted(set(cut or []))


def _carried_over_slices(
    both: DataFrame, keys: Sequence[str], bounds: list[int], backward: bool
) -> DataFrame:
    """``_hit``: the last mark of the key before each row in time order, or after it."""
    known = F.lit(bounds or [0]).cast("array<bigint>")
    # binary search: how many bounds lie below the time
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    time = _micros(F.col("_day"))
    slice_of = F.aggregate(
        F.lit(steps or [0]),
        F.lit(0),
        lambda i, s: F.when(F.get(known, i + s - 1) < time, i + s).otherwise(i),
    )
    sign = 1 if backward else -1
    cut = both.withColumns(
        {"_slice": (slice_of if bounds else F.lit(0)) * sign, "_order": time * sign}
    )
    group = [*keys, "_slice"]
    within = Window.partitionBy(*group).orderBy("_order", "_asked")
    own = F.last("_row", ignorenulls=True).over(within)
    # a slice's last mark; a key has at most one row per slice here
    last = cut.where(~F.col("_asked")).groupBy(*group).agg(F.max_by("_row", "_order").alias("_last"))
    slices = cut.select(*group).distinct().join(last, group, "left")
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    entering = slices.select(*group, F.last("_last", ignorenulls=True).over(before).alias("_entering"))
    # null keys have no match on either side, and none is wanted
    return cut.withColumn("_own", own).join(entering, group, "left").withColumn(
        "_hit", F.coalesce("_own", "_entering")
    )
