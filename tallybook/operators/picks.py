"""One row, one value or the top rows per key, always with a tie-break."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first_row(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    # row_number() = 1 plans WindowGroupLimit on both sides of the exchange, so a
    # hot key is cut to one row per input partition before it is shuffled.
    ranked = df.withColumn(
        "_pick", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col("_pick") == 1).drop("_pick")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Newest row per key; ties go to the smallest tie-break values."""
    ties = [F.asc_nulls_last(c) for c in tiebreak]
    return _first_row(df, keys, [F.desc_nulls_last(order), *ties])


def earliest_per_key(
    df: DataFrame, keys: Sequence[str], order: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Oldest row per key; ties go to the smallest tie-break values."""
    ties = [F.asc_nulls_last(c) for c in tiebreak]
    return _first_row(df, keys, [F.asc_nulls_last(order), *ties])


def mode_per_key(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    count_name: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Most frequent value per key; equal counts go to the smallest value.

    Counting by (key, value) combines on the map side, so the pick only sees one
    row per distinct value of a key. A null value counts like any other. ``weight``
    names a column of counts when the rows are counted already.
    """
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.groupBy(*keys, value).agg(total.alias("_n"))
    best = latest_per_key(counts, keys, "_n", [value])
    if count_name is None:
        return best.drop("_n")
    return best.withColumnRenamed("_n", count_name)


def most_used(value: str, uses: str) -> Column:
    """Aggregate: the int value with most uses (above 0); equal uses go to the smallest.

    The same pick as :func:`mode_per_key` for several counts in one pass. Count and value
    are packed into one number, as a maximum over numbers is hash-aggregated where one
    over structs is sorted. Low bits: 0 for a null value, which loses ties, else higher
    for smaller values. Counts too large to pack in a bigint go through a decimal.
    """
    span, largest_int, packable = 2**33, 2**31 - 1, 2**30 - 1
    count = F.col(uses).cast("bigint")
    low = F.coalesce(F.lit(largest_int + 1) - F.col(value).cast("bigint"), F.lit(0))
    packed = F.max(F.when(count.between(1, packable), count * F.lit(span) + low))
    wide_span = F.lit(span).cast("decimal(10,0)")
    wide = F.max(F.when(count > packable, count.cast("decimal(20,0)") * wide_span + low))
    best = F.coalesce((wide % wide_span).cast("bigint"), packed.bitwiseAND(F.lit(span - 1)))
    return F.when(best > 0, (F.lit(largest_int + 1) - best).cast("int"))


def top_k(df: DataFrame, order: str, k: int, tiebreak: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest order value (``TakeOrderedAndProject``)."""
    return df.orderBy(F.desc_nulls_last(order), *[F.asc_nulls_last(c) for c in tiebreak]).limit(k)
