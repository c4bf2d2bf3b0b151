"""Rollups, pivots and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tallybook.operators.ranks import ranked


def distinct_counts(df: DataFrame, keys: Sequence[str], values: dict[str, str]) -> DataFrame:
    """Exact distinct counts per key; ``values`` maps output names to columns."""
    return df.groupBy(*keys).agg(
        *[F.countDistinct(column).alias(name) for name, column in values.items()]
    )


def sum_numeric(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum of every numeric column that is not a key."""
    numeric = [
        f.name
        for f in df.schema
        if isinstance(f.dataType, NumericType) and f.name not in keys
    ]
    return df.groupBy(*keys).agg(*[F.sum(F.col(f"`{c}`")).alias(f"sum_{c}") for c in numeric])


def nested_mean(
    df: DataFrame, levels: Sequence[Sequence[str]], value: str, name: str
) -> DataFrame:
    """Mean of means: average by the first level, then average that by the next."""
    out = df.withColumnRenamed(value, name)
    for level in levels:
        out = out.groupBy(*level).agg(F.avg(name).alias(name))
    return out


def pivot_agg(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    values: Sequence[object],
    aggregate,
    names: Sequence[str] | None = None,
    other: str | None = None,
) -> DataFrame:
    """One output column per listed value (listed, so no extra job looks for them).

    Rows of any other value, or of none, go into the column ``other``. Without that name
    they are an error when the plan runs, so that none vanish unseen.
    """
    if other is None:
        text = F.coalesce(F.col(column).cast("string"), F.lit("null"))
        rest = F.raise_error(F.concat(F.lit(f"{column} has a value that is not listed: "), text))
        rest = rest.cast(df.schema[column].dataType)
    else:
        rest = F.lit(other)
    listed = F.when(F.col(column).isin(list(values)), F.col(column)).otherwise(rest)
    wanted = list(values) if other is None else [*values, other]
    wide = df.withColumn(column, listed).groupBy(*keys).pivot(column, wanted).agg(aggregate)
    if names is None:
        return wide
    return wide.withColumnsRenamed({str(v): n for v, n in zip(values, names)})


def frequency_profile(df: DataFrame, column: str, rank: str | None = None) -> DataFrame:
    """Value counts, most frequent first, then by value; ``rank`` names a column for the position."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    order = [F.desc("row_count"), F.asc_nulls_last(column)]
    return counts.orderBy(*order) if rank is None else ranked(counts, order, rank)


def rows_per_snapshot(df: DataFrame, date_col: str = "snapshot_date") -> DataFrame:
    """Rows per day, newest first, with ``grew``: not fewer rows than the day before."""
    counts = df.groupBy(date_col).agg(F.count(F.lit(1)).alias("row_count"))
    # one row per calendar day reaches this window
    before = F.lag("row_count").over(Window.orderBy(date_col))
    grew = F.coalesce(F.col("row_count") >= before, F.lit(True))
    return counts.withColumn("grew", grew).orderBy(F.desc(date_col))
