"""Merging a change set into a table version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    insert: Sequence[str] | None = None,
) -> DataFrame:
    """The target after merging the source (one row per key), as a new DataFrame.

    ``update`` lists the columns a matched row takes from the source (``None``: all
    non-key columns, empty: none). ``insert`` lists the columns a new row takes
    (``None``: all, empty: new rows are dropped); its other columns are null. A
    null key never matches. Merging the same source again changes nothing.
    """
    given = set(source.columns)
    rest = [c for c in target.columns if c not in keys]
    update = [c for c in rest if c in given] if update is None else list(update)
    insert = [c for c in rest if c in given] if insert is None else list(insert)
    inserts = bool(insert) or not rest
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = source.withColumn("_in_source", F.lit(True)).alias("s")
    same_key = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = t.join(s, same_key, "full" if inserts else "left")
    old, new = F.col("t._in_target").isNotNull(), F.col("s._in_source").isNotNull()

    def merged(c: str) -> Column:
        from_target = F.col(f"t.{c}")
        from_source = F.col(f"s.{c}") if c in given else F.lit(None)
        value = F.when(old & new, from_source if c in update else from_target)
        return value.when(old, from_target).otherwise(from_source if c in insert else None).alias(c)

    keyed = [F.when(old, F.col(f"t.{k}")).otherwise(F.col(f"s.{k}")).alias(k) for k in keys]
    columns = {k: col for k, col in zip(keys, keyed)} | {c: merged(c) for c in rest}
    return joined.select(*[columns[c] for c in target.columns])
