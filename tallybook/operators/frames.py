"""Column names, value recoding and stacking of feeds."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.operators.lookups import small_lookup


def sanitize_columns(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Given renames first, then every other character a plain name cannot hold to ``_``."""
    renames = renames or {}
    plain = {
        c: renames.get(c, re.sub(r"\W+", "_", c.strip()).strip("_") or f"column_{c}")
        for c in df.columns
    }
    return df.withColumnsRenamed(plain)


def recode_values(
    df: DataFrame,
    cols: Sequence[str],
    mapping: dict | DataFrame,
    key: str = "key",
    value: str = "value",
) -> DataFrame:
    """Replace values through a dictionary or a lookup table; unknown values stay.

    A lookup needs one row per key. A small one is used as a value, and rows stay where they
    are. With a larger one the distinct combinations of values are recoded, and rows are joined with
    them once, however many columns there are.
    """
    if isinstance(mapping, dict):
        return df.na.replace(mapping, subset=list(cols))
    small = small_lookup(mapping, [key], value)
    if small is not None:
        kinds = {c: df.schema[c].dataType for c in cols}
        found = {c: F.coalesce(small.get(c, typed=[kinds[c]]), F.col(c)) for c in cols}
        return df.withColumns(found)
    pair = mapping.select(F.col(key).alias("_from"), F.col(value).alias("_to"))
    tuples = df.select(*[F.col(c).alias(f"_old_{i}") for i, c in enumerate(cols)]).distinct()
    for i, c in enumerate(cols):
        recoded = tuples.join(pair, F.col(f"_old_{i}") == F.col("_from"), "left")
        new = F.coalesce("_to", f"_old_{i}").alias(f"_new_{i}")
        tuples = recoded.select(*tuples.columns, new)
    same = F.lit(True)
    for i, c in enumerate(cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_old_{i}"))
    renamed = {c: F.col(f"_new_{i}") for i, c in enumerate(cols)}
    joined = df.join(tuples, same, "left")
    return joined.select(*[renamed.get(c, F.col(c)).alias(c) for c in df.columns])


def union_feeds(a: DataFrame, b: DataFrame, by: str = "name") -> DataFrame:
    """Stack two feeds by position, or by name with missing columns null."""
    if by == "position":
        return a.union(b)
    return a.unionByName(b, allowMissingColumns=True)
