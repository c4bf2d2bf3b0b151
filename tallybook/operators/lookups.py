"""Small lookups used as values instead of joins.

A lookup of few rows becomes one value: an array of maps, addressed by a hash of the key. A row
finds its entry where it is, so neither hot keys nor broadcast limits matter and the large side is
not moved. Whether a lookup is small is measured, by reading at most one row more than allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

#: Largest lookup that passes through the driver, in rows and bytes.
LOOKUP_ROWS = 5_000
LOOKUP_BYTES = 4 << 20


@dataclass(frozen=True)
class Lookup:
    """A measured lookup; ``maps`` is a scalar subquery over a local relation."""

    kinds: tuple[DataType, ...]
    places: int
    maps: Column

    def get(self, *columns: str | Column, typed: Sequence[DataType | None] = ()) -> Column:
        """The value for a key; null if a part of it is null or it is unknown.

        ``typed`` gives the columns' own types where known; others are cast to the lookup's.
        """
        own = [*typed, *[None] * len(self.kinds)]
        parts = [F.col(c) if isinstance(c, str) else c for c in columns]
        parts = [
            p if kind == given else p.try_cast(kind)
            for p, kind, given in zip(parts, self.kinds, own, strict=False)
        ]
        known = parts[0].isNotNull()
        for part in parts[1:]:
            known = known & part.isNotNull()
        place = F.pmod(F.xxhash64(*parts), F.lit(self.places)).cast("int")
        return F.when(known, F.get(self.maps, place)[_key(parts)])


def _key(parts: Sequence[Column]) -> Column:
    return parts[0] if len(parts) == 1 else F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])


def small_lookup(
    lookup: DataFrame, keys: Sequence[str], value: str, most: int = LOOKUP_ROWS
) -> Lookup | None:
    """The lookup as a value, or ``None`` if it has too many rows or bytes, or several for a key.

    It is read once, when the plan is made. Rows with a null in their key are never found.
    """
    slim = lookup.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(value).alias("_v"))
    names = [f"_k{i}" for i in range(len(keys))]
    rows = slim.dropna(subset=names).limit(most + 1).toArrow()
    if len(rows) > most or rows.nbytes > LOOKUP_BYTES:
        return None
    if len(rows.group_by(names).aggregate([])) < len(rows):
        return None
    local = lookup.sparkSession.createDataFrame(rows, slim.schema)
    places = max(1, len(rows))
    parts = [F.col(n) for n in names]
    place = F.pmod(F.xxhash64(*parts), F.lit(places)).cast("int").alias("place")
    entries = F.collect_list(F.struct(_key(parts).alias("key"), "_v"))
    grouped = local.coalesce(1).groupBy(place).agg(F.map_from_entries(entries).alias("held"))
    held = F.map_from_entries(F.collect_list(F.struct("place", "held")))
    maps = F.transform(F.sequence(F.lit(0), F.lit(places - 1)), lambda p: F.col("held")[p])
    value_of = grouped.agg(held.alias("held")).select(maps.alias("maps")).scalar()
    return Lookup(tuple(slim.schema[n].dataType for n in names), places, value_of)
