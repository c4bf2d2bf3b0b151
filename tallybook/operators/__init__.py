"""Row-set operators the plans are composed of."""

from tallybook.operators.aggregates import (
    distinct_counts,
    frequency_profile,
    nested_mean,
    pivot_agg,
    rows_per_snapshot,
    sum_numeric,
)
from tallybook.operators.frames import recode_values, sanitize_columns, union_feeds
from tallybook.operators.joins import asof_join, range_join_trailing, split_by_membership
from tallybook.operators.lookups import Lookup, small_lookup
from tallybook.operators.picks import (
    earliest_per_key,
    latest_per_key,
    mode_per_key,
    most_used,
    top_k,
)
from tallybook.operators.ranks import ranked
from tallybook.operators.spines import (
    asof_dates,
    day_positions,
    latest_two_dates,
    processing_dates,
    settled_spine,
    spine_of_days,
)
from tallybook.operators.upserts import upsert

__all__ = [
    "Lookup",
    "asof_dates",
    "asof_join",
    "day_positions",
    "distinct_counts",
    "earliest_per_key",
    "frequency_profile",
    "latest_per_key",
    "latest_two_dates",
    "mode_per_key",
    "most_used",
    "nested_mean",
    "pivot_agg",
    "processing_dates",
    "range_join_trailing",
    "ranked",
    "recode_values",
    "rows_per_snapshot",
    "settled_spine",
    "small_lookup",
    "spine_of_days",
    "sanitize_columns",
    "split_by_membership",
    "sum_numeric",
    "top_k",
    "union_feeds",
    "upsert",
]
