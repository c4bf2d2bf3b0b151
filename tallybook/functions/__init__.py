"""Column functions: date text, keys, text tests and ordered rules."""

from tallybook.functions.dates import (
    date_prefix,
    date_window,
    normalize_snapshot_date,
    parse_datetime,
    period_columns,
)
from tallybook.functions.keys import build_account_key, derive_card_pan, normalize_key
from tallybook.functions.rules import active_within, classify
from tallybook.functions.text import (
    contains_any,
    first_non_blank,
    starts_with_any,
    trim_suffix_when,
)

__all__ = [
    "active_within",
    "build_account_key",
    "classify",
    "contains_any",
    "date_prefix",
    "date_window",
    "derive_card_pan",
    "first_non_blank",
    "normalize_key",
    "normalize_snapshot_date",
    "parse_datetime",
    "period_columns",
    "starts_with_any",
    "trim_suffix_when",
]
