"""Account, customer and card keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.functions.dates import ColumnOrName, as_column

# One-letter teller account types and their application codes.
ACCOUNT_TYPE_CODES = {
    "D": "DD",
    "S": "SV",
    "L": "LN",
    "M": "ML",
    "B": "BX",
    "T": "CD",
    "R": "IR",
}


def normalize_key(c: ColumnOrName, as_type: str = "bigint") -> Column:
    """A key without leading zeros, as text or as a number (null when not numeric)."""
    key = as_column(c)
    if as_type == "string":
        return F.regexp_replace(key.cast("string"), "^0+", "")
    return key.try_cast(as_type)


def build_account_key(
    type_col: ColumnOrName,
    number_col: ColumnOrName,
    mapping: dict[str, str] | None = None,
    width: int = 20,
    prefix: str = "1-",
) -> Column:
    """``<prefix><application>-<zero padded number>``; unknown types read ERROR."""
    letter = as_column(type_col)
    code = F.lit("ERROR")
    for short, application in (mapping or ACCOUNT_TYPE_CODES).items():
        code = F.when(letter == short, application).otherwise(code)
    padded = F.lpad(as_column(number_col).cast("string"), width, "0")
    return F.concat(F.lit(prefix), code, F.lit("-"), padded)


def derive_card_pan(number_col: ColumnOrName) -> Column:
    """Card number without leading zeros and without its final check digit."""
    bare = normalize_key(number_col, "string")
    return F.substring(bare, F.lit(1), F.length(bare) - 1)
