"""Loan portfolio growth between yearly snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions import starts_with_any

# GL types of retail loans read Retail... up to 2018 and RET... after.
RETAIL_PREFIXES = ("Retail", "RET")


def portfolio_snapshot(
    loans: DataFrame,
    loans_raw: DataFrame,
    mortgages: DataFrame,
    mortgages_raw: DataFrame,
    retail_prefixes: Sequence[str] = RETAIL_PREFIXES,
) -> DataFrame:
    """Retail loans and mortgages per snapshot day with original and owned amounts.

    Loans count with participation number 0 only. All snapshot days at once.
    """
    key = ["account_key", "snapshot_date"]
    retail = starts_with_any("gl_type", retail_prefixes)
    loan_amounts = loans_raw.where(F.col("participation_number") == 0).select(
        *key, F.col("original_loan_amount").alias("original_amount")
    )
    mortgage_amounts = mortgages_raw.select(
        *key, F.col("orig_principal_balance").alias("original_amount")
    )
    columns = [*key, "gl_type", "bank_owned_principle_assets", "original_amount"]
    # the participation test drops loans without a raw row, mortgages keep them
    booked = loans.where(retail).join(loan_amounts, key).select(*columns)
    secured = mortgages.where(retail).join(mortgage_amounts, key, "left").select(*columns)
    return booked.unionByName(secured)


def portfolio_growth(snapshots: DataFrame) -> DataFrame:
    """Per year: balances of accounts kept from the year before, and of new accounts.

    ``begin_existing`` is the whole prior year, ``end_existing`` this year's balance of
    accounts that were in it, ``begin_new`` the original and ``end_new`` the current
    amount of the others. A null account is new. Years whose prior year is missing
    are left out.
    """
    owned, original = F.col("bank_owned_principle_assets"), F.col("original_amount")
    year = F.year("snapshot_date")
    nothing = F.lit(None)
    # each row counts in its own year, and as the prior balance of the year after
    now = F.struct(
        year.alias("portfolio_year"),
        owned.alias("_owned"),
        original.alias("_original"),
        nothing.cast(snapshots.schema["bank_owned_principle_assets"].dataType).alias("_prior"),
        F.lit(True).alias("_now"),
    )
    later = F.struct(
        (year + 1).alias("portfolio_year"),
        nothing.cast(snapshots.schema["bank_owned_principle_assets"].dataType).alias("_owned"),
        nothing.cast(snapshots.schema["original_amount"].dataType).alias("_original"),
        owned.alias("_prior"),
        F.lit(False).alias("_now"),
    )
    per_account = (
        snapshots.select("account_key", F.inline(F.array(now, later)))
        .groupBy("account_key", "portfolio_year")
        .agg(
            F.sum("_owned").alias("_owned"),
            F.sum("_original").alias("_original"),
            F.sum("_prior").alias("_prior"),
            F.max("_now").alias("_now"),
            F.max(~F.col("_now")).alias("_before"),
        )
    )
    kept = F.col("_before") & F.col("account_key").isNotNull()
    return (
        per_account.groupBy("portfolio_year")
        .agg(
            F.sum("_prior").alias("begin_existing"),
            F.sum(F.when(kept, F.col("_owned"))).alias("end_existing"),
            F.sum(F.when(~kept, F.col("_original"))).alias("begin_new"),
            F.sum(F.when(~kept, F.col("_owned"))).alias("end_new"),
            F.max("_now").alias("_now"),
            F.max("_before").alias("_before"),
        )
        .where("_now AND _before")
        .drop("_now", "_before")
    )
