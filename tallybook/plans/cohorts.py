"""Balances of new and lost customers some months on or back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.dates import as_date
from tallybook.operators.spines import asof_dates


def resolve_snapshot(
    cohort_dates: DataFrame,
    spine: DataFrame,
    months: int,
    month_end: bool = False,
) -> DataFrame:
    """For each cohort day the last processing day by the day ``months`` on.

    With ``month_end`` the target moves to its month's end. A negative number looks
    back. Cohort days without any such processing day drop out. ``is_complete`` tells
    whether the feed had reached the target, or an earlier file had to stand in.
    """
    target = F.add_months("snapshot_date", months)
    target = F.last_day(target) if month_end else target
    wanted = cohort_dates.select("snapshot_date").distinct().withColumn("target_date", target)
    # cohort days, targets and the spine hold one row per calendar day at most
    known = asof_dates(wanted, spine, "target_date")
    newest = spine.agg(F.max("snapshot_date")).scalar()
    return (
        wanted.join(F.broadcast(known), "target_date")
        .where(F.col("resolved_date").isNotNull())
        .select(
            "snapshot_date",
            "target_date",
            "resolved_date",
            (newest >= F.col("target_date")).alias("is_complete"),
        )
    )


def _cohort_dollars(
    cohort: DataFrame,
    resolved: DataFrame,
    xref: DataFrame,
    balances: DataFrame,
    balance: str,
    name: str,
) -> DataFrame:
    """Sum of a balance over the primary accounts of each cohort day's customers."""
    # both are bounded by the calendar; the second one prunes the snapshot scans
    placing = F.broadcast(resolved.select("snapshot_date", "resolved_date"))
    needed = F.broadcast(resolved.select(F.col("resolved_date").alias("snapshot_date")).distinct())
    placed = cohort.join(placing, "snapshot_date")
    owned = (
        xref.where(F.col("primary_customer_flag") == "Y")
        .join(needed, "snapshot_date", "left_semi")
        .select("customer_key", "account_key", F.col("snapshot_date").alias("resolved_date"))
    )
    amounts = balances.join(needed, "snapshot_date", "left_semi").select(
        "account_key",
        F.col("snapshot_date").alias("resolved_date"),
        F.col(balance).alias("_amount"),
    )
    return (
        placed.join(owned, ["customer_key", "resolved_date"], "left")
        .join(amounts, ["account_key", "resolved_date"], "left")
        .groupBy("snapshot_date")
        .agg(F.sum("_amount").alias(name))
    )


def new_customer_dollars(
    flags: DataFrame, xref: DataFrame, balances: DataFrame, spine: DataFrame, months: int = 2
) -> DataFrame:
    """Month-to-date collected balance of each day's new customers, ``months`` on."""
    cohort = flags.where(F.col("new_customer_flag") == 1).select("customer_key", "snapshot_date")
    resolved = resolve_snapshot(cohort, spine, months, month_end=True)
    return _cohort_dollars(
        cohort, resolved, xref, balances, "average_collected_balance_mtd", "deposit_dollars_new"
    )


def lost_customer_dollars(
    flags: DataFrame, xref: DataFrame, balances: DataFrame, spine: DataFrame, months: int = 2
) -> DataFrame:
    """Twelve-month average balance of each day's lost customers, ``months`` before."""
    cohort = flags.where(F.col("lost_customer_flag") == 1).select("customer_key", "snapshot_date")
    resolved = resolve_snapshot(cohort, spine, -months)
    return _cohort_dollars(
        cohort,
        resolved,
        xref,
        balances,
        "average_collected_balance_last_12_months",
        "deposit_dollars_lost",
    )


def new_dollars_for_month(
    flags: DataFrame,
    xref: DataFrame,
    balances: DataFrame,
    spine: DataFrame,
    as_of: date | str,
    months: int = 2,
) -> DataFrame:
    """New-customer dollars of the month that came due with the last month-end file.

    The file is the newest one up to the end of the month before ``as_of``; the cohort
    days are those of the month ``months`` before it.
    """
    due = F.last_day(F.add_months(as_date(as_of), -1))
    # the spine is bounded by the calendar, and so is this window
    newest = F.max("snapshot_date").over(Window.partitionBy())
    resolved = (
        spine.where(F.col("snapshot_date") <= due)
        .select("snapshot_date", newest.alias("resolved_date"))
        .where(F.last_day("snapshot_date") == F.last_day(F.add_months("resolved_date", -months)))
    )
    cohort = flags.where(F.col("new_customer_flag") == 1).select("customer_key", "snapshot_date")
    return _cohort_dollars(
        cohort, resolved, xref, balances, "average_collected_balance_mtd", "deposit_dollars_new"
    )
