"""Digital banking usage and audit logs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions import date_prefix, date_window, parse_datetime
from tallybook.functions.dates import as_date
from tallybook.operators.aggregates import pivot_agg, sum_numeric
from tallybook.operators.picks import latest_per_key
from tallybook.operators.ranks import ranked
from tallybook.plans.branches import user_branch

# The vendor's stamp format, session events, and the unknown device.
STAMP_FORMAT = "MM/dd/yyyy HH:mm:ss"
SESSION_EVENTS = ["PFM Login", "Login", "Authenticate", "Logout"]
UNKNOWN_DEVICE = "UNKNOWN"
PROFILE = ["individual_id", "user_id", "first_name", "last_name"]


def login_pivot(
    trans: DataFrame,
    users: DataFrame,
    methods: Sequence[str],
    as_of: date | str,
    days: int = 91,
    login: str = "Login",
    stamp_format: str = STAMP_FORMAT,
) -> DataFrame:
    """Logins per person, one column per listed ``device - channel`` method and ``other``.

    Each person counts under the newest enrolment; people without logins are kept.
    """
    known = (F.col("device") != UNKNOWN_DEVICE) & F.col("device").isNotNull()
    logins = trans.where(
        (F.col("transaction_type") == login)
        & known
        & date_window(parse_datetime("transaction_stamp", stamp_format), as_of, days)
    ).withColumn("login_method", F.concat("device", F.lit(" - "), "channel"))
    counted = pivot_agg(
        logins, ["user_id"], "login_method", methods, F.count(F.lit(1)), other="other"
    )
    newest = latest_per_key(
        users.where(F.col("individual_id").isNotNull()),
        ["individual_id"],
        "enrolled_at",
        ["user_id"],
    ).select("individual_id", "user_id")
    return newest.join(counted, "user_id", "left").drop("user_id")


def usage_by_channel(trans: DataFrame, exclude: Sequence[str] = tuple(SESSION_EVENTS)) -> DataFrame:
    """Events per day, type and channel, without session events."""
    kept = trans.where(~F.col("transaction_type").isin(list(exclude)))
    return kept.groupBy("transaction_date", "transaction_type", "channel").agg(
        F.count(F.lit(1)).alias("event_count")
    )


def users_without_event(
    trans: DataFrame, event: Column, profile: Sequence[str] = tuple(PROFILE)
) -> DataFrame:
    """Known users none of whose rows is the event.

    One pass: rows shrink to one per user profile before users are compared.
    """
    key = profile[0]
    seen = (
        trans.where(F.col(key).isNotNull())
        .groupBy(*profile)
        .agg(F.max(F.coalesce(event, F.lit(False))).alias("_had"))
    )
    ever = F.max("_had").over(Window.partitionBy(key))
    return seen.withColumn("_ever", ever).where(~F.col("_ever")).select(*profile)


def unrecovered_failures(
    trans: DataFrame,
    failed: Column,
    recovered: Column,
    users: DataFrame | None = None,
    profile: Sequence[str] = tuple(PROFILE),
) -> DataFrame:
    """Users with a failed event and never a successful follow-up, with their profile.

    One pass, as in :func:`users_without_event`. Failures without a user stay open; having no
    user to be compared with, they are never laid out by that key.
    ``users``, when given, adds its columns by ``user_id``.
    """
    key = profile[0]
    outcomes = (
        trans.where(failed | recovered)
        .groupBy(*profile)
        .agg(
            F.max(F.coalesce(failed, F.lit(False))).alias("_failed"),
            F.max(F.coalesce(recovered, F.lit(False))).alias("_fixed"),
        )
    )
    fixed = F.max("_fixed").over(Window.partitionBy(key))
    open_cases = (
        outcomes.where(F.col(key).isNotNull())
        .withColumn("_ever_fixed", fixed)
        .where(F.col("_failed") & ~F.col("_ever_fixed"))
        .select(*profile)
        .unionByName(outcomes.where(F.col(key).isNull() & F.col("_failed")).select(*profile))
    )
    return open_cases if users is None else open_cases.join(users, "user_id", "left")


def result_trend(
    trans: DataFrame, transaction_type: str | None = None, result: str | None = None
) -> DataFrame:
    """Events per day and result, for one type and result if given."""
    kept = trans
    if transaction_type is not None:
        kept = kept.where(F.col("transaction_type") == transaction_type)
    if result is not None:
        kept = kept.where(F.col("result") == result)
    return kept.groupBy(date_prefix("transaction_stamp").alias("transaction_day"), "result").agg(
        F.count(F.lit(1)).alias("event_count")
    )


def channel_device_counts(
    trans: DataFrame, types: Sequence[str] = ("Login",), result: str = "SUCCESS"
) -> DataFrame:
    """Successful events of the given types by channel and device."""
    kept = trans.where(
        F.col("transaction_type").isin(list(types)) & (F.col("result") == result)
    )
    return kept.groupBy("channel", "device").agg(F.count(F.lit(1)).alias("event_count"))


def view_log(
    sessions: DataFrame, views: DataFrame, activity: DataFrame, trans: DataFrame
) -> DataFrame:
    """Audit views with their session, activity and the employee's branch."""
    chained = (
        sessions.join(views, "logging_session_id")
        .join(activity, ["logging_session_id", "logging_view_id"])
        .withColumn("log_date", F.to_date("create_date"))
    )
    return user_branch(trans, chained)


def update_log(
    transactions: DataFrame,
    updates: DataFrame,
    accounts: DataFrame,
    keys: DataFrame,
    values: DataFrame,
    trans: DataFrame | None = None,
) -> DataFrame:
    """Audit updates with their transaction, optional account, key and changed value.

    Keys and values meet on the column name too, so an update of several columns does
    not pair each key with each value. ``trans`` adds the employee's branch, which is looked up for
    transactions, before updates and their columns multiply them.
    """
    step = ["logging_session_id", "logging_view_id", "transaction_id"]
    update = [*step, "update_id"]
    dated = transactions.withColumn("log_date", F.to_date("create_date"))
    if trans is not None:
        dated = user_branch(trans, dated)
    found = ["log_date"] if trans is None else ["log_date", "user_branch_number"]
    # joined by update alone, rows stay where the joins before have laid them; a value meets the keys
    # of its own update only, and of those the one of its column is kept
    changed = F.col("_changed")
    chained = (
        dated.join(updates, step)
        .join(accounts, update, "left")
        .join(keys, update)
        .join(values.withColumnRenamed("column_name", "_changed"), update)
        .where(F.col("column_name").between(changed, changed))
        .drop("_changed")
    )
    first = [*update, "column_name"]
    rest = [c for c in chained.columns if c not in [*first, *found]]
    return chained.select(*first, *rest, *found)


def unresolved_users(log: DataFrame) -> DataFrame:
    """Sums of the numeric columns per employee without a branch."""
    missing = log.where(F.col("user_branch_number").isNull()).drop("user_branch_number")
    return sum_numeric(missing, ["user_id"])


def transfers_since(
    transfers: DataFrame, day: date | str, rank: str | None = None
) -> DataFrame:
    """Transfers processed after a day, newest first, with the rows of their snapshot.

    ``rank`` names a column for the position in this order.
    """
    after = transfers.where(F.col("transfer_date") > as_date(day))
    per_day = transfers.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("snapshot_rows"))
    order = [F.desc("transfer_date"), F.asc_nulls_last("transfer_id")]
    if rank is not None:
        return ranked(after, order, rank).join(per_day, "snapshot_date")
    return after.join(per_day, "snapshot_date").orderBy(*order)
