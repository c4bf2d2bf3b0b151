"""Dynamic branch assignment: the branch a customer uses now.

Order of preference: most used branch on accounts where the customer is primary,
most used on all accounts owned directly, branch of the newest account, branch of
the customer master.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions import build_account_key, date_window
from tallybook.functions.dates import as_date
from tallybook.functions.keys import ACCOUNT_TYPE_CODES
from tallybook.operators.frames import recode_values
from tallybook.operators.joins import range_join_trailing
from tallybook.operators.picks import latest_per_key, mode_per_key, most_used
from tallybook.operators.spines import day_positions, last_position, settled_spine
from tallybook.plans.conform import activity_flags

#: Customers times processing days that one task of the history sweep holds, about.
TASK_ROWS = 500_000

BRANCH_COLUMNS = ["primary_branch", "direct_branch", "acct_branch", "rm_branch", "dynamic_branch"]


def unify_teller(
    classic: DataFrame, current: DataFrame, tiebreak: Sequence[str] = ("branch_number",)
) -> DataFrame:
    """Both teller systems as (account_key, branch_number, transaction_date, transaction_id).

    Newest version of each transaction, valid owners and accounts only.
    """
    shape = ["account_key", "branch_number", "transaction_date", "transaction_id"]
    old = classic.where(
        F.col("type_of_account_1").isin(list(ACCOUNT_TYPE_CODES))
        & (F.col("cif_number") > 0)
        & (F.col("account_number_1") > 0)
    )
    old = latest_per_key(
        old.withColumn("branch_number", F.col("branch_number").try_cast("int")),
        ["composite_key"],
        "utc_timestamp",
        tiebreak,
    ).select(
        build_account_key("type_of_account_1", "account_number_1").alias("account_key"),
        "branch_number",
        F.to_date("system_date").alias("transaction_date"),
        F.col("composite_key").cast("string").alias("transaction_id"),
    )
    new = current.where((F.col("primary_owner_key") > 0) & F.col("account_key_1").isNotNull())
    new = latest_per_key(
        new.withColumn("branch_number", F.col("branch_number").try_cast("int")),
        ["transaction_id"],
        "utc_timestamp",
        tiebreak,
    ).select(
        F.col("account_key_1").alias("account_key"),
        "branch_number",
        F.to_date("transaction_date").alias("transaction_date"),
        F.col("transaction_id").cast("string").alias("transaction_id"),
    )
    return old.unionByName(new).select(*shape)


def account_branches(accounts: DataFrame, orgs: DataFrame) -> DataFrame:
    """Branch and opening day per account, both from their newest rows."""
    newest = latest_per_key(
        accounts, ["account_key"], "utc_timestamp", ["org_key", "date_opened"]
    )
    branches = latest_per_key(orgs, ["org_key"], "utc_timestamp", ["branch_id"])
    return (
        newest.join(branches.select("org_key", "branch_id"), "org_key")
        .where((F.col("branch_id") > 0) & F.col("date_opened").isNotNull())
        .select(
            "account_key",
            F.to_date("date_opened").alias("date_opened"),
            F.col("branch_id").cast("int").alias("branch_id"),
        )
    )


def _owned_usage(
    trans: DataFrame, direct: DataFrame, as_of: date | str, days: int
) -> DataFrame:
    """Transactions per customer and branch in the window, all and primary-only."""
    # counted per account first: an account with any number of transactions reaches
    # the ownership join as one row per branch
    per_account = (
        trans.where(date_window("transaction_date", as_of, days))
        .groupBy("account_key", "branch_number")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    owners = direct.select("account_key", "customer_key", "primary_customer_flag")
    primary = F.when(F.col("primary_customer_flag") == "Y", F.col("_n")).otherwise(0)
    return (
        per_account.join(owners, "account_key")
        .groupBy("customer_key", "branch_number")
        .agg(F.sum("_n").alias("direct_uses"), F.sum(primary).alias("primary_uses"))
    )


def primary_branch(
    trans: DataFrame, direct: DataFrame, as_of: date | str, days: int = 365
) -> DataFrame:
    """Most used branch on the accounts the customer is primary on."""
    used = _owned_usage(trans, direct.where(F.col("primary_customer_flag") == "Y"), as_of, days)
    return used.groupBy("customer_key").agg(
        most_used("branch_number", "primary_uses").alias("primary_branch_number")
    )


def direct_branch(
    trans: DataFrame, direct: DataFrame, as_of: date | str, days: int = 365
) -> DataFrame:
    """Most used branch on all accounts the customer owns directly."""
    used = _owned_usage(trans, direct, as_of, days)
    return used.groupBy("customer_key").agg(
        most_used("branch_number", "direct_uses").alias("direct_branch_number")
    )


def used_branches(
    trans: DataFrame, direct: DataFrame, as_of: date | str, days: int = 365
) -> DataFrame:
    """Primary and direct branch from one pass over the transactions."""
    return (
        _owned_usage(trans, direct, as_of, days)
        .groupBy("customer_key")
        .agg(
            most_used("branch_number", "primary_uses").alias("primary_branch_number"),
            most_used("branch_number", "direct_uses").alias("direct_branch_number"),
        )
    )


def account_branch(accts: DataFrame, direct: DataFrame, as_of: date | str) -> DataFrame:
    """Branch of the newest account owned directly and opened by the day."""
    opened = accts.where(F.col("date_opened") <= as_date(as_of))
    owned = opened.join(direct.select("account_key", "customer_key"), "account_key")
    return latest_per_key(owned, ["customer_key"], "date_opened", ["account_key"]).select(
        "customer_key", F.col("branch_id").alias("acct_branch_number")
    )


def dynamic_branch(
    customers: DataFrame,
    trans: DataFrame,
    direct: DataFrame,
    accts: DataFrame,
    flags: DataFrame,
    as_of: date | str,
    days: int = 365,
) -> DataFrame:
    """Branch candidates, the assigned branch and activity flags of every customer."""
    master = customers.select("customer_key", "opening_branch").distinct()
    return (
        master.join(used_branches(trans, direct, as_of, days), "customer_key", "left")
        .join(account_branch(accts, direct, as_of), "customer_key", "left")
        .join(flags, "customer_key", "left")
        .select(*_assignment_columns(as_date(as_of)))
    )


def _assignment_columns(day: Column) -> list[Column]:
    assigned = F.coalesce(
        "primary_branch_number", "direct_branch_number", "acct_branch_number", "opening_branch"
    )
    return [
        F.col("customer_key"),
        F.col("primary_branch_number"),
        F.col("direct_branch_number"),
        F.col("acct_branch_number"),
        F.col("opening_branch"),
        assigned.alias("dynamic_branch_assignment"),
        F.coalesce("is_active", F.lit("N")).alias("is_active"),
        F.coalesce("is_direct", F.lit("N")).alias("is_direct"),
        day.alias("snapshot_date"),
    ]


def ownership_runs(direct: DataFrame, spine: DataFrame) -> DataFrame:
    """Runs of processing days on which a customer owned an account in one role.

    Days are positions ``own_from`` up to, not including, ``own_until``. Ownership
    without a ``snapshot_date`` holds on every day of the spine.
    """
    role = ["account_key", "customer_key", "primary_customer_flag"]
    if "snapshot_date" not in direct.columns:
        return direct.select(
            *role,
            F.lit(1).alias("own_from"),
            (last_position(spine) + 1).alias("own_until"),
        )
    seqs = F.broadcast(spine.select("snapshot_date", "seq"))  # bounded by the calendar
    daily = direct.join(seqs, "snapshot_date").select(*role, "seq").distinct()
    # within a run, position and row number rise together
    run = F.col("seq") - F.row_number().over(Window.partitionBy(*role).orderBy("seq"))
    return (
        daily.withColumn("_run", run)
        .groupBy(*role, "_run")
        .agg(F.min("seq").alias("own_from"), (F.max("seq") + 1).alias("own_until"))
        .drop("_run")
    )


def _sweep_tasks(customers: DataFrame, direct: DataFrame, spine: DataFrame) -> int:
    """Tasks for a sweep over all customers, each with about :data:`TASK_ROWS` rows of the result.

    A customer has at most one change point per processing day. The bytes exchanged say little about that,
    and tasks put together by them hold more customers the larger the input is.
    """
    people = customers.select("customer_key").union(direct.select("customer_key"))
    many = people.agg(F.approx_count_distinct("customer_key")).first()[0]  # one number
    rows = many * spine.count()
    return max(-(-rows // TASK_ROWS), spine.sparkSession.sparkContext.defaultParallelism)


def _by_customer(df: DataFrame, tasks: int | None) -> DataFrame:
    return df.repartition("customer_key") if tasks is None else df.repartition(tasks, "customer_key")


def used_branch_points(
    trans: DataFrame, runs: DataFrame, spine: DataFrame, days: int = 365, tasks: int | None = None
) -> DataFrame:
    """Primary and direct branch per customer from each position (``seq``) on where counts change.

    ``tasks`` is the number of tasks customers are dealt to. Each transaction adds to a branch's count on the first day whose window holds it
    and takes it off again on the first day after. Those two changes, summed per
    customer and branch, replace a pass over the trailing year for every day.
    """
    placed = range_join_trailing(
        trans.select("account_key", "branch_number", "transaction_date"),
        spine,
        "transaction_date",
        days,
    )
    # an account with any number of transactions reaches the ownership join with at most
    # one row per branch and pair of positions
    per_account = placed.groupBy("account_key", "branch_number", "seq_from", "seq_until").agg(
        F.count(F.lit(1)).alias("_n")
    )
    start = F.greatest("seq_from", "own_from")
    stop = F.least("seq_until", "own_until")
    primary = F.when(F.col("primary_customer_flag") == "Y", F.col("_n")).otherwise(0)
    shared = (
        per_account.join(runs, "account_key")
        .where(start < stop)
        .select(
            "customer_key",
            "branch_number",
            F.explode(
                F.array(
                    F.struct(
                        start.alias("seq"), F.col("_n").alias("d"), primary.alias("p")
                    ),
                    F.struct(
                        stop.alias("seq"), (-F.col("_n")).alias("d"), (-primary).alias("p")
                    ),
                )
            ).alias("c"),
        )
    )
    changes = shared.groupBy("customer_key", "branch_number", F.col("c.seq").alias("seq")).agg(
        F.sum("c.d").alias("_d"), F.sum("c.p").alias("_p")
    )
    # at most two changes per processing day and branch reach this window; laid out by
    # customer, where all that follows stays
    changes = _by_customer(changes.where("_d != 0 OR _p != 0"), tasks)
    order = Window.partitionBy("customer_key", "branch_number").orderBy("seq")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    point = F.dense_rank().over(Window.partitionBy("customer_key").orderBy("seq"))
    running = changes.withColumn("_point", point).select(
        "customer_key",
        "seq",
        "_point",
        F.lead("_point").over(order).alias("_next"),
        "branch_number",
        F.sum("_d").over(upto).alias("direct_uses"),
        F.sum("_p").over(upto).alias("primary_uses"),
    )
    return _at_points(running, F.col("direct_uses") > 0).agg(
        F.max("_seq").alias("seq"),
        most_used("branch_number", "primary_uses").alias("primary_branch_number"),
        most_used("branch_number", "direct_uses").alias("direct_branch_number"),
    )


def _at_points(rows: DataFrame, holds: Column):
    """Rows at each change point of their customer from their own to the next of their kind.

    ``_point`` numbers a customer's change points, so a row that holds goes to all points it spans and
    one that does not only to its own, which then exists. ``_seq`` is the point's day.
    """
    last = F.when(holds, F.coalesce(F.col("_next") - 1, F.col("_point"))).otherwise(F.col("_point"))
    spread = rows.withColumn("_at", F.explode(F.sequence("_point", last)))
    day = F.when(F.col("_at") == F.col("_point"), F.col("seq"))
    return spread.withColumn("_seq", day).groupBy("customer_key", "_at")


def account_branch_points(
    accts: DataFrame, runs: DataFrame, spine: DataFrame, tasks: int | None = None
) -> DataFrame:
    """Branch of the newest account owned directly, per customer from each position where that changes."""
    # an account opened before the spine is open on its first day
    positions = F.broadcast(day_positions(spine))  # bounded by the calendar
    first_day = spine.agg(F.min("snapshot_date")).scalar()
    clamped = (
        accts.withColumn("day", F.greatest(F.col("date_opened"), first_day))
        .join(positions, "day")
        .select("account_key", "date_opened", "branch_id", F.col("seq").alias("_open"))
    )
    start = F.greatest("_open", "own_from")
    newest = F.struct(
        (-F.datediff("date_opened", F.lit("1970-01-01"))).alias("age"),
        F.col("account_key").alias("account"),
        F.col("branch_id").alias("branch"),
    )
    owned = clamped.join(runs, "account_key").where(start < F.col("own_until"))
    spans = owned.groupBy("customer_key", start.alias("_from"), "own_until").agg(
        F.min(newest).alias("_best")
    )
    spans = _by_customer(spans, tasks)
    # a newer account that lasts as long hides the rest of the span before it
    order = Window.partitionBy("customer_key").orderBy("_from", "_best")
    hidden = (F.lead("_best").over(order) < F.col("_best")) & (
        F.lead("own_until").over(order) >= F.col("own_until")
    )
    next_from = F.when(hidden, F.lead("_from").over(order))
    until = F.least(next_from, F.col("own_until")).cast("int")
    shown = spans.withColumn("_until", until).where(F.col("_from") < F.col("_until"))
    ends = F.array(
        F.struct(F.col("_from").alias("seq"), F.col("_best").alias("best")),
        F.struct(F.col("_until").alias("seq"), F.lit(None).cast(spans.schema["_best"].dataType).alias("best")),
    )
    rows = shown.select("customer_key", "_from", "_until", F.inline(ends))
    point = F.dense_rank().over(Window.partitionBy("customer_key").orderBy("seq"))
    span = Window.partitionBy("customer_key", "_from", "_until").orderBy("seq")
    placed = rows.withColumn("_point", point).withColumn("_next", F.lead("_point").over(span))
    picks = _at_points(placed, F.col("best").isNotNull()).agg(
        F.max("_seq").alias("seq"), F.min("best").alias("_best")
    )
    return picks.select("customer_key", "seq", F.col("_best")["branch"].alias("acct_branch_number"))


def branch_runs(
    trans: DataFrame,
    accts: DataFrame,
    runs: DataFrame,
    spine: DataFrame,
    days: int = 365,
    tasks: int | None = None,
) -> DataFrame:
    """Primary, direct and newest-account branch per customer and run of processing days.

    Positions ``seq_from`` up to, not including, ``seq_until`` (null: to the end). A sweep over the
    customer's change points: what holds between two of them is decided once at the first.
    """
    used = used_branch_points(trans, runs, spine, days, tasks)
    both = F.struct("primary_branch_number", "direct_branch_number")
    newest = F.struct("acct_branch_number")
    opened = account_branch_points(accts, runs, spine, tasks)
    points = used.select("customer_key", "seq", both.alias("_used")).unionByName(
        opened.select("customer_key", "seq", newest.alias("_newest")), allowMissingColumns=True
    )
    order = Window.partitionBy("customer_key").orderBy("seq", F.asc_nulls_first("_used"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = points.select(
        "customer_key",
        F.col("seq").alias("seq_from"),
        F.lead("seq").over(order).alias("seq_until"),
        F.last("_used", ignorenulls=True).over(upto).alias("_used"),
        F.last("_newest", ignorenulls=True).over(upto).alias("_newest"),
    )
    # of two kinds of change on a day the second row has both
    kept = states.where("seq_until IS NULL OR seq_from < seq_until")
    return kept.select("customer_key", "seq_from", "seq_until", "_used.*", "_newest.*")


_PICKED = ["primary_branch_number", "direct_branch_number", "acct_branch_number"]


def _spread(master: DataFrame, picks: DataFrame, spine: DataFrame) -> DataFrame:
    """Rows that hold on every day, joined with their customer's runs and spread over the days once."""
    last = last_position(spine)
    own = F.struct(
        F.coalesce("seq_from", F.lit(1)).alias("from_seq"),
        F.coalesce(F.col("seq_until") - 1, last).alias("to_seq"),
        *_PICKED,
    )
    # the days before a customer's first change point
    nothing = [F.lit(None).cast(picks.schema[c].dataType).alias(c) for c in _PICKED]
    before = F.struct(
        F.lit(1).alias("from_seq"), (F.col("seq_from") - 1).alias("to_seq"), *nothing
    )
    first = F.row_number().over(Window.partitionBy("customer_key").orderBy("seq_from"))
    opening = F.when((F.col("_nth") == 1) & (F.col("seq_from") > 1), before)
    earliest = picks.withColumn("_nth", first)
    joined = master.join(earliest, "customer_key", "left")
    parts = joined.select(*master.columns, F.inline(F.array_compact(F.array(opening, own))))
    days = F.explode(F.sequence("from_seq", "to_seq"))
    return parts.where("from_seq <= to_seq").select(*master.columns, *_PICKED, days.alias("seq"))


def _carried(master: DataFrame, picks: DataFrame) -> DataFrame:
    """Daily rows, each with the picks of the last change point on or before its day."""
    at = picks.select(
        "customer_key", F.col("seq_from").alias("seq"), F.struct(*_PICKED).alias("_picks")
    )
    both = at.unionByName(master.withColumn("_daily", F.lit(True)), allowMissingColumns=True)
    order = Window.partitionBy("customer_key").orderBy("seq", F.asc_nulls_first("_daily"))
    carried = F.last("_picks", ignorenulls=True).over(order)
    daily = both.withColumn("_held", carried).where("_daily")
    return daily.select(*master.columns, *[F.col("_held")[c].alias(c) for c in _PICKED])


def dynamic_branch_history(
    customers: DataFrame,
    trans: DataFrame,
    direct: DataFrame,
    accts: DataFrame,
    flags: DataFrame,
    spine: DataFrame,
    days: int = 365,
) -> DataFrame:
    """:func:`dynamic_branch` for every processing day of the spine in one plan.

    ``customers``, ``direct`` and ``flags`` are daily when they carry a
    ``snapshot_date``; otherwise the same rows hold on every day. The spine is computed once, when the
    plan is made, and customers are counted then, approximately, for the number of tasks.
    """
    spine = settled_spine(spine)
    seqs = F.broadcast(spine.select("snapshot_date", "seq"))  # bounded by the calendar
    tasks = _sweep_tasks(customers, direct, spine)
    picks = branch_runs(trans, accts, ownership_runs(direct, spine), spine, days, tasks)
    daily = [x for x in (customers, flags) if "snapshot_date" in x.columns]
    if not daily:
        master = customers.select("customer_key", "opening_branch").distinct()
        flagged = _by_customer(master.join(flags, "customer_key", "left"), tasks)
        spread = _spread(flagged, picks, spine)
        return spread.join(seqs, "seq").select(*_assignment_columns(F.col("snapshot_date")))
    at = ["customer_key", "snapshot_date"]
    key = [c for c in at if c in customers.columns]
    master = customers.select(*key, "opening_branch").distinct()
    if "snapshot_date" not in customers.columns:
        # one array with an entry per calendar day at most
        all_days = spine.agg(F.collect_list("snapshot_date")).scalar()
        master = master.withColumn("snapshot_date", F.explode(all_days))
    master = master.join(flags, [c for c in at if c in flags.columns], "left")
    master = _by_customer(master.join(seqs, "snapshot_date"), tasks)
    return _carried(master, picks).select(*_assignment_columns(F.col("snapshot_date")))


def assignment_with_names(assignments: DataFrame, branch_lookup: DataFrame) -> DataFrame:
    """Id and name text per branch column; a branch without a name keeps its id.

    ``branch_lookup`` has ``branch_id``, ``branch_description`` and ``utc_timestamp``;
    the newest description of a branch counts.
    """
    names = latest_per_key(
        branch_lookup, ["branch_id"], "utc_timestamp", ["branch_description"]
    ).select(F.col("branch_id").cast("string").alias("branch_id"), "branch_description")
    source = {
        "primary_branch": "primary_branch_number",
        "direct_branch": "direct_branch_number",
        "acct_branch": "acct_branch_number",
        "rm_branch": "opening_branch",
        "dynamic_branch": "dynamic_branch_assignment",
    }
    both = [
        F.col(source[c]).cast("string").alias(f"{c}_{part}")
        for c in BRANCH_COLUMNS
        for part in ("id", "name")
    ]
    text = assignments.select("customer_key", *both, "is_active", "is_direct", "snapshot_date")
    columns = text.columns
    named = recode_values(
        text, [f"{c}_name" for c in BRANCH_COLUMNS], names, "branch_id", "branch_description"
    )
    return named.select(*columns)


def monthly_majority(assignments: DataFrame, officers: DataFrame) -> DataFrame:
    """Most frequent branch and officer per customer and month.

    Only days on which the customer was direct and had a primary or direct branch.
    """
    kept = assignments.where(
        (F.col("is_direct") == "Y")
        & (F.col("primary_branch_name").isNotNull() | F.col("direct_branch_name").isNotNull())
    ).select("customer_key", "dynamic_branch_name", "snapshot_date")
    daily_officers = officers.select("customer_key", "snapshot_date", "primary_officer").distinct()
    daily = kept.join(daily_officers, ["customer_key", "snapshot_date"], "left").withColumn(
        "me_utc_timestamp", F.last_day("snapshot_date")
    )
    month = ["customer_key", "me_utc_timestamp"]
    # days are counted once for both picks
    counted = daily.groupBy(*month, "dynamic_branch_name", "primary_officer").agg(
        F.count(F.lit(1)).alias("_days")
    )
    branch = mode_per_key(counted, month, "dynamic_branch_name", weight="_days")
    officer = mode_per_key(counted, month, "primary_officer", weight="_days").withColumnRenamed(
        "primary_officer", "dynamic_officer_assignment"
    )
    return branch.join(officer, month)


def reprocess_flags(
    assignments: DataFrame, base: DataFrame, legacy_active: bool = False
) -> DataFrame:
    """Replace the activity flags of already written days from each day's base."""
    key = ["customer_key", "snapshot_date"]
    flags = activity_flags(base, ["snapshot_date"], legacy_active)
    kept = assignments.drop("is_active", "is_direct")
    joined = kept.join(flags, key, "left").fillna("N", subset=["is_active", "is_direct"])
    order = [c for c in kept.columns if c != "snapshot_date"]
    return joined.select(*order, "is_active", "is_direct", "snapshot_date")


def user_branch(
    trans: DataFrame, logs: DataFrame, user: str = "user_id", day: str = "log_date"
) -> DataFrame:
    """Log rows with the employee's branch: most used that day, else most used ever.

    An employee's days become one row, an entry per calendar day at most, so that log rows, of which there
    may be many times more, are laid out by employee once for both picks.
    """
    # transactions are counted once for both picks, then laid out by employee, where all else is done
    counted = trans.where(F.col("user_id").isNotNull()).groupBy(
        "user_id", "transaction_date", "branch_number"
    ).agg(F.count(F.lit(1)).alias("_n"))
    by_use = [F.desc("_n"), F.asc_nulls_last("branch_number")]
    on_day = F.row_number().over(Window.partitionBy("user_id", "transaction_date").orderBy(*by_use))
    ever = F.sum("_n").over(Window.partitionBy("user_id", "branch_number"))
    picked = counted.repartition("user_id").withColumns({"_nth": on_day, "_total": ever})
    branch = F.col("branch_number")
    first = (F.col("_nth") == 1) & F.col("transaction_date").isNotNull()
    most = F.struct((-F.col("_total")).alias("uses"), branch.isNull().alias("none"), branch)
    days = F.collect_list(F.when(first, F.struct("transaction_date", "branch_number")))
    users = picked.groupBy(F.col("user_id").alias(user)).agg(
        F.map_from_entries(days).alias("_days"), F.min(most)["branch_number"].alias("_ever")
    )
    rest = [c for c in logs.columns if c not in (user, day)]
    found = F.coalesce(F.col("_days")[F.col(day)], "_ever").alias("user_branch_number")
    return logs.join(users, user, "left").select(user, day, *rest, found)


def latest_assignment(assignments: DataFrame, branch: str = "dynamic_branch_name") -> DataFrame:
    """Newest assigned branch per customer."""
    newest = latest_per_key(assignments, ["customer_key"], "snapshot_date", [branch])
    return newest.select("customer_key", branch)
