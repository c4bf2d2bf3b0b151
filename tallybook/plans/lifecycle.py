"""Customers gained and lost between processing days, and the ledger of their dates.

The ledger keeps per customer the original acquisition date, the most recent one and
the most recent lost date. It is computed for all days at once: a customer's gains and
losses come from the neighbours of each day of presence, and ledger states are runs of
days between those events.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.functions.dates import as_date
from tallybook.functions.keys import normalize_key
from tallybook.operators.picks import latest_per_key
from tallybook.operators.spines import last_position
from tallybook.operators.upserts import upsert
from tallybook.plans.conform import LIVE_STATUSES
from tallybook.sources.keyed import read_keyed

_WORD = 63  # days in a word of presence; the sign bit stays clear
_MOST_WORDS = 100  # columns of presence; with more days a customer's days travel as a set

LEDGER_COLUMNS = [
    "customer_key",
    "original_acquisition_date",
    "most_recent_acquisition_date",
    "most_recent_lost_date",
]


def eligible_customers(base: DataFrame) -> DataFrame:
    """Customers present on a day: direct owners of a live product that is no service."""
    return (
        base.where(
            (F.col("ownership_type") == "Direct")
            & (F.col("product_group") != "Services")
            & F.col("conformed_status").isin(LIVE_STATUSES)
        )
        .select("customer_key", "snapshot_date")
        .distinct()
    )


def snapshot_diff(presence: DataFrame, spine: DataFrame) -> DataFrame:
    """Customers acquired or lost, by the processing day that shows it.

    ``acquired_on`` is the day itself. ``lost_on`` is the prior processing day, the
    last one the customer was on. Nobody is acquired on the first day. The spine is computed once, when the
    plan is made; a customer travels as one bit per day.
    """
    known = spine.select("snapshot_date", "seq", "prior_date", "next_date").toArrow()
    days = F.broadcast(spine.sparkSession.createDataFrame(known))  # bounded by the calendar, see spines
    rows = known.to_pylist()
    first = min((r["seq"] for r in rows), default=1)
    words = (max((r["seq"] for r in rows), default=1) - first) // _WORD + 1
    if words > _MOST_WORDS:
        return _diff_of_sets(presence, days)
    # a customer's presence is a bit per day; a word of it merges before the exchange
    place = F.col("seq") - first
    shift = F.pmod(place, F.lit(_WORD)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)
    nothing = F.lit(0).cast("bigint")
    merged = [
        F.coalesce(F.bit_or(F.when(F.floor(place / _WORD) == i, bit)), nothing).alias(f"_w{i}")
        for i in range(words)
    ]
    on = (
        presence.join(days.select("snapshot_date", "seq"), "snapshot_date")
        .groupBy("customer_key")
        .agg(*merged)
    )
    gained, left = [], []
    for i in range(words):
        own = F.col(f"_w{i}")
        before = F.shiftrightunsigned(f"_w{i - 1}", _WORD - 1) if i else nothing
        after = F.shiftleft(f"_w{i + 1}", _WORD - 1) if i + 1 < words else nothing
        came = own.bitwiseAND(F.bitwise_not(F.shiftleft(own, 1).bitwiseOR(before)))
        went = own.bitwiseAND(F.bitwise_not(F.shiftrightunsigned(own, 1).bitwiseOR(after)))
        # nobody is acquired without a day before, or lost without one after
        gained.append(came.bitwiseAND(F.lit(_word(rows, first, i, "prior_date")).cast("bigint")))
        left.append(went.bitwiseAND(F.lit(_word(rows, first, i, "next_date")).cast("bigint")))
    moves = F.concat(
        F.transform(_positions(gained, first), lambda s: F.struct(s.alias("seq"), F.lit(True).alias("_gained"))),
        F.transform(_positions(left, first), lambda s: F.struct(s.alias("seq"), F.lit(False).alias("_gained"))),
    )
    return _moves(on.select("customer_key", F.inline(moves)).join(days, "seq"))


def _diff_of_sets(presence: DataFrame, days: DataFrame) -> DataFrame:
    """:func:`snapshot_diff` for more days than fit the words: a customer's positions as a set."""
    on = (
        presence.join(days.select("snapshot_date", "seq"), "snapshot_date")
        .groupBy("customer_key")
        .agg(F.sort_array(F.collect_set("seq")).alias("_on"))
    )
    first = F.filter("_on", lambda s, i: ~F.get("_on", i - 1).eqNullSafe(s - 1))
    last = F.filter("_on", lambda s, i: ~F.get("_on", i + 1).eqNullSafe(s + 1))
    moves = F.concat(
        F.transform(first, lambda s: F.struct(s.alias("seq"), F.lit(True).alias("_gained"))),
        F.transform(last, lambda s: F.struct(s.alias("seq"), F.lit(False).alias("_gained"))),
    )
    shown = on.select("customer_key", F.inline(moves)).join(days, "seq")
    neighbour = F.when(F.col("_gained"), F.col("prior_date")).otherwise(F.col("next_date"))
    return _moves(shown.where(neighbour.isNotNull()))


def _moves(shown: DataFrame) -> DataFrame:
    day, came = F.col("snapshot_date"), F.col("_gained")
    return shown.select(
        "customer_key",
        F.when(came, day).otherwise(F.col("next_date")).alias("processing_date"),
        F.when(came, day).alias("acquired_on"),
        F.when(~came, day).alias("lost_on"),
    )


def _word(rows: list[dict], first: int, i: int, neighbour: str) -> int:
    """Bits of the days of word ``i`` that have the neighbour."""
    return sum(
        1 << (r["seq"] - first) % _WORD
        for r in rows
        if r[neighbour] is not None and (r["seq"] - first) // _WORD == i
    )


def _positions(words: list[Column], first: int) -> Column:
    """Positions of the set bits, found one by one from the lowest; words without any cost nothing."""
    one = F.lit(1).cast("bigint")

    def lowest(state: Column, _: Column) -> Column:
        rest = state["rest"]
        low = rest.bitwiseAND(-rest)
        return F.struct(
            rest.bitwiseXOR(low).alias("rest"),
            F.array_append(state["found"], F.bit_count(low - one)).alias("found"),
        )

    def placed(word: Column, shift: int) -> Column:
        start = F.struct(word.alias("rest"), F.lit([]).cast("array<int>").alias("found"))
        turns = F.slice(F.lit(list(range(_WORD))), 1, F.bit_count(word))
        return F.transform(F.aggregate(turns, start, lowest)["found"], lambda b: b + F.lit(shift))

    return F.concat(*[placed(word, first + i * _WORD) for i, word in enumerate(words)])


def seed_ledger(master: DataFrame, tiebreak: Sequence[str] = ("date_customer_added",)) -> DataFrame:
    """Starting ledger from year-end customer masters: newest record per customer."""
    keyed = master.withColumn("customer_key", normalize_key("customer_key"))
    newest = latest_per_key(keyed, ["customer_key"], "snapshot_date", tiebreak)
    nothing = F.lit(None).cast("date")
    return newest.select(
        "customer_key",
        F.to_date("date_customer_added").alias("original_acquisition_date"),
        nothing.alias("most_recent_acquisition_date"),
        nothing.alias("most_recent_lost_date"),
    )


def acquisition_ledger(seed: DataFrame, events: DataFrame) -> DataFrame:
    """Ledger after all events.

    A customer enters by the seed or by the first acquisition; losses before that are
    dropped. Losses of a processing day apply before its acquisitions.
    """
    per_customer = events.groupBy("customer_key").agg(
        F.min(F.when(F.col("acquired_on").isNotNull(), F.col("processing_date"))).alias("_entry"),
        F.min("acquired_on").alias("_first_acquired"),
        F.max("acquired_on").alias("_last_acquired"),
        F.max(F.when(F.col("lost_on").isNotNull(), F.col("processing_date"))).alias("_loss"),
        F.max("lost_on").alias("_last_lost"),
    )
    known = seed.withColumn("_seeded", F.lit(True))
    both = known.join(per_customer, "customer_key", "full")
    seeded = F.col("_seeded").isNotNull()
    counted = seeded | (F.col("_loss") > F.col("_entry"))
    return both.where(seeded | F.col("_entry").isNotNull()).select(
        "customer_key",
        F.when(seeded, F.col("original_acquisition_date"))
        .otherwise(F.col("_first_acquired"))
        .alias("original_acquisition_date"),
        F.coalesce("_last_acquired", "most_recent_acquisition_date").alias(
            "most_recent_acquisition_date"
        ),
        F.coalesce(F.when(counted, F.col("_last_lost")), "most_recent_lost_date").alias(
            "most_recent_lost_date"
        ),
    )


def ledger_runs(seed: DataFrame, events: DataFrame, spine: DataFrame) -> DataFrame:
    """Ledger states with the run of processing days each one holds.

    Days are positions ``seq_from`` to ``seq_to``. The first processing day has nothing
    to compare with, so states start at position 2. One row per customer and change.
    """
    days = F.broadcast(spine.select(F.col("snapshot_date").alias("processing_date"), "seq"))
    nothing = F.lit(None).cast("date")
    opening = seed.select(
        "customer_key",
        F.lit(2).alias("seq"),
        F.col("original_acquisition_date").alias("_seed_original"),
        F.col("most_recent_acquisition_date").alias("_acquired"),
        F.col("most_recent_lost_date").alias("_lost"),
        F.lit(True).alias("_seeded"),
    )
    changes = events.join(days, "processing_date").select(
        "customer_key",
        "seq",
        nothing.alias("_seed_original"),
        F.col("acquired_on").alias("_acquired"),
        F.col("lost_on").alias("_lost"),
        F.lit(False).alias("_seeded"),
    )
    # at most a seed and one event per processing day and customer reach these windows.
    # Of rows for the same day the last one sees all, and the runs of the others are empty
    own = Window.partitionBy("customer_key").orderBy(
        "seq", F.desc("_seeded"), F.asc_nulls_first("_acquired")
    )
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    entered = opening.unionByName(changes).withColumn(
        "_entered",
        F.max(F.col("_seeded") | F.col("_acquired").isNotNull()).over(upto),
    ).where("_entered")
    states = entered.select(
        "customer_key",
        F.when(F.max("_seeded").over(upto), F.max("_seed_original").over(upto))
        .otherwise(F.min("_acquired").over(upto))
        .alias("original_acquisition_date"),
        F.max("_acquired").over(upto).alias("most_recent_acquisition_date"),
        F.max("_lost").over(upto).alias("most_recent_lost_date"),
        F.col("seq").alias("seq_from"),
        F.coalesce(F.lead("seq").over(own) - 1, last_position(spine)).alias("seq_to"),
    )
    return states.where(F.col("seq_from") <= F.col("seq_to"))


def ledger_history(seed: DataFrame, events: DataFrame, spine: DataFrame) -> DataFrame:
    """Ledger as of every processing day: the dated snapshots, all days at once."""
    days = F.broadcast(spine.select("snapshot_date", "seq"))  # bounded by the calendar
    spread = ledger_runs(seed, events, spine).withColumn(
        "seq", F.explode(F.sequence("seq_from", "seq_to"))
    )
    return spread.join(days, "seq").select(*LEDGER_COLUMNS, "snapshot_date")


def _events_since(
    presence: DataFrame, spine: DataFrame, since: date | str
) -> DataFrame:
    """Gains and losses of the processing days after ``since``; earlier days are not read."""
    needed = spine.where((F.col("next_date") > as_date(since)) | F.col("next_date").isNull())
    # a scalar subquery prunes partitions when the plan runs, which a semi join would not
    done = spine.where(F.col("snapshot_date") <= as_date(since)).agg(F.max("snapshot_date"))
    start = F.coalesce(done.scalar(), F.lit("0001-01-01").cast("date"))
    recent = presence.where(F.col("snapshot_date") >= start)
    fresh = F.col("prior_date") >= F.lit(since).cast("date")
    short = needed.withColumn("prior_date", F.when(fresh, F.col("prior_date")))
    return snapshot_diff(recent, short)


def _entered_by(ledger: DataFrame, since: date | str) -> DataFrame:
    """Customers that entered on the days being done again enter anew."""
    entered = F.col("original_acquisition_date")
    return ledger.where(entered.isNull() | (entered <= as_date(since)))


def ledger_incremental(
    ledger: DataFrame, presence: DataFrame, spine: DataFrame, since: date | str
) -> DataFrame:
    """Ledger brought up to date with the processing days after ``since``.

    Only those days and the one before them are compared, and of a tree that is partitioned
    by day only those are read. The result is a new version
    for :func:`~tallybook.sources.writers.replace_table`; doing it again changes nothing.
    """
    events = _events_since(presence, spine, since)
    touched = events.select("customer_key").distinct()
    known = _entered_by(ledger, since).join(touched, "customer_key", "left_semi")
    return upsert(ledger, acquisition_ledger(known, events), ["customer_key"])


def ledger_changes(
    spark: SparkSession, table: str, presence: DataFrame, spine: DataFrame, since: date | str
) -> DataFrame:
    """Ledger rows of the customers that came or left after ``since``, as they should be.

    ``table`` is a ledger written by :func:`~tallybook.sources.keyed.write_keyed_table`, of which only
    the groups of these customers are read. The result is the change set for
    :func:`~tallybook.sources.keyed.merge_keyed`.
    """
    events = _events_since(presence, spine, since)
    known = _entered_by(read_keyed(spark, table, events), since)
    return acquisition_ledger(known, events)


def customer_status_flags(
    runs: DataFrame,
    spine: DataFrame,
    min_return_days: int = 180,
    fraud_days: int = 5,
) -> DataFrame:
    """New, returning, lost and re-lost customers by processing day (flags 1 or null).

    Works on ledger runs: a customer counts on the day its own date names, when that
    day lies in the run, so nothing is spread over days without events. A customer back
    within ``fraud_days`` of a loss is left out; returning needs an absence longer than
    ``min_return_days``.
    """
    recent = F.coalesce("most_recent_acquisition_date", "original_acquisition_date")
    away = F.datediff(recent, "most_recent_lost_date")
    states = runs.select(
        "customer_key",
        "seq_from",
        "seq_to",
        F.col("original_acquisition_date").alias("_original"),
        recent.alias("_recent"),
        away.alias("_away"),
        F.col("most_recent_lost_date").alias("_lost"),
    ).where(F.col("_away").isNull() | ~F.col("_away").between(0, fraud_days - 1))
    same = F.col("_recent") == F.col("_original")

    def candidate(day: str, kind: str):
        return F.struct(F.col(day).alias("_day"), F.lit(kind).alias("_kind"))

    returned = F.when(~same & (F.col("_away") > min_return_days), candidate("_recent", "returning"))
    named = states.withColumn(
        "_c",
        F.explode(
            F.array_compact(
                F.array(candidate("_original", "new"), returned, candidate("_lost", "lost"))
            )
        ),
    )
    # a loss shows on the processing day after the lost date, the others on their own day
    own_day = F.struct(F.col("snapshot_date").alias("_day"), F.lit("acquired").alias("_side"))
    day_after = F.struct(F.col("prior_date").alias("_day"), F.lit("lost").alias("_side"))
    days = spine.select("snapshot_date", "seq", F.inline(F.array(own_day, day_after)))
    side = F.when(F.col("_c._kind") == "lost", "lost").otherwise("acquired")
    shown = (
        named.withColumns({"_day": F.col("_c._day"), "_side": side})
        .join(F.broadcast(days), ["_day", "_side"])  # bounded by the calendar
        .where(F.col("seq").between(F.col("seq_from"), F.col("seq_to")))
    )
    kind = F.col("_c._kind")
    return shown.select(
        "snapshot_date",
        "customer_key",
        F.when(kind == "new", 1).alias("new_customer_flag"),
        F.when(kind == "returning", 1).alias("returning_customer_flag"),
        F.when((kind == "lost") & same, 1).alias("lost_customer_flag"),
        F.when((kind == "lost") & ~same, 1).alias("relost_customer_flag"),
        F.when(kind == "lost", F.col("_recent")).alias("most_recent_acquisition_date"),
    )


def with_branch(flags: DataFrame, assignments: DataFrame) -> DataFrame:
    """Flags with the branch id and name assigned to the customer that day."""
    branch = assignments.select(
        "customer_key", "snapshot_date", "dynamic_branch_id", "dynamic_branch_name"
    )
    return flags.join(branch, ["customer_key", "snapshot_date"], "left")


def reconcile(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Keys whose values differ between two versions, nulls and missing rows included."""
    left = a.select(key, *[F.col(c).alias(f"{c}_a") for c in cols], F.lit(True).alias("in_a"))
    right = b.select(key, *[F.col(c).alias(f"{c}_b") for c in cols], F.lit(True).alias("in_b"))
    both = left.join(right, key, "full").fillna(False, subset=["in_a", "in_b"])
    differs = ~(F.col("in_a") & F.col("in_b"))
    for c in cols:
        differs = differs | ~F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b"))
    return both.where(differs)


def misdated_rows(df: DataFrame, expected: str, feed: str = "feed") -> DataFrame:
    """Rows per feed, and those whose stamp is not the expected day (null counts)."""
    wrong = ~F.col("snapshot_date").eqNullSafe(F.col(expected))
    return df.groupBy(feed).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(F.when(wrong, 1)).alias("misdated_count"),
    )

