"""Ledger in one pass against the day-by-day loop it replaces."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallybook.operators import processing_dates
from tallybook.plans import lifecycle as lc

DAY0 = date(2022, 1, 3)
PRESENCE = "customer_key long, snapshot_date date"
SEED = (
    "customer_key long, original_acquisition_date date, "
    "most_recent_acquisition_date date, most_recent_lost_date date"
)


def random_presence(seed: int, customers: int = 60, count: int = 14):
    rng = random.Random(seed)
    calendar, day = [], DAY0
    for _ in range(count):
        calendar.append(day)
        day += timedelta(days=rng.choice([1, 1, 1, 3, 4, 7, 200]))
    here = {d: set() for d in calendar}
    for customer in range(customers):
        present = rng.random() < 0.5
        for d in calendar:
            if rng.random() < 0.3:
                present = not present
            if present:
                here[d].add(customer)
    here[calendar[0]].add(-1)  # somebody on every day, so that each day has a file
    for d in calendar:
        here[d].add(-1)
    seeded = {c: DAY0 - timedelta(days=rng.randint(0, 900)) for c in range(0, customers, 2)}
    return calendar, here, seeded


def loop(calendar, here, seeded):
    """Reference result: one merge of lost and one of acquired customers per day."""
    ledger = {c: [d, None, None] for c, d in seeded.items()}
    events, history = [], []
    for prior, current in zip(calendar, calendar[1:]):
        for c in here[prior] - here[current]:
            events.append((c, current, None, prior))
            if c in ledger:
                ledger[c][2] = prior
        for c in here[current] - here[prior]:
            events.append((c, current, current, None))
            if c in ledger:
                ledger[c][1] = current
            else:
                ledger[c] = [current, current, None]
        history += [(c, *v, current) for c, v in ledger.items()]
    return events, [(c, *v) for c, v in ledger.items()], history


def flags_of(history, calendar, min_return, fraud):
    prior_of = dict(zip(calendar[1:], calendar))
    out = []
    for c, original, acquired, lost, day in history:
        recent = acquired or original
        away = (recent - lost).days if lost else None
        if away is not None and 0 <= away < fraud:
            continue
        if original == day:
            out.append((day, c, 1, None, None, None, None))
        if recent == day and recent != original and away is not None and away > min_return:
            out.append((day, c, None, 1, None, None, None))
        if lost == prior_of[day]:
            same = recent == original
            out.append((day, c, None, None, 1 if same else None, None if same else 1, recent))
    return out


def as_text(values):
    out = [tuple(v.isoformat() if isinstance(v, date) else v for v in r) for r in values]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def frames(spark, calendar, here, seeded):
    presence = spark.createDataFrame([(c, d) for d in calendar for c in here[d]], PRESENCE)
    seed = spark.createDataFrame([(c, d, None, None) for c, d in seeded.items()], SEED)
    return presence, seed, processing_dates(presence)


@pytest.mark.parametrize("case", range(4))
def test_one_pass_equals_the_loop(spark, rows, case):
    calendar, here, seeded = random_presence(case)
    events, ledger, history = loop(calendar, here, seeded)
    presence, seed, spine = frames(spark, calendar, here, seeded)
    diff = lc.snapshot_diff(presence.unionByName(presence), spine)
    assert rows(diff) == as_text(events)
    assert rows(lc.acquisition_ledger(seed, diff)) == as_text(ledger)
    assert rows(lc.ledger_history(seed, diff, spine)) == as_text(history)
    runs = lc.ledger_runs(seed, diff, spine)
    flags = lc.customer_status_flags(runs, spine, 20, 5)
    assert rows(flags) == as_text(flags_of(history, calendar, 20, 5))


@pytest.mark.parametrize("case", range(2))
def test_catching_up_equals_a_full_run_and_is_repeatable(spark, rows, case):
    calendar, here, seeded = random_presence(10 + case)
    presence, seed, spine = frames(spark, calendar, here, seeded)
    full = lc.acquisition_ledger(seed, lc.snapshot_diff(presence, spine))
    cut = calendar[8]
    early = presence.where(F.col("snapshot_date") <= F.lit(cut))
    first = lc.acquisition_ledger(seed, lc.snapshot_diff(early, processing_dates(early)))
    caught_up = lc.ledger_incremental(first, presence, spine, cut)
    assert rows(caught_up) == rows(full)
    assert rows(lc.ledger_incremental(caught_up, presence, spine, cut)) == rows(full)
    newest_only = lc.ledger_incremental(caught_up, presence, spine, calendar[-1])
    assert rows(newest_only) == rows(full)


def test_acquired_and_lost_never_meet(spark):
    calendar, here, seeded = random_presence(99)
    presence, _, spine = frames(spark, calendar, here, seeded)
    both = lc.snapshot_diff(presence, spine).groupBy("customer_key", "processing_date").count()
    assert both.where("count > 1").count() == 0


def test_return_and_fraud_edges(spark, rows):
    """Back after 4, 5, 180 and 181 days; the first is dropped, the last is returning."""
    spine = processing_dates(
        spark.createDataFrame(
            [(DAY0 + timedelta(days=i),) for i in range(400)], "snapshot_date date"
        )
    )
    lost = DAY0 + timedelta(days=100)
    states = [
        (k, date(2020, 1, 1), lost + timedelta(days=away), lost, 100 + away + 1, 400)
        for k, away in enumerate((4, 5, 180, 181))
    ]
    runs = spark.createDataFrame(
        states, SEED + ", seq_from int, seq_to int"
    )
    flags = lc.customer_status_flags(runs, spine)
    assert rows(flags.where("returning_customer_flag = 1"), "customer_key") == [(3,)]
    assert rows(flags.where("customer_key = 0")) == []


def test_never_lost_keeps_its_row_and_null_original_is_neither(spark, rows):
    spine = processing_dates(
        spark.createDataFrame([(DAY0 + timedelta(days=i),) for i in range(3)], "snapshot_date date")
    )
    d1 = DAY0 + timedelta(days=1)
    runs = spark.createDataFrame(
        [(1, d1, d1, None, 2, 3), (2, None, None, DAY0, 2, 3)],
        SEED + ", seq_from int, seq_to int",
    )
    assert rows(lc.customer_status_flags(runs, spine)) == [
        ("2022-01-04", 1, 1, None, None, None, None),
        ("2022-01-04", 2, None, None, None, None, None),
    ]


def test_reconcile_sees_null_differences(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z"), (5, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (4, "w"), (5, None)], "k int, v string")
    assert rows(lc.reconcile(a, b, "k", ["v"]), "k") == [(2,), (3,), (4,)]


def test_seed_takes_the_newest_year_end(spark, rows):
    master = spark.sql(
        "SELECT * FROM VALUES ('0007', date'2010-01-01', date'2019-12-31'),"
        " ('0007', date'2011-01-01', date'2020-12-31') t(customer_key, date_customer_added,"
        " snapshot_date)"
    )
    assert rows(lc.seed_ledger(master)) == [(7, "2011-01-01", None, None)]


def test_eligible_customers_drop_services_and_unknown_groups(spark, rows):
    base = spark.createDataFrame(
        [(1, "Direct", "Deposit", "OPEN"), (2, "Direct", "Services", "OPEN"),
         (3, "Direct", None, "OPEN"), (4, "Joint", "Deposit", "OPEN"),
         (5, "Direct", "Lending", "CLOSED"), (1, "Direct", "Lending", "DORMANT")],
        "customer_key int, ownership_type string, product_group string, conformed_status string",
    ).withColumn("snapshot_date", F.lit("2022-01-03").cast("date"))
    assert rows(lc.eligible_customers(base), "customer_key") == [(1,)]


@pytest.mark.parametrize("case", range(2))
def test_presence_as_bits_equals_presence_as_sets(spark, rows, monkeypatch, case):
    calendar, here, seeded = random_presence(case)
    presence, _, spine = frames(spark, calendar, here, seeded)
    bits = rows(lc.snapshot_diff(presence, spine))
    monkeypatch.setattr(lc, "_MOST_WORDS", 0)
    assert rows(lc.snapshot_diff(presence, spine)) == bits
