"""Branch assignment: rules, and the all-days plan against one plan per day."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallybook.operators import processing_dates, range_join_trailing
from tallybook.plans import branches as br

D0 = date(2022, 1, 3)
DIRECT = "account_key int, customer_key int, primary_customer_flag string"
TRANS = "account_key int, branch_number int, transaction_date date"


def day(n):
    return D0 + timedelta(days=n)


def test_window_edges_and_ties(spark, rows):
    as_of = day(0)
    trans = spark.createDataFrame(
        [(1, 5, day(-365)), (1, 4, day(-366)), (1, 4, day(-366)), (1, 3, day(1)), (1, 3, day(1)),
         (2, 9, day(-1)), (2, 8, day(-1))],
        TRANS,
    )
    direct = spark.createDataFrame([(1, 10, "Y"), (2, 20, "N")], DIRECT)
    assert rows(br.direct_branch(trans, direct, as_of)) == [(10, 5), (20, 8)]
    assert rows(br.primary_branch(trans, direct, as_of)) == [(10, 5)]
    assert rows(br.used_branches(trans, direct, as_of)) == [(10, 5, 5), (20, None, 8)]


def test_assignment_falls_back_in_order(spark, rows):
    trans = spark.createDataFrame([(1, 5, D0), (2, 6, D0)], TRANS)
    direct = spark.createDataFrame([(1, 1, "Y"), (2, 2, "N"), (3, 3, "Y")], DIRECT)
    accts = spark.createDataFrame(
        [(3, day(-9), 7), (3, day(9), 8)], "account_key int, date_opened date, branch_id int"
    )
    customers = spark.createDataFrame([(k, 100 + k) for k in range(1, 5)],
                                      "customer_key int, opening_branch int")
    flags = spark.createDataFrame([(1, "Y", "N")],
                                  "customer_key int, is_active string, is_direct string")
    got = br.dynamic_branch(customers, trans, direct, accts, flags, D0)
    assert rows(got, "customer_key", "dynamic_branch_assignment", "is_active", "is_direct") == [
        (1, 5, "Y", "N"), (2, 6, "N", "N"), (3, 7, "N", "N"), (4, 104, "N", "N"),
    ]


@pytest.mark.parametrize("seed, daily", [(5, False), (5, True), (6, True), (7, True)])
def test_history_equals_one_plan_per_day(spark, rows, seed, daily):
    rng = random.Random(seed)
    calendar = [day(n) for n in (0, 1, 4, 30, 31, 60, 200, 365, 366, 400, 700)]
    spine = processing_dates(spark.createDataFrame([(d,) for d in calendar], "snapshot_date date"))
    trans = spark.createDataFrame(
        [(rng.randint(1, 12), rng.randint(1, 4), day(rng.randint(-500, 800))) for _ in range(400)],
        TRANS,
    )
    owners = [(a, rng.randint(1, 6), rng.choice("YN")) for a in range(1, 13) for _ in range(2)]
    owners = list({(a, c): (a, c, f) for a, c, f in owners}.values())
    accts = spark.createDataFrame(
        [(a, day(rng.randint(-300, 720)), rng.randint(5, 9)) for a in range(1, 13)],
        "account_key int, date_opened date, branch_id int",
    )
    people = [(c, 90 + c) for c in range(1, 9)]
    if daily:
        direct = spark.createDataFrame(
            [(*o, d) for o in owners for d in calendar if rng.random() < 0.6],
            DIRECT + ", snapshot_date date",
        )
        customers = spark.createDataFrame(
            [(c, b + i, d) for c, b in people for i, d in enumerate(calendar) if c % 3 or i % 2],
            "customer_key int, opening_branch int, snapshot_date date",
        )
        flags = spark.createDataFrame(
            [(c, rng.choice("YN"), "Y", d) for c, _ in people[:5] for d in calendar],
            "customer_key int, is_active string, is_direct string, snapshot_date date",
        )
    else:
        direct = spark.createDataFrame(owners, DIRECT)
        customers = spark.createDataFrame(people, "customer_key int, opening_branch int")
        flags = spark.createDataFrame(
            [(c, "Y", "N") for c, _ in people[:4]],
            "customer_key int, is_active string, is_direct string",
        )

    def on(frame, d):
        if "snapshot_date" not in frame.columns:
            return frame
        return frame.where(F.col("snapshot_date") == F.lit(d)).drop("snapshot_date")

    single = None
    for d in calendar:
        one = br.dynamic_branch(
            on(customers, d), trans, on(direct, d), accts, on(flags, d), d
        )
        single = one if single is None else single.unionByName(one)
    history = br.dynamic_branch_history(customers, trans, direct, accts, flags, spine)
    left, right = rows(history), rows(single)
    assert [r for r in left if r not in right] == [r for r in right if r not in left]
    assert len(left) == len(right)


def test_unify_teller_keeps_the_newest_valid_rows(spark, rows):
    classic = spark.sql(
        "SELECT * FROM VALUES ('c1', 'D', 42, 7, '3', date'2022-01-03', 1),"
        " ('c1', 'D', 42, 7, '4', date'2022-01-03', 2),"
        " ('c2', 'Z', 42, 7, '3', date'2022-01-03', 1),"
        " ('c3', 'D', 0, 7, '3', date'2022-01-03', 1), ('c4', 'D', 5, 0, '3', date'2022-01-03', 1)"
        " t(composite_key, type_of_account_1, account_number_1, cif_number, branch_number,"
        " system_date, utc_timestamp)"
    )
    current = spark.sql(
        "SELECT * FROM VALUES ('t1', '1-DD-1', 5, 2, date'2022-01-04', 1),"
        " ('t2', cast(null AS string), 5, 2, date'2022-01-04', 1),"
        " ('t3', '1-DD-1', 0, 2, date'2022-01-04', 1)"
        " t(transaction_id, account_key_1, primary_owner_key, branch_number, transaction_date,"
        " utc_timestamp)"
    )
    assert rows(br.unify_teller(classic, current)) == [
        ("1-DD-" + "0" * 18 + "42", 4, "2022-01-03", "c1"), ("1-DD-1", 2, "2022-01-04", "t1"),
    ]


def test_renamed_branch_does_not_multiply_accounts(spark, rows):
    accounts = spark.sql(
        "SELECT * FROM VALUES (1, 'o', date'2022-01-01', 1), (2, 'p', date'2022-01-01', 1),"
        " (3, 'o', cast(null AS date), 1) t(account_key, org_key, date_opened, utc_timestamp)"
    )
    orgs = spark.sql(
        "SELECT * FROM VALUES ('o', 5, 'Old', 1), ('o', 5, 'New', 2), ('p', 0, 'None', 1)"
        " t(org_key, branch_id, branch_description, utc_timestamp)"
    )
    assert rows(br.account_branches(accounts, orgs)) == [(1, "2022-01-01", 5)]


def test_names_use_the_newest_description_and_keep_unknown_ids(spark):
    assigned = spark.sql(
        "SELECT 1 AS customer_key, 5 AS primary_branch_number, cast(null AS int) AS "
        "direct_branch_number, 6 AS acct_branch_number, 5 AS opening_branch, 5 AS "
        "dynamic_branch_assignment, 'Y' AS is_active, 'Y' AS is_direct, date'2022-01-03' AS "
        "snapshot_date"
    )
    lookup = spark.sql(
        "SELECT * FROM VALUES (5, 'Old', 1), (5, 'New', 2)"
        " t(branch_id, branch_description, utc_timestamp)"
    )
    got = br.assignment_with_names(assigned, lookup).first()
    assert (got.primary_branch_id, got.primary_branch_name) == ("5", "New")
    assert (got.acct_branch_id, got.acct_branch_name) == ("6", "6")
    assert got.direct_branch_name is None


def test_monthly_majority_needs_direct_customers_with_used_branches(spark, rows):
    daily = spark.sql(
        "SELECT * FROM VALUES (1, 'A', 'A', cast(null AS string), 'Y', date'2022-01-03'),"
        " (1, 'B', 'B', null, 'Y', date'2022-01-04'), (1, 'B', 'B', null, 'Y', date'2022-01-05'),"
        " (2, 'A', null, null, 'Y', date'2022-01-03'), (3, 'A', 'A', null, 'N', date'2022-01-03')"
        " t(customer_key, dynamic_branch_name, primary_branch_name, direct_branch_name, is_direct,"
        " snapshot_date)"
    )
    officers = spark.sql(
        "SELECT * FROM VALUES (1, date'2022-01-03', 'RTL'), (1, date'2022-01-03', 'RTL')"
        " t(customer_key, snapshot_date, primary_officer)"
    )
    # two days without an officer outnumber the one with
    assert rows(br.monthly_majority(daily, officers)) == [(1, "2022-01-31", "B", None)]


def test_employee_branch_prefers_the_day(spark, rows):
    trans = spark.sql(
        "SELECT * FROM VALUES ('e', date'2022-01-03', 1), ('e', date'2022-01-04', 2),"
        " ('e', date'2022-01-04', 2) t(user_id, transaction_date, branch_number)"
    )
    logs = spark.sql(
        "SELECT * FROM VALUES ('e', date'2022-01-03'), ('e', date'2022-01-09'),"
        " ('f', date'2022-01-03') t(user_id, log_date)"
    )
    assert rows(br.user_branch(trans, logs), "user_id", "log_date", "user_branch_number") == [
        ("e", "2022-01-03", 1), ("e", "2022-01-09", 2), ("f", "2022-01-03", None),
    ]


def _history_inputs(spark, hot=0):
    trans = spark.sql(
        "SELECT cast(id % 40 AS int) AS account_key, cast(id % 3 AS int) AS branch_number, "
        "date_add(date'2022-01-03', cast(id * 37 % 900 AS int)) AS transaction_date FROM range(800)"
    )
    direct = spark.sql("SELECT cast(id AS int) AS account_key, cast(id % 9 AS int) AS customer_key, "
                       "if(id % 2 = 0, 'Y', 'N') AS primary_customer_flag FROM range(40)")
    accts = spark.sql("SELECT cast(id AS int) AS account_key, cast(id % 5 AS int) AS branch_id, "
                      "date_add(date'2021-06-01', cast(id * 11 AS int)) AS date_opened FROM range(40)")
    days = spark.sql("SELECT date_add(date'2022-01-03', cast(id * 7 AS int)) AS snapshot_date FROM range(120)")
    return trans, direct, accts, processing_dates(days)


def _exchanges(spark, build, settings):
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return build()._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("daily", [False, True])
def test_history_needs_no_session_setting(spark, daily):
    trans, direct, accts, spine = _history_inputs(spark)
    customers = spark.sql("SELECT cast(id AS int) AS customer_key, 90 AS opening_branch FROM range(12)")
    flags = spark.sql("SELECT cast(id AS int) AS customer_key, 'Y' AS is_active, 'N' AS is_direct FROM range(5)")
    if daily:
        customers = customers.crossJoin(spine.select("snapshot_date"))
    never = {"spark.sql.autoBroadcastJoinThreshold": "-1"}

    def build():
        return br.dynamic_branch_history(customers, trans, direct, accts, flags, spine)

    ours = _exchanges(spark, build, never | {"spark.sql.requireAllClusterKeysForCoPartition": "false"})
    default = _exchanges(spark, build, never | {
        "spark.sql.requireAllClusterKeysForCoPartition": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    })
    assert default <= ours


def test_picks_are_made_at_change_points_only(spark):
    """Rows before the days are spread: one per customer and day on which something changes."""
    trans, direct, accts, spine = _history_inputs(spark)
    runs = br.ownership_runs(direct, spine)
    picks = br.branch_runs(trans, accts, runs, spine, 60).select("customer_key", "seq_from", "seq_until").collect()
    sides = (br.used_branch_points(trans, runs, spine, 60), br.account_branch_points(accts, runs, spine))
    points = {tuple(r) for side in sides for r in side.select("customer_key", "seq").collect()}
    assert {(r.customer_key, r.seq_from) for r in picks} == points
    assert len(picks) == len(points) < 9 * spine.count()
    for r in picks:  # runs adjoin
        assert r.seq_until is None or (r.customer_key, r.seq_until) in points
    # the changes themselves: a transaction enters one window and leaves another
    places = range_join_trailing(trans.join(direct, "account_key"), spine, "transaction_date", 60)
    ends = {(r.customer_key, s) for r in places.collect() for s in (r.seq_from, r.seq_until)}
    assert {tuple(r) for r in sides[0].select("customer_key", "seq").collect()} <= ends


@pytest.mark.parametrize("daily", [False, True])
def test_a_task_of_the_history_holds_a_bounded_number_of_rows(spark, monkeypatch, daily):
    """However few bytes the exchanges hold, customers are not put together in a few tasks."""
    monkeypatch.setattr(br, "TASK_ROWS", 600, raising=False)
    trans, direct, accts, spine = _history_inputs(spark)
    customers = spark.sql("SELECT cast(id AS int) AS customer_key, 90 AS opening_branch FROM range(60)")
    flags = spark.sql("SELECT cast(id AS int) AS customer_key, 'Y' AS is_active, 'N' AS is_direct FROM range(5)")
    if daily:
        customers = customers.crossJoin(spine.select("snapshot_date"))
    history = br.dynamic_branch_history(customers, trans, direct, accts, flags, spine)
    held = history.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in held) == 60 * 120
    assert max(r["count"] for r in held) <= 60 * 120 // 3
