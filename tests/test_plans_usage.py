"""Transactions, campaign, cohorts, digital usage and sinks on hand-made feeds."""

import pytest
from pyspark.sql import functions as F

from tallybook.operators import processing_dates
from tallybook.plans import branches, campaign, cohorts, digital
from tallybook.plans import transactions as tx
from tallybook.reports import digital as reports
from tallybook.reports.shapes import Tables
from tallybook.sources import (
    copy_tables,
    export_csv,
    read_csv,
    read_snapshots,
    replace_table,
    write_snapshot,
    write_table,
)


def values(spark, text, columns):
    return spark.sql(f"SELECT * FROM VALUES {text} t({columns})")


def test_exclusions_all_apply(spark, rows):
    trans = values(
        spark,
        "(1, 'SPEEDY CASH 1'), (2, 'SPEEDY CASH PAWN'), (3, 'speedy cash'), (4, 'Speedy #9'),"
        " (5, 'AUTO SNAP FINANCE'), (6, 'SNAP FINANCE')",
        "id, description",
    )
    kept = tx.tag_transactions(trans, tx.PAYDAY_PHRASES, tx.PAYDAY_EXCLUSIONS, case_sensitive=True)
    assert rows(kept, "id") == [(1,), (4,), (6,)]


def test_processor_labels_take_the_first_rule(spark, rows):
    trans = values(
        spark,
        "(1, 'PAYPAL INTUIT'), (2, 'Intuitive co'), (3, 'PURCH SQ x'), (4, 'Stripe.com'),"
        " (5, 'Square Enix'), (6, 'quickbooks'), (7, 'groceries'), (8, cast(null AS string))",
        "id, description",
    )
    got = tx.tag_transactions(
        trans, tx.PROCESSOR_PHRASES, tx.PROCESSOR_EXCLUSIONS, tx.PROCESSOR_RULES, tx.WALLET_DEFAULT
    )
    assert rows(got, "id", "trans_type_flag") == [
        (1, "PayPal"), (3, "Square"), (4, "Stripe"), (6, "Quickbooks"),
    ]


def test_merchant_flag_counts_once(spark, rows):
    accounts = values(spark, "(7, 1, 'OPEN', 1), (7, 2, 'OPEN', 0), (8, 3, 'CLOSED', 1)",
                      "customer_key, account_key, conformed_status, merchant_services_flag")
    trans = values(
        spark,
        "(1, 'C', 'Square Inc Cash App', date'2022-01-01'), (1, 'C', 'stripe transfer',"
        " date'2022-01-01'), (1, 'D', 'zelle', date'2022-01-01'), (2, 'C', 'zelle',"
        " date'2021-05-11')",
        "account_key, db_cr_flag, description, original_process_date",
    )
    people = values(spark, "(7), (8)", "customer_key")
    got = tx.merchant_credit_profile(people, accounts, trans, "2021-05-11")
    assert rows(got) == [(7, 0, 0, 0, 1, 1, 0, 1, "yes")]


def test_opening_deposit_must_be_the_first_positive_amount(spark, rows):
    accounts = values(spark, "(1, 'OPEN', date'2020-01-01'), (2, 'OPEN', date'2020-01-01')",
                      "account_key, conformed_status, date_opened")
    raw = values(spark, "(1, 50, 0), (2, 50, 0)", "account_key, opening_amount, opening_deposit")
    trans = values(
        spark,
        "(1, 'a', date'2020-01-01', -5), (1, 'b', date'2020-01-02', 50), (2, 'c',"
        " date'2020-01-01', 7), (2, 'd', date'2020-01-02', 50)",
        "account_key, transaction_id, transaction_date, transaction_amount",
    )
    got = tx.opening_deposit_match(accounts, raw, trans, "2018-01-01")
    assert rows(got, "account_key") == [(1,)]


def test_activity_flag_window_and_default(spark, rows):
    base = values(spark, "(1), (2), (3)", "account_key")
    trans = values(spark, "(1, date'2022-03-31'), (1, date'2022-03-31'), (2, date'2022-02-27')",
                   "account_key, transaction_date")
    got = tx.recent_activity_flag(base, trans, F.lit(True), "f", "2022-03-31", 31)
    assert rows(got, "account_key", "f") == [(1, 1), (2, 0), (3, 0)]


@pytest.fixture(scope="module")
def positives(spark):
    return spark.sql(
        "SELECT cast(id AS int) AS customer_key, if(id % 2 = 0, 'NSF', 'General') AS "
        "cp_model_group FROM range(4000)"
    )


@pytest.fixture(scope="module")
def nobody(spark):
    return spark.createDataFrame([], "customer_key int, exp_control_label string, date_added date")


def test_control_share_and_stability(spark, rows, positives, nobody):
    first = campaign.assign_control(positives, nobody, "2022-01-03")
    share = first.where("exp_control_label = 'Control'").count() / 4000
    assert 0.12 < share < 0.18
    again = campaign.assign_control(positives.repartition(17), nobody, "2022-01-03")
    assert rows(again) == rows(first)
    other = campaign.assign_control(positives, nobody, "2022-01-03", seed=7)
    assert rows(other) != rows(first)


def test_labels_given_stay(spark, rows, positives, nobody):
    first = campaign.assign_control(positives.where("customer_key < 100"), nobody, "2022-01-03")
    later = campaign.assign_control(positives, first, "2022-02-03", fraction=1.0)
    assert rows(later.where("date_added = '2022-01-03'")) == rows(first)
    assert rows(later.where("date_added = '2022-02-03'").select("exp_control_label").distinct()) \
        == [("Control",)]
    assert later.count() == 4000


def test_control_share_per_stratum(spark, positives, nobody):
    got = campaign.assign_control(positives, nobody, "2022-01-03", {"NSF": 0.5})
    control = got.where("exp_control_label = 'Control'")
    assert control.where("customer_key % 2 = 1").count() == 0
    assert 800 < control.count() < 1200


def test_segment_priority_over_accounts(spark, rows):
    base = values(
        spark,
        "('1', 7, 0, 1, 0), ('1', 7, 1, 0, 0), ('0', 7, 0, 0, 1), ('1', 8, 0, 0, 0)",
        "prediction, customer_key, payday_lending_flag, nsf_flag, decreasing_balance_flag",
    )
    assert rows(campaign.segment_customers(base)) == [
        ("0", 7, "Decreasing Balance"), ("1", 7, "Payday"), ("1", 8, "General"),
    ]


def _campaign(spark):
    raw = values(
        spark,
        "(1, ':lead', '2022-01-02', '', '2022-01-05', '2022-01-06', 'mail', '', '', 'NSF',"
        " '2022-01-01'), (1, ':reached', '2022-01-01', '1900-01-01', null, '2022-01-09', 'banner',"
        " '3', 'Payday', 'NSF', ''),"
        " (2, ':unsubscribed', '2022-01-01', '', null, '2022-01-01', 'mail', '0', '', null, ''),"
        " (2, ':odd', '2022-01-01', '', null, null, 'mail', 'x', '', null, '')",
        "customer_key, campaign_result, first_contact_date, first_clicked_date,"
        " first_banner_viewed_date, last_result_date, result_channel, banners_viewed, g1, g2, up",
    ).withColumn("mail_result", F.when(F.col("customer_key") == 2, ":failed"))
    return campaign.campaign_results_clean(raw, ["g1", "g2"], ["up"])


def test_campaign_rows_are_cleaned(spark, rows):
    got = _campaign(spark)
    assert rows(got, "customer_key", "cp_model_group", "upload_date", "banners_viewed") == [
        (1, "NSF", "2022-01-01", None), (1, "Payday", None, 3), (2, "ERROR", None, 0),
        (2, "ERROR", None, None),
    ]


def test_touch_and_attribution(spark, rows):
    results = _campaign(spark)
    touch = campaign.first_touch(results)
    assert rows(touch) == [(1, "2022-01-01", "2022-01-05"), (2, "2022-01-01", None)]
    loans = values(
        spark,
        "(11, 1, date'2022-01-08'), (12, 1, date'2022-01-04'), (13, 1, date'2022-01-05'),"
        " (14, 2, date'2022-01-08'), (15, 9, date'2022-01-08')",
        "account_key, customer_key, current_note_date",
    )
    flagged = campaign.booked_after_flags(loans, touch)
    assert rows(flagged, "account_key", "loan_booked_after_first_marketing_date",
                "loan_booked_after_first_marketing_open") == [
        (11, "Yes", "Yes"), (12, "Yes", "No"), (13, "Yes", "Yes"), (14, "Yes", "No"),
        (15, "No", "No"),
    ]
    # the result of 9 January comes after the booking; loan 13 has none before it
    assert rows(campaign.last_touch_attribution(results, flagged)) == [(11, "mail", "NSF")]


def test_receipt_and_outcomes(spark, rows):
    results = _campaign(spark)
    assert rows(campaign.channel_receipt(results)) == [
        (1, "yes", "yes", "banner and mail"), (2, "no", "no", "none"),
    ]
    assert rows(campaign.best_worst_result(results)) == [
        (1, "lead", "reached"), (2, "unsubscribed", "unsubscribed"),
    ]


def test_resolving_snapshots(spark, rows):
    spine = processing_dates(
        values(spark, "(date'2021-12-31'), (date'2022-02-25'), (date'2022-03-30')", "snapshot_date")
    )
    cohort = values(spark, "(date'2021-12-31'), (date'2022-02-25'), (date'2022-03-01')",
                    "snapshot_date")
    ahead = cohorts.resolve_snapshot(cohort, spine, 2, month_end=True)
    assert rows(ahead) == [
        ("2021-12-31", "2022-02-28", "2022-02-25", True),
        ("2022-02-25", "2022-04-30", "2022-03-30", False),  # newest file stands in
        ("2022-03-01", "2022-05-31", "2022-03-30", False),
    ]
    back = cohorts.resolve_snapshot(cohort, spine, -2)
    assert rows(back, "snapshot_date", "resolved_date") == [("2022-03-01", "2021-12-31")]


def test_new_dollars_keep_days_without_accounts(spark, rows):
    spine = processing_dates(values(spark, "(date'2022-01-31'), (date'2022-03-31')",
                                    "snapshot_date"))
    flags = values(spark, "(7, date'2022-01-31', 1), (8, date'2022-01-30', 1)",
                   "customer_key, snapshot_date, new_customer_flag")
    xref = values(spark, "(7, 1, 'Y', date'2022-03-31'), (7, 2, 'N', date'2022-03-31'),"
                  " (7, 3, 'Y', date'2022-01-31')",
                  "customer_key, account_key, primary_customer_flag, snapshot_date")
    balances = values(spark, "(1, date'2022-03-31', 10.50), (2, date'2022-03-31', 99.00),"
                      " (3, date'2022-01-31', 99.00)",
                      "account_key, snapshot_date, average_collected_balance_mtd")
    got = cohorts.new_customer_dollars(flags, xref, balances, spine)
    assert [(d, v and float(v)) for d, v in rows(got)] == [
        ("2022-01-30", None), ("2022-01-31", 10.5),
    ]
    due = cohorts.new_dollars_for_month(flags, xref, balances, spine, "2022-04-05")
    assert [(d, float(v)) for d, v in rows(due)] == [("2022-01-31", 10.5)]


def test_logins_keep_people_without_any(spark, rows):
    trans = values(
        spark,
        "('u1', 'Login', 'PHONE', 'App', '01/02/2022 10:00:00'), ('u1', 'Login', 'UNKNOWN', 'App',"
        " '01/02/2022 10:00:00'), ('u0', 'Login', 'PHONE', 'App', '01/02/2022 10:00:00'),"
        " ('u1', 'Login', 'PHONE', 'App', 'bad'), ('u1', 'Logout', 'PHONE', 'App',"
        " '01/02/2022 10:00:00')",
        "user_id, transaction_type, device, channel, transaction_stamp",
    )
    users = values(spark, "(1, 'u0', 1), (1, 'u1', 2), (2, 'u2', 1), (cast(null AS int), 'u9', 1)",
                   "individual_id, user_id, enrolled_at")
    got = digital.login_pivot(trans, users, ["PHONE - App"], "2022-01-31")
    assert rows(got) == [(1, 1, None), (2, None, None)]
    got = digital.login_pivot(trans, users, ["TABLET - App"], "2022-01-31")
    assert got.columns == ["individual_id", "TABLET - App", "other"]
    assert rows(got) == [(1, None, 1), (2, None, None)]


def test_failures_stay_open_until_a_success(spark, rows):
    trans = values(
        spark,
        "(1, 'a', 'F'), (1, 'b', 'S'), (2, 'a', 'F'), (2, 'b', 'F'), (3, 'b', 'S')",
        "individual_id, kind, result",
    )
    failed = (F.col("kind") == "a") & (F.col("result") == "F")
    fixed = (F.col("kind") == "b") & (F.col("result") == "S")
    got = digital.unrecovered_failures(trans, failed, fixed, profile=["individual_id"])
    assert rows(got) == [(2,)]
    unknown = values(spark, "(cast(null AS int), 'a', 'F'), (cast(null AS int), 'b', 'S')",
                     "individual_id, kind, result")
    got = digital.unrecovered_failures(
        trans.unionByName(unknown), failed, fixed, profile=["individual_id"]
    )
    assert rows(got) == [(2,), (None,)]
    none = digital.users_without_event(trans, F.col("kind") == "a", ["individual_id"])
    assert rows(none) == [(3,)]


def test_update_log_does_not_pair_keys_with_other_columns(spark):
    step = "logging_session_id, logging_view_id, transaction_id"
    transactions = values(
        spark, "(1, 1, 1, 'e', date'2022-01-03')", f"{step}, user_id, create_date"
    )
    updates = values(spark, "(1, 1, 1, 1)", f"{step}, update_id")
    keys = values(spark, "(1, 1, 1, 1, 'a', 'k'), (1, 1, 1, 1, 'b', 'k')",
                  f"{step}, update_id, column_name, column_value")
    changed = values(spark, "(1, 1, 1, 1, 'a', 'x'), (1, 1, 1, 1, 'b', 'y')",
                     f"{step}, update_id, column_name, new_column_value")
    accounts = values(spark, "(1, 1, 1, 2, 'z')", f"{step}, update_id, link")
    got = digital.update_log(transactions, updates, accounts, keys, changed)
    assert got.count() == 2 and got.where("link IS NULL").count() == 2


def test_snapshot_folders_and_repeat_runs(spark, rows, tmp_path):
    base = str(tmp_path / "out")
    day = spark.createDataFrame([(1,), (2,)], "id int")
    write_snapshot(day, base, "2022-01-03")
    write_snapshot(day, base, "2022-01-04")
    write_snapshot(day.where("id = 1"), base, "2022-01-04")  # again, with fewer rows
    back = read_snapshots(spark, base, layout="partitioned")
    assert rows(back) == [(1, "2022-01-03"), (1, "2022-01-04"), (2, "2022-01-03")]
    tree = str(tmp_path / "tree")
    for text in ("2021/12/31", "2022/01/03", "2022/01/04"):
        day.write.parquet(f"{tree}/{text}")
    assert read_snapshots(spark, tree).count() == 6
    assert rows(read_snapshots(spark, tree, start="2022-01-04", end="2022-01-04")) == [
        (1, "2022-01-04"), (2, "2022-01-04"),
    ]
    assert rows(read_snapshots(spark, tree, years=[2021]).select("snapshot_date").distinct()) == [
        ("2021-12-31",)
    ]
    late = read_snapshots(spark, tree, start="2022-01-01", end="2022-01-03")
    assert rows(late, "snapshot_date") == [("2022-01-03",)] * 2


def test_tables_and_csv(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "2.50")], "id long, amount string")
    spark.sql("CREATE DATABASE IF NOT EXISTS first_db")
    spark.sql("CREATE DATABASE IF NOT EXISTS second_db")
    write_table(df, "first_db.t", schema="id INT, amount DECIMAL(18,2)")
    write_table(df, "first_db.t", mode="append", schema="id INT, amount DECIMAL(18,2)")
    assert spark.table("first_db.t").dtypes == [("id", "int"), ("amount", "decimal(18,2)")]
    table = spark.table("first_db.t")
    replace_table(table.limit(1).unionByName(table), "first_db.t")  # reads what it replaces
    assert spark.table("first_db.t").count() == 3
    assert copy_tables(spark, ["first_db.t"], "second_db") == ["second_db.t"]
    assert spark.table("second_db.t").count() == 3
    path = str(tmp_path / "csv")
    export_csv(df, path, single_file=True)
    assert rows(read_csv(spark, path)) == [(1, 2.5)]
    assert rows(read_csv(spark, path, "id INT, amount STRING")) == [(1, "2.50")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_tables(spark):
    """No join by broadcast, and Spark's own rule for rows laid out by a part of the join keys."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.requireAllClusterKeysForCoPartition": "true",
    }
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_update_log_moves_the_chain_once_to_its_updates(spark, rows, large_tables):
    step = "logging_session_id, logging_view_id, transaction_id"
    transactions = values(spark, "(1, 1, 1, 'e', date'2022-01-03'), (2, 1, 1, 'f', date'2022-01-03'), "
                          "(cast(null AS int), 1, 1, 'e', date'2022-01-03')", f"{step}, user_id, create_date")
    updates = values(spark, "(1, 1, 1, 1), (1, 1, 1, 2), (2, 1, 1, 1), (2, 1, 1, 1), (null, 1, 1, 1), "
                     "(1, 1, 1, null)", f"{step}, update_id")
    accounts = values(spark, "(1, 1, 1, 1, 'z'), (1, 1, 1, 1, 'y'), (1, 1, 1, null, 'x')",
                      f"{step}, update_id, link")
    keys = values(spark, "(1, 1, 1, 1, 'a', 'k'), (1, 1, 1, 2, 'a', 'm'), (1, 1, 1, 2, 'b', 'n'), "
                  "(1, 1, 1, 2, null, 'o'), (2, 1, 1, 1, 'c', 'p'), (1, 1, 1, null, 'a', 'q')",
                  f"{step}, update_id, column_name, column_value")
    changed = values(spark, "(1, 1, 1, 1, 'a', 'v'), (1, 1, 1, 2, 'a', 'w'), (1, 1, 1, 2, 'a', 'x'), "
                     "(1, 1, 1, 2, 'd', 'y'), (1, 1, 1, 2, null, 'z'), (2, 1, 1, 1, 'c', 'u'), "
                     "(1, 1, 1, null, 'a', 't')", f"{step}, update_id, column_name, new_column_value")
    trans = values(spark, "('e', date'2022-01-03', 4)", "user_id, transaction_date, branch_number")
    alone = digital.update_log(transactions, updates, accounts, keys, changed)
    got = digital.update_log(transactions, updates, accounts, keys, changed, trans)
    # each input once, and the transactions with their updates
    assert _plan(alone).count("Exchange hashpartitioning") == 6
    # transactions by employee, and the counted ones twice
    assert _plan(got).count("Exchange hashpartitioning") == 9
    assert got.columns == [*step.split(", "), "update_id", "column_name", "user_id", "create_date", "link",
                           "column_value", "new_column_value", "log_date", "user_branch_number"]
    assert alone.columns == got.columns[:-1]
    picked = ("logging_session_id", "update_id", "column_name", "link", "column_value",
              "new_column_value", "user_branch_number")
    assert rows(got, *picked) == [
        (1, 1, "a", "y", "k", "v", 4), (1, 1, "a", "z", "k", "v", 4), (1, 2, "a", None, "m", "w", 4),
        (1, 2, "a", None, "m", "x", 4), (2, 1, "c", None, "p", "u", None), (2, 1, "c", None, "p", "u", None),
    ]


def test_update_log_report_moves_the_lines_once_for_its_feeds(spark, tmp_path):
    spark.sql(
        "SELECT id AS l_orderkey, id % 7 AS l_partkey, id % 3 AS l_suppkey, cast(id % 5 AS int) AS l_linenumber, "
        "1.0 AS l_quantity, 2.0 AS l_extendedprice, 0.1 AS l_discount, if(id % 2 = 0, 'F', 'O') AS l_linestatus, "
        "timestamp'2022-01-03' AS l_shipdate FROM range(50)"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    log = reports.update_log(Tables(spark, str(tmp_path)))
    assert len(log.collect()) == 100
    final = _plan(log).split("== Initial Plan ==")[0]
    # two layouts for five feeds, and what the branch of employees needs
    assert final.count("FileScan parquet") == 3


def test_employee_branch_moves_log_rows_once(spark, rows, large_tables):
    trans = values(
        spark,
        "('e', date'2022-01-03', 1), ('e', date'2022-01-04', 2), ('e', date'2022-01-04', 2), "
        "('e', cast(null AS date), 1), ('e', null, 1), ('g', date'2022-01-03', cast(null AS int)), "
        "('g', date'2022-01-03', null), ('g', date'2022-01-04', 3), ('h', date'2022-01-03', 6), "
        "('h', date'2022-01-03', 5), (null, date'2022-01-03', 9)",
        "user_id, transaction_date, branch_number",
    )
    logs = values(
        spark,
        "(1, 'e', date'2022-01-04'), (2, 'e', date'2022-01-09'), (3, 'e', cast(null AS date)), "
        "(4, 'g', date'2022-01-03'), (5, 'g', date'2022-01-04'), (6, 'h', date'2022-01-03'), "
        "(7, null, date'2022-01-03'), (8, 'i', date'2022-01-03')",
        "id, user_id, log_date",
    )
    got = branches.user_branch(trans, logs)
    assert got.columns == ["user_id", "log_date", "id", "user_branch_number"]
    assert rows(got, "id", "user_branch_number") == [
        (1, 2), (2, 1), (3, 1), (4, None), (5, 3), (6, 5), (7, None), (8, None)
    ]
    assert _plan(got).split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 3
