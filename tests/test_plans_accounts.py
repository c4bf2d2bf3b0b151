"""Status, relationships, goals and the loan portfolio on hand-made feeds."""

import pytest
from pyspark.sql import functions as F

from tallybook.operators import processing_dates
from tallybook.plans import conform, goals, portfolio


@pytest.fixture(scope="module")
def codes(spark):
    return spark.sql(
        "SELECT * FROM VALUES ('a', 'STAT', 'DD', 'OPEN'), ('b', 'SS', 'DD', ''),"
        " ('c', 'LNST', 'DD', cast(null AS string)), ('d', 'CLSD', 'DD', 'CLOSED'),"
        " ('e', 'STAT', 'SI', 'CLOSED'), ('f', 'OTHER', 'DD', 'CLOSED'),"
        " ('d', 'CLSD', 'DD', 'ZCLOSED'), ('d', 'CLSD', 'DD', 'CLOSED')"
        " t(code_key, code_type, application, code_description_2)"
    )


def test_status_text(codes, rows):
    assert rows(conform.conform_status(codes)) == [
        ("a", "OPEN"), ("b", "OPEN"), ("c", "OPEN"), ("d", "CLOSED"),
    ]


def test_unknown_status_default_or_null(spark, codes, rows):
    accounts = spark.createDataFrame(
        [(1, "d"), (2, "e"), (3, None)], "account_key int, status_key string"
    )
    got = conform.conformed_accounts(accounts, codes)
    assert rows(got, "account_key", "conformed_status") == [(1, "CLOSED"), (2, "OPEN"), (3, "OPEN")]
    kept = conform.conformed_accounts(accounts, codes, None)
    assert rows(kept, "account_key", "conformed_status") == [(1, "CLOSED"), (2, None), (3, None)]


def test_base_by_day_and_unmatched_accounts(spark, rows):
    xref = spark.sql(
        "SELECT * FROM VALUES (1, 7, 'DD', 'r', 'Y', date'2022-01-03'),"
        " (1, 7, 'DD', 'r', 'Y', date'2022-01-04'), (2, 7, 'XX', 's', 'N', date'2022-01-03')"
        " t(account_key, customer_key, application, relationship_key, primary_customer_flag,"
        " snapshot_date)"
    )
    groups = spark.sql(
        "SELECT * FROM VALUES ('DD', 'Deposit', date'2022-01-03'),"
        " ('DD', 'Lending', date'2022-01-04') t(application_code, product_group, snapshot_date)"
    )
    owners = spark.sql(
        "SELECT * FROM VALUES ('r', 'Direct', date'2022-01-03'), ('r', 'Joint', date'2022-01-04')"
        " t(relationship_key, ownership_type, snapshot_date)"
    )
    accounts = spark.sql("SELECT 1 AS account_key, 'OPEN' AS conformed_status, "
                         "date'2022-01-03' AS snapshot_date")
    base = conform.build_relationship_base(
        xref, groups, owners, accounts, "PURGED", ["snapshot_date"]
    )
    assert rows(base, "account_key", "snapshot_date", "product_group", "ownership_type",
                "conformed_status") == [
        (1, "2022-01-03", "Deposit", "Direct", "OPEN"),
        (1, "2022-01-04", "Lending", "Joint", "PURGED"),
        (2, "2022-01-03", None, None, "PURGED"),
    ]


def test_activity_flags_and_legacy_rule(spark, rows):
    base = spark.sql(
        "SELECT * FROM VALUES (1, 'Direct', 'Deposit', 'OPEN'), (2, 'Joint', 'Deposit', 'DORMANT'),"
        " (3, 'Direct', 'Services', 'OPEN'), (4, 'Direct', 'Lending', 'CLOSED'),"
        " (5, 'Direct', 'Deposit', cast(null AS string))"
        " t(customer_key, ownership_type, product_group, conformed_status)"
    )
    assert rows(conform.activity_flags(base)) == [
        (1, "Y", "Y"), (2, "Y", "N"), (3, "Y", "N"), (4, "N", "N"), (5, "N", "N"),
    ]
    legacy = conform.activity_flags(base, legacy_active=True)
    assert rows(legacy.where("is_active = 'Y'"), "customer_key") == [(k,) for k in range(1, 6)]


def test_direct_relationships_prefer_the_primary_row(spark, rows):
    base = spark.sql(
        "SELECT * FROM VALUES (1, 7, 'Direct', 'Deposit', 'OPEN', 'N'),"
        " (1, 7, 'Direct', 'Deposit', 'OPEN', 'Y'), (2, 7, 'Joint', 'Deposit', 'OPEN', 'Y'),"
        " (3, 7, 'Direct', cast(null AS string), 'OPEN', 'Y') t(account_key, customer_key,"
        " ownership_type, product_group, conformed_status, primary_customer_flag)"
    )
    kept = conform.direct_relationships(base)
    assert rows(kept, "account_key", "primary_customer_flag") == [(1, "Y"), (3, "Y")]
    assert rows(conform.direct_relationships(base, exclude_groups=["Services"]),
                "account_key") == [(1,)]  # an unknown group drops out


def test_month_ends(spark, rows):
    days = spark.sql(
        "SELECT * FROM VALUES (date'2024-01-30'), (date'2024-01-02'), (date'2024-02-29'),"
        " (date'2024-03-28') t(snapshot_date)"
    )
    assert rows(goals.month_end_snapshots(processing_dates(days))) == [
        ("2024-01-31", "2024-01-30"), ("2024-02-29", "2024-02-29"), ("2024-03-31", "2024-03-28"),
    ]


def _counts(spark):
    return spark.sql(
        "SELECT b AS dynamic_branch_name, c AS customer_key, m AS me_utc_timestamp,"
        " date_format(m, 'yyyy_Q') AS quarter, a AS account_key FROM VALUES"
        " ('x', 1, date'2021-04-30', 11), ('x', 1, date'2021-04-30', 12),"
        " ('x', 1, date'2021-04-30', 12), ('x', 2, date'2021-04-30', 13),"
        " ('x', 1, date'2021-05-31', 11), ('x', 1, date'2021-12-31', 11),"
        " ('x', 1, date'2022-01-31', 11), ('y', 3, date'2021-11-30', 14),"
        " ('z', 4, date'2022-01-31', 15) t(b, c, m, a)"
    )


def test_quarters_keep_their_own_label_when_one_is_missing(spark, rows):
    got = goals.quarterly_products_per_customer(_counts(spark), 2021, "p")
    assert got.columns == ["dynamic_branch_name", "p_Q1", "p_Q2", "p_Q3", "p_Q4"]
    assert rows(got) == [("x", None, 1.25, None, 1.0), ("y", None, None, None, 1.0)]


def test_goal_of_one_month_is_null(spark):
    got = {r[0]: r[1] for r in goals.annual_goal_stddev(_counts(spark), 2021).collect()}
    assert got["y"] is None
    assert got["x"] == pytest.approx(((0.5 - 1 / 6) ** 2 + 2 * (1 / 6) ** 2) ** 0.5 / 2**0.5)


def test_branch_goals_equal_their_parts(spark, rows):
    counts = _counts(spark)
    got = goals.branch_goals(counts, 2022)
    prior = goals.quarterly_products_per_customer(counts, 2021, "prior_year")
    assert rows(got, *prior.columns) == rows(prior)
    now = goals.quarterly_products_per_customer(counts, 2022, "current_year")
    x = got.where("dynamic_branch_name = 'x'")
    assert rows(x, *now.columns) == rows(now.where("dynamic_branch_name = 'x'"))
    goal = goals.annual_goal_stddev(counts, 2021)
    assert rows(got, *goal.columns) == rows(goal)
    assert rows(got, "dynamic_branch_name", "prior_ye_num_cust", "prior_ye_num_prod_svc") == [
        ("x", 1, 1), ("y", None, None),
    ]
    steps = [c for c in got.columns if c.endswith("pt_goal")]
    assert len(steps) == 20
    one = x.first()
    gap = one["current_year_annual_goal"] / 8
    for quarter in range(1, 5):
        for step in range(1, 6):
            value = one[f"current_year_q{quarter}_{step}pt_goal"]
            halves = 2 * (quarter - 1) + step - 1
            assert value == pytest.approx(one["prior_year_Q4"] + gap * halves)


def test_portfolio_growth_parts(spark, rows):
    snaps = spark.sql(
        "SELECT a AS account_key, make_date(y, 12, 31) AS snapshot_date, o AS"
        " bank_owned_principle_assets, r AS original_amount FROM VALUES"
        " (1, 2019, 100, 500), (2, 2019, 50, 60), (1, 2020, 90, 500), (3, 2020, 10, 20),"
        " (cast(null AS int), 2020, 7, 8), (1, 2022, 1, 1) t(a, y, o, r)"
    )
    # begin_existing = whole prior year; existing and new together are the whole year
    assert rows(portfolio.portfolio_growth(snaps)) == [(2020, 150, 90, 28, 17)]


def test_portfolio_snapshot_rules(spark, rows):
    def feed(text, columns):
        return spark.sql(f"SELECT * FROM VALUES {text} t({columns})").withColumn(
            "snapshot_date", F.lit("2019-12-31").cast("date")
        )

    owned = "account_key, gl_type, bank_owned_principle_assets"
    loans = feed("(1, 'Retail A', 5), (2, 'RETB', 6), (3, 'COM', 7), (4, 'RET', 8)", owned)
    loans_raw = feed("(1, 0, 50), (2, 1, 60), (3, 0, 70)",
                     "account_key, participation_number, original_loan_amount")
    mortgages = feed("(8, 'RETM', 9), (9, 'RETM', 10)", owned)
    mortgages_raw = feed("(8, 90)", "account_key, orig_principal_balance")
    got = portfolio.portfolio_snapshot(loans, loans_raw, mortgages, mortgages_raw)
    assert rows(got, "account_key", "original_amount") == [(1, 50), (8, 90), (9, None)]
