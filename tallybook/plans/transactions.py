"""Tagging and rolling up account transactions, cards and balances."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions import (
    classify,
    contains_any,
    date_window,
    derive_card_pan,
    normalize_key,
    trim_suffix_when,
)
from tallybook.functions.dates import as_date
from tallybook.operators.picks import earliest_per_key, latest_per_key, mode_per_key
from tallybook.plans.conform import DEPOSIT_APPLICATIONS, LENDING_APPLICATIONS

# Description phrases of wallets and card processors, and their labels.
WALLET_PHRASES = ["purch sq", "gosq.com", "paypal", "square inc", "squareup.com"]
WALLET_EXCLUSIONS = ["square enix"]
WALLET_RULES = [("paypal", "PayPal")]
PROCESSOR_PHRASES = [
    *WALLET_PHRASES,
    "intuit",
    "quickbooks",
    "stripe.com",
    "stripe/",
    "venmo",
]
PROCESSOR_EXCLUSIONS = ["square enix", "intuitive", "intuition"]
PROCESSOR_RULES = [
    ("paypal", "PayPal"),
    ("intuit", "Intuit"),
    ("quickbooks", "Quickbooks"),
    ("venmo", "Venmo"),
    ("stripe.com", "Stripe"),
    ("stripe/", "Stripe"),
]
WALLET_DEFAULT = "Square"

# Description phrases of payday lenders (case-sensitive), and look-alikes.
PAYDAY_PHRASES = [
    "FAST PAYDAY", "PAYDAY MONEY STORE", "PAYDAY-LOAN", "XPRESS PAYDAY", "GETEZMONEY",
    "EZMONEYCPA", "FAST CASH NOW", "SPEEDY CASH", "SPEEDYCASH", "Speedy #", "ACE CASH EX",
    "ADVANCE AMERICA", "ADVANCEAMERICA", "CASH CENTRAL", "CASH POINT", "CASHCALL",
    "CASHNETUSA", "CHECK N GO", "GREEN GATE SERVICES", "LENDGREEN", "LENDUP",
    "LOAN BY PHONE", "MAXLEND", "MOBILOANS", "MONEYKEY", "PLAIN GREEN", "QC HOLDINGS",
    "SPOTLOAN", "SPOT LOAN", "SURE ADVANCE", "PLAIN GREEN LLC", "NH CASH.COM",
    "SNAP FINANCE", "NORTH CASH", "RADIANT CASH", "GREENLINE LOANS", "QUIK CASH",
    "VBS HUMMINGBIRD", "DOLLAR FINANCIAL GROUP", "GREEN GATE SERVI",
]
PAYDAY_EXCLUSIONS = [
    "ReliamaxLending", "SPEEDY CASH PAWN", "AUTO SNAP FINANCE", "CC-NORTH CASHI",
]

# Credit flags by phrase, and the phrase a square credit must not hold.
MERCHANT_PHRASES = {
    "paypal": ["paypal"],
    "zelle": ["zelle"],
    "venmo": ["venmo"],
    "cashapp": ["cash app"],
    "stripe": ["stripe/", "/stripe", "stripe transfer"],
    "square": ["square inc"],
}
MERCHANT_NOT = {"square": ["cash app"]}

# Terminal transaction types, and the terminal id that is no terminal.
ATM_TYPES = ["TRANSFER", "CHECKS ONLY DEPOSIT", "CASH ONLY DEPOSIT", "WITHDRAWAL", "INQUIRY"]
DUMMY_TERMINAL = "99999999"

# Transaction codes of deposits by clearing house, and of unpaid items.
ACH_CREDIT_CODE = 21
NSF_CODE = 71


def tag_transactions(
    trans: DataFrame,
    include: Sequence[str],
    exclude: Sequence[str] = (),
    rules: Sequence[tuple[str, str]] = (),
    default: str | None = None,
    case_sensitive: bool = False,
    column: str = "description",
) -> DataFrame:
    """Transactions with a phrase and without any exclusion, labelled by the first rule."""
    kept = trans.where(contains_any(column, include, case_sensitive))
    if exclude:
        kept = kept.where(~contains_any(column, exclude, case_sensitive))
    tests = [(contains_any(column, [phrase], case_sensitive), label) for phrase, label in rules]
    return kept.withColumn("trans_type_flag", classify(tests, default))


def daily_rollup(
    trans: DataFrame,
    keys: Sequence[str] = ("account_key", "transaction_date", "trans_type_flag", "db_cr_flag"),
) -> DataFrame:
    """Number and amount of transactions per key."""
    return trans.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("transaction_amount").alias("transaction_amount"),
    )


def monthly_credits(
    trans: DataFrame,
    xref: DataFrame,
    code: int = ACH_CREDIT_CODE,
    excluded_phrases: Sequence[str] = ("refund",),
) -> DataFrame:
    """Clearing-house credits per current primary customer and month.

    Credits are summed per account and month before the owner is looked up.
    """
    credits = trans.where(
        (F.col("transaction_code").try_cast("int") == code)
        & ~contains_any("description", excluded_phrases)
    )
    month = F.date_format("transaction_date", "yyyy-MM-01").alias("transaction_date_month")
    per_account = credits.groupBy("account_key", month).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("transaction_amount").alias("_amount")
    )
    owners = latest_per_key(
        xref.where(F.col("primary_customer_flag") == "Y"),
        ["account_key"],
        "snapshot_date",
        ["customer_key"],
    ).select("account_key", "customer_key")
    return (
        per_account.join(owners, "account_key", "left")
        .groupBy("customer_key", "transaction_date_month")
        .agg(
            F.sum("_n").alias("transaction_count"),
            F.sum("_amount").alias("transaction_amount"),
        )
    )


def merchant_credit_profile(
    customers: DataFrame, accounts: DataFrame, trans: DataFrame, since: date | str
) -> DataFrame:
    """Credits per wallet or processor of each business customer, with a yes/no summary.

    ``accounts`` has customer, account, ``conformed_status`` and ``merchant_services_flag``.
    Credits are summed per account before the account join.
    """
    names = [f"{name}_credits" for name in MERCHANT_PHRASES]
    hits = {}
    for name, phrases in MERCHANT_PHRASES.items():
        test = contains_any("description", phrases)
        if name in MERCHANT_NOT:
            test = test & ~contains_any("description", MERCHANT_NOT[name])
        hits[f"{name}_credits"] = F.sum(F.when(test, 1).otherwise(0))
    per_account = (
        trans.where(
            (F.col("db_cr_flag") == "C") & (F.col("original_process_date") > as_date(since))
        )
        .groupBy("account_key")
        .agg(*[total.alias(name) for name, total in hits.items()])
    )
    opened = accounts.where(F.col("conformed_status") == "OPEN")
    wanted = customers.select("customer_key").distinct()
    profile = (
        wanted.join(opened, "customer_key")
        .join(per_account, "account_key", "left")
        .groupBy("customer_key")
        .agg(
            *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names],
            F.max("merchant_services_flag").alias("merchant_services_flag"),
        )
    )
    total = sum((F.col(n) for n in names), F.lit(0))
    return profile.withColumn(
        "has_credit_from_select_merchants", F.when(total > 0, "yes").otherwise("no")
    )


def opening_deposit_match(
    accounts: DataFrame,
    raw: DataFrame,
    trans: DataFrame,
    since: date | str,
    tiebreak: Sequence[str] = ("transaction_id",),
) -> DataFrame:
    """First positive transaction of each account, where it is the opening amount."""
    opened = accounts.where(
        (F.col("date_opened") >= as_date(since)) & F.col("conformed_status").isNotNull()
    )
    first = earliest_per_key(
        trans.where(F.col("transaction_amount") > 0), ["account_key"], "transaction_date", tiebreak
    )
    amounts = raw.select("account_key", "opening_amount", "opening_deposit")
    paid = F.col("transaction_amount")
    return (
        first.join(opened, "account_key")
        .join(amounts, "account_key")
        .where((paid == F.col("opening_amount")) | (paid == F.col("opening_deposit")))
    )


def new_accounts_by_month(accounts: DataFrame) -> DataFrame:
    """Distinct accounts and opening dollars by opening year, month and product."""
    return accounts.groupBy(
        F.date_format("date_opened", "yyyy").alias("year"),
        F.date_format("date_opened", "MM").alias("month"),
        F.col("sub_application_code").alias("product_type"),
    ).agg(
        F.countDistinct("account_key").alias("number_of_new_accounts"),
        F.sum("opening_amount").alias("total_new_deposit_dollars"),
    )


def card_owners(xref: DataFrame, application: str = "CA") -> DataFrame:
    """Primary direct owner per card number as the terminals write it."""
    cards = xref.where(
        (F.col("application") == application)
        & (F.col("primary_customer_flag") == "Y")
        & (F.col("ownership_type") == "Direct")
    )
    return cards.select(
        normalize_key("customer_key", "string").alias("customer_key"),
        derive_card_pan("account_number").alias("pan"),
    ).distinct()


def atm_transactions(
    trans: DataFrame,
    cards: DataFrame,
    merchant: str,
    location_marker: str,
    types: Sequence[str] = tuple(ATM_TYPES),
    suffix: int = 2,
) -> DataFrame:
    """Transactions at the bank's own terminals with the card's customer."""
    own = trans.where(
        F.col("transaction_type_description").isin(list(types))
        & (F.col("merchant_name") == merchant)
        & (F.col("card_acceptor_terminal_id") != DUMMY_TERMINAL)
    ).withColumns(
        {
            "card_acceptor_terminal_location": trim_suffix_when(
                "card_acceptor_terminal_location", location_marker, suffix
            ),
            "pan": F.col("pan").cast("string"),
        }
    )
    return own.join(cards, "pan", "left")


def primary_atm(atm: DataFrame, as_of: date | str, days: int = 90) -> DataFrame:
    """Most used terminal per customer in the window (customers with a known card)."""
    recent = atm.where(
        date_window("calibrated_transaction_date", as_of, days)
        & F.col("customer_key").isNotNull()
    )
    return mode_per_key(recent, ["customer_key"], "card_acceptor_terminal_id").select(
        "customer_key", F.col("card_acceptor_terminal_id").alias("primary_atm")
    )


def customer_atm_profile(
    customers: DataFrame,
    atm: DataFrame,
    branches: DataFrame,
    accounts: DataFrame,
    owners: DataFrame,
    as_of: date | str,
    days: int = 90,
) -> DataFrame:
    """Customers with primary terminal, branch, and deposit and lending balances.

    ``owners`` maps accounts to their direct owners. Both balance sums come from one
    aggregate over the account join.
    """
    deposit = F.col("application_code").isin(DEPOSIT_APPLICATIONS)
    lending = F.col("application_code").isin(LENDING_APPLICATIONS)
    balances = (
        accounts.where(deposit | lending)
        .join(owners.select("account_key", "customer_key").distinct(), "account_key")
        .groupBy("customer_key")
        .agg(
            F.sum(F.when(deposit, F.col("average_balance"))).alias("average_deposit_balances"),
            F.sum(F.when(lending, F.col("book_balance"))).alias("average_lending_balances"),
        )
    )
    return (
        customers.join(primary_atm(atm, as_of, days), "customer_key", "left")
        .join(branches, "customer_key", "left")
        .join(balances, "customer_key", "left")
    )


def recent_activity_flags(
    base: DataFrame,
    trans: DataFrame,
    flags: dict[str, tuple[Column, int | None]],
    as_of: date | str | None = None,
    date_col: str = "transaction_date",
) -> DataFrame:
    """Base rows with one 0/1 flag per rule: 1 where the account has a matching row.

    ``flags`` maps a flag to its test and the days it looks back from ``as_of`` (``None``:
    any date). The transactions are read once for all flags.
    """
    tests = {
        name: test if days is None else test & date_window(date_col, as_of, days)
        for name, (test, days) in flags.items()
    }
    any_test = functools.reduce(operator.or_, tests.values())
    marked = (
        trans.where(any_test)
        .groupBy("account_key")
        .agg(*[F.max(F.when(test, 1).otherwise(0)).alias(name) for name, test in tests.items()])
    )
    return base.join(marked, "account_key", "left").fillna(0, subset=list(flags))


def recent_activity_flag(
    base: DataFrame,
    trans: DataFrame,
    predicate: Column,
    name: str,
    as_of: date | str | None = None,
    days: int | None = None,
    date_col: str = "transaction_date",
) -> DataFrame:
    """:func:`recent_activity_flags` for a single flag."""
    return recent_activity_flags(base, trans, {name: (predicate, days)}, as_of, date_col)
