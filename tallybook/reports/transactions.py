"""Transactions, terminals and activity flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook import functions as fn
from tallybook.operators import latest_per_key
from tallybook.plans import conform
from tallybook.plans import transactions as tx
from tallybook.reports.report import Report
from tallybook.reports.shapes import Tables

AS_OF = "1999-06-30"


def tagged(t: Tables):
    return tx.tag_transactions(
        t.transactions, tx.PROCESSOR_PHRASES, tx.PROCESSOR_EXCLUSIONS, tx.PROCESSOR_RULES,
        tx.WALLET_DEFAULT,
    )


def payday(t: Tables):
    kept = tx.tag_transactions(
        t.transactions, tx.PAYDAY_PHRASES, tx.PAYDAY_EXCLUSIONS, case_sensitive=True
    )
    return tx.daily_rollup(kept, ["account_key", "transaction_date", "db_cr_flag"])


def wallets(t: Tables):
    return tx.daily_rollup(
        tx.tag_transactions(
            t.transactions, tx.WALLET_PHRASES, tx.WALLET_EXCLUSIONS, tx.WALLET_RULES,
            tx.WALLET_DEFAULT,
        )
    )


def credits(t: Tables):
    return tx.monthly_credits(t.transactions, t.xref)


def merchants(t: Tables):
    business = conform.business_accounts(t.accounts, t.codes, t.product_lookup)
    owned = t.xref.select("account_key", "customer_key").join(
        business.select("account_key", "conformed_status", "merchant_services_flag"), "account_key"
    )
    trans = t.transactions.withColumn("original_process_date", F.col("transaction_date"))
    users = t.customers.select("customer_key")
    return tx.merchant_credit_profile(users, owned, trans, "1996-12-31")


def opening(t: Tables):
    """Opening amounts: the account's smallest and its second line's amount."""
    accounts = t.accounts.withColumn("conformed_status", F.lit("OPEN")).select(
        "account_key", "conformed_status", "date_opened"
    )
    raw = t.transactions.groupBy("account_key").agg(
        F.min("transaction_amount").alias("opening_amount"),
        F.max("transaction_amount").alias("opening_deposit"),
    )
    matched = tx.opening_deposit_match(
        accounts, raw, t.transactions, "1998-01-01", ["transaction_id", "transaction_amount"]
    )
    return matched.select(
        "account_key", "transaction_date", "transaction_id", "transaction_amount", "date_opened"
    )


def new_accounts(t: Tables):
    return tx.new_accounts_by_month(
        t.accounts.withColumn("sub_application_code", F.col("application_code"))
    )


def _cards(t: Tables):
    """A card per order: sixteen digits, the last one the check digit."""
    cards = t.raw("orders").select(
        F.lpad((F.col("o_orderkey") * 10 + 7).cast("string"), 16, "0").alias("account_number"),
        F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("customer_key"),
        F.when(F.col("o_orderstatus") == "P", "DD").otherwise("CA").alias("application"),
        F.when(F.col("o_orderpriority") == "5-LOW", "N").otherwise("Y").alias(
            "primary_customer_flag"
        ),
        F.lit("Direct").alias("ownership_type"),
    )
    return tx.card_owners(cards)


def _atm(t: Tables):
    kinds = ["WITHDRAWAL", "INQUIRY", "TRANSFER", "CASH ONLY DEPOSIT", "CHECKS ONLY DEPOSIT",
             "PURCHASE", "REFUND"]
    line = F.col("l_linenumber")
    terminal = F.pmod("l_suppkey", F.lit(20))
    trans = t.raw("lineitem").select(
        F.col("l_orderkey").alias("pan"),
        fn.classify([(line == i, k) for i, k in enumerate(kinds, 1)]).alias(
            "transaction_type_description"
        ),
        F.when(F.col("l_linestatus") == "O", "OWN BANK").otherwise("OTHER").alias("merchant_name"),
        F.when(terminal == 0, "99999999").otherwise(F.concat(F.lit("T"), terminal)).alias(
            "card_acceptor_terminal_id"
        ),
        F.concat(
            F.lit("SITE "), terminal,
            F.when(F.col("l_returnflag") == "A", " OWN-1").otherwise(" STREET"),
        ).alias("card_acceptor_terminal_location"),
        F.to_date("l_shipdate").alias("calibrated_transaction_date"),
    )
    return tx.atm_transactions(trans, _cards(t), "OWN BANK", "OWN")


def atm(t: Tables):
    return _atm(t)


def atm_profile(t: Tables):
    people = t.customers.select(
        F.col("customer_key").cast("string").alias("customer_key"), "customer_type",
        F.col("short_name").alias("customer_name"),
    )
    branches = t.customers.select(
        F.col("customer_key").cast("string").alias("customer_key"),
        F.concat(F.lit("Branch "), "opening_branch").alias("dynamic_branch_name"),
    )
    accounts = t.accounts.select(
        "account_key", "application_code",
        F.col("opening_amount").alias("average_balance"),
        (F.col("opening_amount") * 2).cast("decimal(18,2)").alias("book_balance"),
    )
    owners = t.direct.select("account_key", F.col("customer_key").cast("string"))
    return tx.customer_atm_profile(people, _atm(t), branches, accounts, owners, AS_OF, 2000)


def activity(t: Tables):
    base = t.xref.select("account_key", "customer_key")
    nsf = F.col("transaction_code") == tx.NSF_CODE
    return tx.recent_activity_flag(base, t.transactions, nsf, "nsf_flag", AS_OF, 365)


def active(t: Tables):
    newest = latest_per_key(t.presence, ["customer_key"], "snapshot_date")
    everyone = t.customers.select("customer_key").join(newest, "customer_key", "left")
    return everyone.select(
        "customer_key", fn.active_within("snapshot_date", "2024-02-28", 30).alias("active_30")
    )


_LOW = "lower(description)"
_PROCESSOR_SQL = f"""
SELECT account_key, transaction_date, transaction_code, transaction_amount, db_cr_flag,
       description, transaction_id,
       CASE WHEN {_LOW} LIKE '%paypal%' THEN 'PayPal' WHEN {_LOW} LIKE '%intuit%' THEN 'Intuit'
         WHEN {_LOW} LIKE '%quickbooks%' THEN 'Quickbooks' WHEN {_LOW} LIKE '%venmo%' THEN 'Venmo'
         WHEN {_LOW} LIKE '%stripe.com%' OR {_LOW} LIKE '%stripe/%' THEN 'Stripe'
         ELSE 'Square' END AS trans_type_flag
FROM d_transactions
WHERE ({_LOW} LIKE '%purch sq%' OR {_LOW} LIKE '%gosq.com%' OR {_LOW} LIKE '%paypal%'
    OR {_LOW} LIKE '%square inc%' OR {_LOW} LIKE '%squareup.com%' OR {_LOW} LIKE '%intuit%'
    OR {_LOW} LIKE '%quickbooks%' OR {_LOW} LIKE '%stripe.com%' OR {_LOW} LIKE '%stripe/%'
    OR {_LOW} LIKE '%venmo%')
  AND {_LOW} NOT LIKE '%square enix%' AND {_LOW} NOT LIKE '%intuitive%'
  AND {_LOW} NOT LIKE '%intuition%'"""

_CARDS_SQL = """
SELECT DISTINCT CASE WHEN o_custkey = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END
         AS customer_key,
       CASE WHEN o_orderkey = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS pan
FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority IN
  ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')"""

_ATM_SQL = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS pan,
       CASE l_linenumber WHEN 1 THEN 'WITHDRAWAL' WHEN 2 THEN 'INQUIRY' WHEN 3 THEN 'TRANSFER'
         WHEN 4 THEN 'CASH ONLY DEPOSIT' ELSE 'CHECKS ONLY DEPOSIT' END
         AS transaction_type_description,
       'OWN BANK' AS merchant_name, 'T' || CAST(l_suppkey % 20 AS VARCHAR)
         AS card_acceptor_terminal_id,
       'SITE ' || CAST(l_suppkey % 20 AS VARCHAR)
         || CASE WHEN l_returnflag = 'A' THEN ' OWN' ELSE ' STREET' END
         AS card_acceptor_terminal_location,
       CAST(l_shipdate AS DATE) AS calibrated_transaction_date, customer_key
FROM lineitem LEFT JOIN ({_CARDS_SQL}) ON CAST(l_orderkey AS VARCHAR) = pan
WHERE l_linenumber <= 5 AND l_linestatus = 'O' AND l_suppkey % 20 <> 0"""

REPORTS = [
    Report("tag_transactions", tagged, _PROCESSOR_SQL, dates=("transaction_date",),
           money=("transaction_amount",)),
    Report("daily_rollup", lambda t: tx.daily_rollup(tagged(t)), f"""
SELECT account_key, transaction_date, trans_type_flag, db_cr_flag,
       count(*) AS transaction_count, sum(transaction_amount) AS transaction_amount
FROM ({_PROCESSOR_SQL}) GROUP BY ALL""", dates=("transaction_date",),
           money=("transaction_amount",)),
    Report("wallet_rollup", wallets, f"""
SELECT account_key, transaction_date, db_cr_flag,
       CASE WHEN {_LOW} LIKE '%paypal%' THEN 'PayPal' ELSE 'Square' END AS trans_type_flag,
       count(*) AS transaction_count, sum(transaction_amount) AS transaction_amount
FROM d_transactions
WHERE ({_LOW} LIKE '%purch sq%' OR {_LOW} LIKE '%gosq.com%' OR {_LOW} LIKE '%paypal%'
    OR {_LOW} LIKE '%square inc%' OR {_LOW} LIKE '%squareup.com%')
  AND {_LOW} NOT LIKE '%square enix%'
GROUP BY ALL""", dates=("transaction_date",), money=("transaction_amount",)),
    Report("payday_rollup", payday, """
SELECT account_key, transaction_date, db_cr_flag, count(*) AS transaction_count,
       sum(transaction_amount) AS transaction_amount
FROM d_transactions
WHERE description LIKE '%SPEEDY CASH%' AND description NOT LIKE '%SPEEDY CASH PAWN%'
GROUP BY ALL""", dates=("transaction_date",), money=("transaction_amount",)),
    Report("monthly_credits", credits, """
SELECT x.customer_key, strftime(transaction_date, '%Y-%m-01') AS transaction_date_month,
       count(*) AS transaction_count, sum(transaction_amount) AS transaction_amount
FROM d_transactions t
LEFT JOIN (SELECT account_key, customer_key FROM d_xref WHERE primary_customer_flag = 'Y') x
  USING (account_key)
WHERE transaction_code = 21 AND lower(description) NOT LIKE '%refund%'
GROUP BY 1, 2""", money=("transaction_amount",)),
    Report("merchant_credit_profile", merchants, f"""
WITH a AS (
  SELECT x.customer_key, x.account_key,
         CASE WHEN product_key = '1-55-' THEN 1 ELSE 0 END AS merchant
  FROM d_xref x JOIN d_conformed c ON c.account_key = x.account_key
  JOIN d_customers u ON u.customer_key = x.customer_key
  WHERE conformed_status = 'OPEN' AND product_key IN (
    SELECT product_key FROM d_product_lookup WHERE consumer_or_business_product = 'Business')),
m AS (SELECT customer_key, max(merchant) AS merchant_services_flag FROM a GROUP BY 1),
c AS (
  SELECT a.customer_key,
         count(*) FILTER ({_LOW} LIKE '%paypal%') AS paypal_credits,
         count(*) FILTER ({_LOW} LIKE '%zelle%') AS zelle_credits,
         count(*) FILTER ({_LOW} LIKE '%venmo%') AS venmo_credits,
         count(*) FILTER ({_LOW} LIKE '%cash app%') AS cashapp_credits,
         count(*) FILTER ({_LOW} LIKE '%stripe/%' OR {_LOW} LIKE '%/stripe%'
           OR {_LOW} LIKE '%stripe transfer%') AS stripe_credits,
         count(*) FILTER ({_LOW} LIKE '%square inc%' AND {_LOW} NOT LIKE '%cash app%')
           AS square_credits
  FROM a LEFT JOIN d_transactions t ON t.account_key = a.account_key AND db_cr_flag = 'C'
    AND transaction_date > DATE '1996-12-31' GROUP BY 1)
SELECT c.*, merchant_services_flag,
       CASE WHEN paypal_credits + zelle_credits + venmo_credits + cashapp_credits
         + stripe_credits + square_credits > 0 THEN 'yes' ELSE 'no' END
         AS has_credit_from_select_merchants
FROM c JOIN m USING (customer_key)"""),
    Report("opening_deposit_match", opening, """
WITH f AS (
  SELECT * FROM d_transactions WHERE transaction_amount > 0
  QUALIFY row_number() OVER (PARTITION BY account_key
    ORDER BY transaction_date, transaction_id, transaction_amount) = 1),
r AS (SELECT account_key, min(transaction_amount) AS lo, max(transaction_amount) AS hi
      FROM d_transactions GROUP BY 1)
SELECT f.account_key, transaction_date, transaction_id, transaction_amount, date_opened
FROM f JOIN r ON r.account_key = f.account_key
JOIN d_accounts a ON a.account_key = f.account_key
WHERE date_opened >= DATE '1998-01-01' AND transaction_amount IN (lo, hi)""",
           dates=("transaction_date", "date_opened"), money=("transaction_amount",)),
    Report("new_accounts_by_month", new_accounts, """
SELECT strftime(date_opened, '%Y') AS year, strftime(date_opened, '%m') AS month,
       application_code AS product_type, count(DISTINCT account_key) AS number_of_new_accounts,
       sum(opening_amount) AS total_new_deposit_dollars
FROM d_accounts GROUP BY 1, 2, 3""", money=("total_new_deposit_dollars",)),
    Report("atm_transactions", atm, _ATM_SQL, dates=("calibrated_transaction_date",)),
    Report("primary_atm", lambda t: tx.primary_atm(_atm(t), AS_OF, 90), f"""
SELECT customer_key, card_acceptor_terminal_id AS primary_atm FROM ({_ATM_SQL})
WHERE calibrated_transaction_date BETWEEN DATE '{AS_OF}' - 90 AND DATE '{AS_OF}'
  AND customer_key IS NOT NULL
GROUP BY 1, 2
QUALIFY row_number() OVER (PARTITION BY customer_key
  ORDER BY count(*) DESC, card_acceptor_terminal_id) = 1"""),
    Report("customer_atm_profile", atm_profile, f"""
WITH p AS (
  SELECT customer_key, card_acceptor_terminal_id AS primary_atm FROM ({_ATM_SQL})
  WHERE calibrated_transaction_date BETWEEN DATE '{AS_OF}' - 2000 AND DATE '{AS_OF}'
    AND customer_key IS NOT NULL
  GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY customer_key
    ORDER BY count(*) DESC, card_acceptor_terminal_id) = 1),
b AS (
  SELECT CAST(customer_key AS VARCHAR) AS customer_key,
         sum(opening_amount) FILTER (application_code IN ('DD', 'SV', 'CD', 'IR'))
           AS average_deposit_balances,
         sum(opening_amount * 2) FILTER (application_code IN ('LN', 'ML'))
           AS average_lending_balances
  FROM d_direct JOIN d_accounts USING (account_key) GROUP BY 1)
SELECT CAST(c.customer_key AS VARCHAR) AS customer_key, customer_type,
       short_name AS customer_name, primary_atm,
       'Branch ' || CAST(opening_branch AS VARCHAR) AS dynamic_branch_name,
       average_deposit_balances, average_lending_balances
FROM d_customers c LEFT JOIN p ON p.customer_key = CAST(c.customer_key AS VARCHAR)
LEFT JOIN b ON b.customer_key = CAST(c.customer_key AS VARCHAR)""",
           money=("average_deposit_balances", "average_lending_balances")),
    Report("recent_activity_flag", activity, f"""
SELECT account_key, customer_key,
       CASE WHEN account_key IN (
         SELECT account_key FROM d_transactions WHERE transaction_code = 71
           AND transaction_date BETWEEN DATE '{AS_OF}' - 365 AND DATE '{AS_OF}')
         THEN 1 ELSE 0 END AS nsf_flag
FROM d_xref"""),
    Report("active_within", active, """
SELECT c_custkey AS customer_key,
       CASE WHEN d > DATE '2024-02-28' - 30 THEN 'yes' ELSE 'no' END AS active_30
FROM customer LEFT JOIN (SELECT customer_key, max(snapshot_date) AS d FROM d_presence GROUP BY 1)
  ON customer_key = c_custkey"""),
]
