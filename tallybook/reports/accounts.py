"""Status, relationships, account lists and the loan portfolio."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.operators import processing_dates
from tallybook.plans import conform, goals, portfolio
from tallybook.reports.report import Report
from tallybook.reports.shapes import Tables, money, ownership_type


def conformed(t: Tables):
    return conform.conformed_accounts(t.accounts, t.codes)


def base(t: Tables):
    """Relationships of all accounts; made once per query, as its lookups are read for it."""
    return t.derived("base", lambda: conform.build_relationship_base(
        t.xref, t.product_groups, t.ownership,
        conformed(t).select("account_key", "conformed_status"),
    ))


def conformed_columns(t: Tables):
    return conformed(t).select("account_key", "status_key", "conformed_status")


def unknown_kept(t: Tables):
    kept = conform.conformed_accounts(t.accounts, t.codes, default=None)
    return kept.select("account_key", "status_key", "conformed_status")


def direct_owners(t: Tables):
    kept = conform.direct_relationships(
        base(t), groups=["Deposit", "Lending"], statuses=["OPEN", "DORMANT"]
    )
    return kept.select(
        "account_key", "customer_key", "product_group", "conformed_status",
        "primary_customer_flag",
    )


def legacy_flags(t: Tables):
    return conform.activity_flags(base(t), legacy_active=True)


def business(t: Tables):
    return conform.business_accounts(t.accounts, t.codes, t.product_lookup).select(
        "account_key", "product_key", "conformed_status", "merchant_services_flag"
    )


def type_counts(t: Tables):
    return conform.relationship_type_counts(t.xref, t.accounts, t.month_spine)


def product_type_counts(t: Tables):
    return conform.relationship_type_counts(t.xref, t.accounts, t.month_spine, "1-A-JNT")


def estatements(t: Tables):
    delivery = t.raw("lineitem").select(
        F.col("l_orderkey").alias("account_key"),
        F.when(F.col("l_linestatus") == "O", "E").otherwise("P").alias("delivery_method"),
        F.when(F.col("l_returnflag") == "A", "STMT").otherwise("NOTICE").alias("form_category"),
    )
    return conform.estatement_accounts(delivery, t.accounts, t.product_lookup, t.codes).select(
        "account_key", "product_group", "conformed_status", "estatements"
    )


def _versions(t: Tables):
    """Account feed: one version of an account per line."""
    opened = t.accounts.select("account_key", "date_opened", "application_code", "opening_amount")
    lines = t.raw("lineitem").select(
        F.col("l_orderkey").alias("account_key"),
        F.to_date("l_shipdate").alias("snapshot_date"),
        F.concat(F.lit("1-"), F.pmod("l_partkey", F.lit(60)), F.lit("-")).alias("product_key"),
        F.col("l_returnflag").alias("gl_type"),
        F.col("l_linenumber").cast("string").alias("line"),
    )
    return lines.join(opened, "account_key").withColumn(
        "sub_application_code", F.col("application_code")
    )


def retail_deposits(t: Tables):
    gl = t.raw("lineitem").select("l_returnflag").distinct().select(
        F.col("l_returnflag").alias("gl_type_code"),
        F.explode(F.array(*[F.lit(c) for c in ("DD", "SV", "CD")])).alias("application_code"),
        F.when(F.col("l_returnflag") == "N", "COM ").otherwise("RETAIL ").alias("_kind"),
    ).withColumn("gl_type_description", F.concat("_kind", "application_code")).drop("_kind")
    return conform.retail_deposit_accounts(
        _versions(t), t.product_lookup, gl, "1996-01-01", ["line", "product_key", "gl_type"]
    )


def retail_columns(t: Tables):
    return retail_deposits(t).select(
        "account_key", "product_key", "gl_type", "gl_type_description", "date_opened"
    )


def usable(t: Tables):
    days = t.month_spine.select("snapshot_date")
    daily_codes = t.daily_codes
    owners = t.xref.select(
        "relationship_key", ownership_type("relationship_key"), "snapshot_date"
    ).distinct()
    return conform.xref_usable(
        t.xref.drop("application", "relationship_date"),
        owners,
        t.accounts.select("account_key", "product_key", "status_key", "snapshot_date"),
        daily_codes,
        t.product_lookup,
        goals.month_end_snapshots(processing_dates(days)),
        ["1-3-", "1-4-", "1-5-", "1-51-", "1-56-", "1-57-"],
    )


def _yearly(t: Tables):
    """Order amounts per customer and year, as loan snapshots of year-ends."""
    return t.raw("orders").select(
        F.col("o_custkey").alias("account_key"),
        F.make_date(F.year("o_orderdate"), F.lit(12), F.lit(31)).alias("snapshot_date"),
        "o_orderstatus",
        F.concat(
            F.when(F.pmod("o_custkey", F.lit(3)) == 0, "RET").when(
                F.pmod("o_custkey", F.lit(3)) == 1, "Retail").otherwise("COM "),
            F.pmod("o_custkey", F.lit(7)).cast("string"),
        ).alias("gl_type"),
        money("o_totalprice").alias("amount"),
    )


def loan_snapshots(t: Tables):
    rows = _yearly(t)
    key = ["account_key", "snapshot_date"]
    loans = rows.where(F.col("o_orderstatus") == "F").groupBy(*key, "gl_type").agg(
        F.sum("amount").alias("bank_owned_principle_assets")
    )
    loans_raw = rows.where(F.col("o_orderstatus") != "O").groupBy(
        *key, F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("participation_number")
    ).agg(F.max("amount").alias("original_loan_amount"))
    mortgages = rows.where(F.col("o_orderstatus") == "O").groupBy(*key, "gl_type").agg(
        F.sum("amount").alias("bank_owned_principle_assets")
    )
    mortgages_raw = rows.where(F.col("o_orderstatus") == "P").groupBy(*key).agg(
        F.max("amount").alias("orig_principal_balance")
    )
    return portfolio.portfolio_snapshot(loans, loans_raw, mortgages, mortgages_raw)


def growth(t: Tables):
    rows = _yearly(t)
    return portfolio.portfolio_growth(
        rows.groupBy("account_key", "snapshot_date").agg(
            F.sum("amount").alias("bank_owned_principle_assets"),
            F.max("amount").alias("original_amount"),
        )
    )


USABLE_SQL = """
SELECT x.account_key, customer_key, primary_customer_flag, ownership_type, conformed_status,
       retail_product_designation,
       last_day(x.snapshot_date) AS me_utc_timestamp
FROM d_xref x JOIN d_ownership USING (relationship_key)
JOIN d_conformed a ON a.account_key = x.account_key
JOIN d_product_lookup USING (product_key)
WHERE retail_product_designation IN ('Product', 'Service')
  AND product_key NOT IN ('1-3-', '1-4-', '1-5-', '1-51-', '1-56-', '1-57-')"""

RETAIL_SQL = """
SELECT v.account_key, product_key, gl_type,
       'RETAIL ' || application_code AS gl_type_description, date_opened, application_code,
       opening_amount
FROM (
  SELECT l_orderkey AS account_key, l_returnflag AS gl_type,
         '1-' || CAST(l_partkey % 60 AS VARCHAR) || '-' AS product_key
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_shipdate AS DATE) DESC,
    l_linenumber, '1-' || CAST(l_partkey % 60 AS VARCHAR) || '-', l_returnflag) = 1) v
JOIN (SELECT account_key, date_opened, application_code, opening_amount FROM d_accounts) a
  ON a.account_key = v.account_key
WHERE application_code IN ('DD', 'SV', 'CD') AND date_opened >= DATE '1996-01-01'
  AND gl_type <> 'N'
  AND product_key IN (SELECT product_key FROM d_product_lookup
                      WHERE consumer_or_business_product = 'Consumer')"""

YEARLY_SQL = """
SELECT o_custkey AS account_key, make_date(year(o_orderdate), 12, 31) AS snapshot_date,
       o_orderstatus,
       CASE o_custkey % 3 WHEN 0 THEN 'RET' WHEN 1 THEN 'Retail' ELSE 'COM ' END
         || CAST(o_custkey % 7 AS VARCHAR) AS gl_type,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount
FROM orders"""

REPORTS = [
    Report("conformed_accounts", conformed_columns, """
SELECT account_key, status_key, conformed_status FROM d_conformed"""),
    Report("unmatched_status_kept", unknown_kept, """
SELECT account_key, status_key, conformed_status
FROM d_accounts LEFT JOIN d_status USING (status_key)"""),
    Report("relationship_base", base, "SELECT * FROM d_base"),
    Report("direct_relationships", direct_owners, """
SELECT account_key, customer_key, product_group, conformed_status, primary_customer_flag
FROM d_base WHERE ownership_type = 'Direct' AND product_group IN ('Deposit', 'Lending')
  AND conformed_status IN ('OPEN', 'DORMANT')
QUALIFY row_number() OVER (PARTITION BY account_key, customer_key
  ORDER BY primary_customer_flag DESC, product_group, conformed_status) = 1"""),
    Report("activity_flags", lambda t: conform.activity_flags(base(t)), """
SELECT customer_key,
       max(CASE WHEN conformed_status IN ('OPEN', 'DORMANT') THEN 'Y' ELSE 'N' END) AS is_active,
       max(CASE WHEN conformed_status IN ('OPEN', 'DORMANT') AND ownership_type = 'Direct'
           AND product_group IN ('Deposit', 'Lending') THEN 'Y' ELSE 'N' END) AS is_direct
FROM d_base GROUP BY 1"""),
    Report("activity_flags_legacy", legacy_flags, """
SELECT customer_key, 'Y' AS is_active,
       max(CASE WHEN conformed_status IN ('OPEN', 'DORMANT') AND ownership_type = 'Direct'
           AND product_group IN ('Deposit', 'Lending') THEN 'Y' ELSE 'N' END) AS is_direct
FROM d_base GROUP BY 1"""),
    Report("business_accounts", business, """
SELECT account_key, product_key, conformed_status,
       CASE WHEN product_key = '1-55-' THEN 1 ELSE 0 END AS merchant_services_flag
FROM d_conformed WHERE product_key IN (
  SELECT product_key FROM d_product_lookup WHERE consumer_or_business_product = 'Business')"""),
    Report("relationship_type_counts", type_counts, """
SELECT snapshot_date, relationship_key, count(*) AS relationship_count
FROM d_xref GROUP BY 1, 2""", dates=("snapshot_date",)),
    Report("relationship_product_counts", product_type_counts, """
SELECT x.snapshot_date, product_key, count(*) AS relationship_count
FROM d_xref x LEFT JOIN d_accounts a ON x.account_key = a.account_key
WHERE relationship_key = '1-A-JNT' GROUP BY 1, 2""", dates=("snapshot_date",)),
    Report("estatement_accounts", estatements, """
SELECT account_key, product_group, conformed_status, e.estatements
FROM d_conformed JOIN d_product_lookup USING (product_key)
LEFT JOIN (SELECT DISTINCT l_orderkey AS account_key, 1 AS estatements FROM lineitem
           WHERE l_linestatus = 'O' AND l_returnflag = 'A') e USING (account_key)
WHERE conformed_status IN ('OPEN', 'DORMANT') AND product_group IN ('Deposit', 'Lending')"""),
    Report("retail_deposit_accounts", retail_columns, f"""
SELECT account_key, product_key, gl_type, gl_type_description, date_opened
FROM ({RETAIL_SQL})""", dates=("date_opened",)),
    Report("xref_usable", usable, USABLE_SQL, dates=("me_utc_timestamp",)),
    Report("month_end_snapshots", lambda t: goals.month_end_snapshots(
        processing_dates(t.raw("orders").select(F.to_date("o_orderdate").alias("snapshot_date")))
    ), """
SELECT last_day(CAST(o_orderdate AS DATE)) AS month_end,
       CAST(max(o_orderdate) AS DATE) AS snapshot_date
FROM orders GROUP BY 1""", dates=("month_end", "snapshot_date")),
    Report("portfolio_snapshot", loan_snapshots, f"""
WITH y AS ({YEARLY_SQL}),
lr AS (SELECT account_key, snapshot_date, max(amount) AS original_amount
       FROM y WHERE o_orderstatus = 'F' GROUP BY 1, 2),
mr AS (SELECT account_key, snapshot_date, max(amount) AS original_amount
       FROM y WHERE o_orderstatus = 'P' GROUP BY 1, 2),
own AS (SELECT account_key, snapshot_date, o_orderstatus, gl_type,
               sum(amount) AS bank_owned_principle_assets
        FROM y WHERE o_orderstatus <> 'P' AND gl_type LIKE 'R%' GROUP BY ALL)
SELECT account_key, snapshot_date, gl_type, bank_owned_principle_assets, original_amount
FROM own JOIN lr USING (account_key, snapshot_date) WHERE o_orderstatus = 'F'
UNION ALL
SELECT account_key, snapshot_date, gl_type, bank_owned_principle_assets, original_amount
FROM own LEFT JOIN mr USING (account_key, snapshot_date) WHERE o_orderstatus = 'O'""",
           dates=("snapshot_date",), money=("bank_owned_principle_assets", "original_amount")),
    Report("portfolio_growth", growth, """
WITH y AS (
  SELECT o_custkey AS a, CAST(year(o_orderdate) AS INTEGER) AS yr,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS owned,
         max(CAST(o_totalprice AS DECIMAL(18,2))) AS original
  FROM orders GROUP BY 1, 2)
SELECT n.yr AS portfolio_year,
       (SELECT sum(owned) FROM y p WHERE p.yr = n.yr - 1) AS begin_existing,
       sum(owned) FILTER (EXISTS (SELECT 1 FROM y p WHERE p.a = n.a AND p.yr = n.yr - 1))
         AS end_existing,
       sum(original) FILTER (NOT EXISTS (SELECT 1 FROM y p WHERE p.a = n.a AND p.yr = n.yr - 1))
         AS begin_new,
       sum(owned) FILTER (NOT EXISTS (SELECT 1 FROM y p WHERE p.a = n.a AND p.yr = n.yr - 1))
         AS end_new
FROM y n WHERE n.yr > (SELECT min(yr) FROM y) GROUP BY n.yr""",
           money=("begin_existing", "end_existing", "begin_new", "end_new")),
]
