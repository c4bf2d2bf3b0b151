"""Dynamic branch assignment and products per customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.operators import processing_dates, settled_spine
from tallybook.plans import branches, conform, goals
from tallybook.reports import accounts
from tallybook.reports.report import Report
from tallybook.reports.shapes import Tables

AS_OF = "1999-06-30"


def _flags(t: Tables):
    return conform.activity_flags(accounts.base(t))


def unified_teller(t: Tables):
    lines = t.raw("lineitem")
    letter = F.element_at(
        F.array(*[F.lit(x) for x in "DSLMBTRX"]), (F.pmod("l_orderkey", F.lit(8)) + 1).cast("int")
    )
    classic = lines.where(F.col("l_linestatus") == "F").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("composite_key"),
        letter.alias("type_of_account_1"),
        F.col("l_orderkey").alias("account_number_1"),
        F.col("l_partkey").alias("cif_number"),
        F.pmod("l_suppkey", F.lit(10)).alias("branch_number"),
        F.col("l_shipdate").alias("system_date"),
        F.col("l_shipdate").alias("utc_timestamp"),
    )
    current = lines.where(F.col("l_linestatus") == "O").select(
        F.concat_ws("/", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.when(F.col("l_returnflag") != "R", F.col("l_orderkey").cast("string")).alias(
            "account_key_1"
        ),
        F.col("l_partkey").alias("primary_owner_key"),
        F.pmod("l_suppkey", F.lit(10)).alias("branch_number"),
        F.col("l_shipdate").alias("transaction_date"),
        F.col("l_shipdate").alias("utc_timestamp"),
    )
    return branches.unify_teller(classic, current)


def account_list(t: Tables):
    accounts_feed = t.raw("lineitem").select(
        F.col("l_orderkey").alias("account_key"),
        F.col("l_suppkey").alias("org_key"),
        F.col("l_shipdate").alias("utc_timestamp"),
        F.when(F.col("l_linenumber") < 7, F.col("l_shipdate")).alias("date_opened"),
    )
    return branches.account_branches(accounts_feed, t.orgs)


def assignment(t: Tables):
    return branches.dynamic_branch(t.customers, t.teller, t.direct, t.accts, _flags(t), AS_OF)


def history(t: Tables):
    return branches.dynamic_branch_history(
        t.customers, t.teller, t.direct, t.accts, _flags(t), t.month_spine
    )


def owned_runs(t: Tables):
    """Users as owners of the event types they used, day by day."""
    types = F.col("event_type")
    daily = t.raw("events").select(
        F.when(types == "click", 1).when(types == "view", 2).otherwise(3).alias("account_key"),
        F.col("user_id").alias("customer_key"),
        F.when(types == "purchase", "Y").otherwise("N").alias("primary_customer_flag"),
        F.to_date("ts").alias("snapshot_date"),
    )
    return branches.ownership_runs(daily, processing_dates(t.presence))


def named(t: Tables):
    return branches.assignment_with_names(assignment(t), t.branch_lookup)


def majority(t: Tables):
    """Daily branch of customers with teller use, by month, and their officers."""
    uses = t.teller.join(t.direct, "account_key")
    daily = uses.groupBy("customer_key", F.col("transaction_date").alias("snapshot_date")).agg(
        F.min("branch_number").cast("string").alias("dynamic_branch_name")
    )
    daily = daily.withColumns(
        {
            "primary_branch_name": F.when(
                F.col("dynamic_branch_name") != "9", F.col("dynamic_branch_name")
            ),
            "direct_branch_name": F.lit(None).cast("string"),
            "is_direct": F.when(
                F.pmod("customer_key", F.lit(5)) == 0, "N").otherwise("Y"),
        }
    )
    officers = t.raw("orders").select(
        F.col("o_custkey").alias("customer_key"),
        F.to_date("o_orderdate").alias("snapshot_date"),
        F.col("o_orderpriority").alias("primary_officer"),
    )
    return branches.monthly_majority(daily, officers)


def reprocessed(t: Tables):
    daily_base = accounts.base(t).join(
        t.xref.select("account_key", "snapshot_date").distinct(), "account_key"
    )
    written = daily_base.select("customer_key", "snapshot_date").distinct().select(
        "customer_key",
        F.pmod("customer_key", F.lit(25)).cast("int").alias("dynamic_branch_assignment"),
        F.lit("?").alias("is_active"),
        F.lit("?").alias("is_direct"),
        "snapshot_date",
    )
    return branches.reprocess_flags(written, daily_base)


def user_branch(t: Tables):
    events = t.raw("events")
    trans = events.where(F.col("event_type") == "purchase").select(
        F.col("user_id"),
        F.to_date("ts").alias("transaction_date"),
        F.pmod("event_id", F.lit(5)).alias("branch_number"),
    )
    logs = events.where(F.col("event_type") == "view").select(
        "event_id", "user_id", F.to_date("ts").alias("log_date")
    )
    return branches.user_branch(trans, logs)


def latest(t: Tables):
    daily = t.teller.join(t.direct, "account_key").select(
        "customer_key",
        F.col("transaction_date").alias("snapshot_date"),
        F.col("branch_number").cast("string").alias("dynamic_branch_name"),
    )
    return branches.latest_assignment(daily)


# products per customer: relationships of an order's month, nation as branch ---------------

YEAR = 1999


def _assignments(t: Tables):
    nations = t.raw("nation").select(
        F.col("n_nationkey").alias("opening_branch"), F.col("n_name").alias("dynamic_branch_name")
    )
    officer = F.when(F.col("customer_type") == "BUILDING", "COM").otherwise("RTL")
    people = t.customers.join(nations, "opening_branch").select(
        "customer_key", "dynamic_branch_name", officer.alias("dynamic_officer_assignment")
    )
    months = t.xref.select("customer_key", F.last_day("snapshot_date").alias("me_utc_timestamp"))
    return months.distinct().join(people, "customer_key")


def counts(t: Tables):
    return goals.product_counts(accounts.usable(t), _assignments(t), ["NATION_3", "NATION_7"])


def _rounded(df):
    numeric = [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(c, 6) for c in numeric})


def quarterly(t: Tables):
    return _rounded(goals.quarterly_products_per_customer(counts(t), YEAR - 1, "prior_year"))


def ladder(t: Tables):
    return _rounded(goals.branch_goals(counts(t), YEAR))


def monthly(t: Tables):
    return _rounded(goals.branch_month_means(counts(t)).drop("quarter"))


def monthly_wide(t: Tables):
    """Branch by month-end, a column for every month of the spine."""
    days = settled_spine(t.month_spine)
    ends = days.select(F.last_day("snapshot_date").cast("string").alias("day")).orderBy("day")
    months = [r.day for r in ends.collect()]  # one per month
    wide = goals.monthly_products_pivot(counts(t), months)
    return _rounded(wide).withColumnsRenamed({m: f"m_{m[:4]}_{m[5:7]}" for m in months})


def top_customers(t: Tables, rank: str | None = None):
    people = t.customers.select(
        "customer_key",
        F.when(F.col("customer_type") == "BUILDING", "Business").otherwise("Personal").alias(
            "customer_type"
        ),
    )
    return goals.top_customers_by_products(accounts.base(t), people, assignment(t), rank=rank)


def _used_sql(primary: bool, name: str) -> str:
    test = "AND primary_customer_flag = 'Y'" if primary else ""
    return f"""
SELECT customer_key, branch_number AS {name}
FROM d_teller JOIN d_direct USING (account_key)
WHERE transaction_date BETWEEN DATE '{AS_OF}' - 365 AND DATE '{AS_OF}' {test}
GROUP BY customer_key, branch_number
QUALIFY row_number() OVER (PARTITION BY customer_key
  ORDER BY count(*) DESC, branch_number) = 1"""


_ACCOUNT_SQL = f"""
SELECT customer_key, branch_id AS acct_branch_number
FROM d_accts JOIN d_direct USING (account_key) WHERE date_opened <= DATE '{AS_OF}'
QUALIFY row_number() OVER (PARTITION BY customer_key
  ORDER BY date_opened DESC, account_key) = 1"""

_FLAGS_SQL = """
SELECT customer_key,
       max(CASE WHEN conformed_status IN ('OPEN', 'DORMANT') THEN 'Y' ELSE 'N' END) AS is_active,
       max(CASE WHEN conformed_status IN ('OPEN', 'DORMANT') AND ownership_type = 'Direct'
           AND product_group IN ('Deposit', 'Lending') THEN 'Y' ELSE 'N' END) AS is_direct
FROM d_base GROUP BY 1"""

_DYNAMIC_SQL = f"""
SELECT c.customer_key, primary_branch_number, direct_branch_number, acct_branch_number,
       opening_branch,
       coalesce(primary_branch_number, direct_branch_number, acct_branch_number, opening_branch)
         AS dynamic_branch_assignment,
       coalesce(is_active, 'N') AS is_active, coalesce(is_direct, 'N') AS is_direct,
       DATE '{AS_OF}' AS snapshot_date
FROM d_customers c
LEFT JOIN ({_used_sql(True, 'primary_branch_number')}) USING (customer_key)
LEFT JOIN ({_used_sql(False, 'direct_branch_number')}) USING (customer_key)
LEFT JOIN ({_ACCOUNT_SQL}) USING (customer_key)
LEFT JOIN ({_FLAGS_SQL}) USING (customer_key)"""


def _used_history_sql(primary: bool, name: str) -> str:
    test = "AND primary_customer_flag = 'Y'" if primary else ""
    return f"""
SELECT customer_key, snapshot_date, branch_number AS {name}
FROM d_teller JOIN d_direct USING (account_key)
JOIN d_month_spine ON transaction_date BETWEEN snapshot_date - 365 AND snapshot_date {test}
GROUP BY customer_key, snapshot_date, branch_number
QUALIFY row_number() OVER (PARTITION BY customer_key, snapshot_date
  ORDER BY count(*) DESC, branch_number) = 1"""


_HISTORY_SQL = f"""
SELECT c.customer_key, primary_branch_number, direct_branch_number, acct_branch_number,
       opening_branch,
       coalesce(primary_branch_number, direct_branch_number, acct_branch_number, opening_branch)
         AS dynamic_branch_assignment,
       coalesce(is_active, 'N') AS is_active, coalesce(is_direct, 'N') AS is_direct,
       s.snapshot_date
FROM d_customers c JOIN d_month_spine s ON TRUE
LEFT JOIN ({_used_history_sql(True, 'primary_branch_number')}) p
  ON p.customer_key = c.customer_key AND p.snapshot_date = s.snapshot_date
LEFT JOIN ({_used_history_sql(False, 'direct_branch_number')}) d
  ON d.customer_key = c.customer_key AND d.snapshot_date = s.snapshot_date
LEFT JOIN (
  SELECT customer_key, snapshot_date, branch_id AS acct_branch_number
  FROM d_accts JOIN d_direct USING (account_key) JOIN d_month_spine
    ON date_opened <= snapshot_date
  QUALIFY row_number() OVER (PARTITION BY customer_key, snapshot_date
    ORDER BY date_opened DESC, account_key) = 1) a
  ON a.customer_key = c.customer_key AND a.snapshot_date = s.snapshot_date
LEFT JOIN ({_FLAGS_SQL}) f ON f.customer_key = c.customer_key"""

_NAME_SOURCES = {
    "primary_branch": "primary_branch_number",
    "direct_branch": "direct_branch_number",
    "acct_branch": "acct_branch_number",
    "rm_branch": "opening_branch",
    "dynamic_branch": "dynamic_branch_assignment",
}
_NAMED_SQL = (
    "SELECT customer_key, "
    + ", ".join(
        f"CAST({source} AS VARCHAR) AS {name}_id, "
        f"coalesce((SELECT n_name FROM nation WHERE n_nationkey = {source}), "
        f"CAST({source} AS VARCHAR)) AS {name}_name"
        for name, source in _NAME_SOURCES.items()
    )
    + f", is_active, is_direct, snapshot_date FROM ({_DYNAMIC_SQL})"
)

_COUNTS_SQL = f"""
SELECT n_name AS dynamic_branch_name, customer_key, me_utc_timestamp,
       year(me_utc_timestamp) || '_' || quarter(me_utc_timestamp) AS quarter, account_key
FROM ({accounts.USABLE_SQL}) u
JOIN customer ON c_custkey = customer_key JOIN nation ON n_nationkey = c_nationkey
WHERE ownership_type = 'Direct' AND conformed_status IN ('OPEN', 'DORMANT')
  AND c_mktsegment <> 'BUILDING' AND n_name NOT IN ('NATION_3', 'NATION_7')"""

_MONTH_SQL = f"""
SELECT dynamic_branch_name, me_utc_timestamp, quarter, avg(n) AS mean_products FROM (
  SELECT dynamic_branch_name, customer_key, me_utc_timestamp, quarter,
         count(DISTINCT account_key) AS n
  FROM ({_COUNTS_SQL}) GROUP BY ALL) GROUP BY ALL"""


def _quarter_sql(year: int, prefix: str) -> str:
    columns = ", ".join(
        f"max(q) FILTER (quarter = '{year}_{n}') AS {prefix}_Q{n}" for n in range(1, 5)
    )
    return f"""
SELECT dynamic_branch_name, {columns} FROM (
  SELECT dynamic_branch_name, quarter, avg(mean_products) AS q FROM ({_MONTH_SQL})
  WHERE year(me_utc_timestamp) = {year} GROUP BY ALL) GROUP BY 1"""


_STDDEV_SQL = f"""
SELECT dynamic_branch_name, stddev_samp(mean_products) AS current_year_annual_goal
FROM ({_MONTH_SQL}) WHERE year(me_utc_timestamp) = {YEAR - 1} GROUP BY 1"""

_YEAR_END_SQL = f"""
SELECT dynamic_branch_name, count(DISTINCT customer_key) AS prior_ye_num_cust,
       count(DISTINCT account_key) AS prior_ye_num_prod_svc
FROM ({_COUNTS_SQL}) WHERE me_utc_timestamp = (
  SELECT max(me_utc_timestamp) FROM ({_COUNTS_SQL}) WHERE year(me_utc_timestamp) = {YEAR - 1})
GROUP BY 1"""


def _ladder_sql() -> str:
    """Closed form: step 1 is start, the others lie at halves of a quarter's goal."""
    q4, goal = "prior_year_Q4", "current_year_annual_goal"
    steps = []
    for quarter in range(1, 5):
        for n in range(1, 6):
            quarters = (quarter - 1) + (n - 1) / 2
            steps.append(
                f"round({q4} + {goal} / 4 * {quarters}, 6) AS current_year_q{quarter}_{n}pt_goal"
            )
    rounded = [f"round({p}_Q{n}, 6) AS {p}_Q{n}" for p in ("prior_year", "current_year")
               for n in range(1, 5)]
    return f"""
SELECT dynamic_branch_name, {', '.join(rounded)}, round({goal}, 6) AS {goal},
       prior_ye_num_cust, prior_ye_num_prod_svc, {', '.join(steps)}
FROM ({_quarter_sql(YEAR - 1, 'prior_year')})
LEFT JOIN ({_STDDEV_SQL}) USING (dynamic_branch_name)
LEFT JOIN ({_YEAR_END_SQL}) USING (dynamic_branch_name)
LEFT JOIN ({_quarter_sql(YEAR, 'current_year')}) USING (dynamic_branch_name)"""


# months in which the driver tables have orders, 1995-01 to 2001-08
_MONTHS = [(1995 + n // 12, n % 12 + 1) for n in range(80)]
_WIDE_SQL = (
    "SELECT dynamic_branch_name, "
    + ", ".join(
        f"round(max(mean_products) FILTER (year(me_utc_timestamp) = {y} AND month(me_utc_timestamp) = {m}), 6)"
        f" AS m_{y}_{m:02d}"
        for y, m in _MONTHS
    )
    + f" FROM ({_MONTH_SQL}) GROUP BY 1"
)

_TOP_SQL = f"""
SELECT k.*, dynamic_branch_assignment, is_active, is_direct
FROM (SELECT customer_key, count(DISTINCT account_key) AS num_prod_svcs
      FROM d_base JOIN customer ON c_custkey = customer_key
      WHERE product_group IN ('Deposit', 'Lending', 'Services') AND ownership_type = 'Direct'
        AND conformed_status IN ('OPEN', 'DORMANT') AND c_mktsegment <> 'BUILDING'
      GROUP BY 1) k
LEFT JOIN ({_DYNAMIC_SQL}) USING (customer_key)"""

REPORTS = [
    Report("unify_teller", unified_teller, """
SELECT '1-' || CASE l_orderkey % 8 WHEN 0 THEN 'DD' WHEN 1 THEN 'SV' WHEN 2 THEN 'LN'
         WHEN 3 THEN 'ML' WHEN 4 THEN 'BX' WHEN 5 THEN 'CD' ELSE 'IR' END || '-'
         || lpad(CAST(l_orderkey AS VARCHAR), 20, '0') AS account_key,
       CAST(l_suppkey % 10 AS INTEGER) AS branch_number,
       CAST(l_shipdate AS DATE) AS transaction_date,
       concat_ws('-', l_orderkey, l_linenumber) AS transaction_id
FROM lineitem WHERE l_linestatus = 'F' AND l_orderkey % 8 <> 7 AND l_partkey > 0
  AND l_orderkey > 0
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_suppkey % 10) = 1
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR), CAST(l_suppkey % 10 AS INTEGER), CAST(l_shipdate AS DATE),
       concat_ws('/', l_orderkey, l_linenumber)
FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag <> 'R' AND l_partkey > 0
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_suppkey % 10) = 1""", dates=("transaction_date",)),
    Report("account_branches", account_list, """
SELECT account_key, date_opened, branch_id FROM (
  SELECT l_orderkey AS account_key, CAST(l_suppkey % 10 AS INTEGER) AS branch_id,
         CASE WHEN l_linenumber < 7 THEN CAST(l_shipdate AS DATE) END AS date_opened
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_suppkey,
    l_linenumber) = 1)
WHERE branch_id > 0 AND date_opened IS NOT NULL""", dates=("date_opened",)),
    Report("direct_branch",
           lambda t: branches.direct_branch(t.teller, t.direct, AS_OF),
           _used_sql(False, "direct_branch_number")),
    Report("primary_branch",
           lambda t: branches.primary_branch(t.teller, t.direct, AS_OF),
           _used_sql(True, "primary_branch_number")),
    Report("account_branch",
           lambda t: branches.account_branch(t.accts, t.direct, AS_OF), _ACCOUNT_SQL),
    Report("dynamic_branch", assignment, _DYNAMIC_SQL, dates=("snapshot_date",)),
    Report("dynamic_branch_history", history, _HISTORY_SQL, dates=("snapshot_date",)),
    Report("ownership_runs", owned_runs, """
WITH d AS (
  SELECT DISTINCT CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 3 END AS account_key,
         user_id AS customer_key,
         CASE WHEN event_type = 'purchase' THEN 'Y' ELSE 'N' END AS primary_customer_flag, seq
  FROM events JOIN d_day_spine ON snapshot_date = CAST(ts AS DATE)),
r AS (SELECT *, seq - row_number() OVER (PARTITION BY account_key, customer_key,
        primary_customer_flag ORDER BY seq) AS run FROM d)
SELECT account_key, customer_key, primary_customer_flag, min(seq) AS own_from,
       max(seq) + 1 AS own_until
FROM r GROUP BY account_key, customer_key, primary_customer_flag, run"""),
    Report("branch_names", named, _NAMED_SQL, dates=("snapshot_date",)),
    Report("monthly_majority", majority, """
WITH b AS (
  SELECT customer_key, transaction_date AS d, min(branch_number) AS branch
  FROM d_teller JOIN d_direct USING (account_key) GROUP BY 1, 2),
k AS (SELECT customer_key, d, last_day(d) AS me_utc_timestamp, branch FROM b
      WHERE customer_key % 5 <> 0 AND branch <> 9),
o AS (SELECT DISTINCT o_custkey AS customer_key, CAST(o_orderdate AS DATE) AS d,
             o_orderpriority AS officer FROM orders),
j AS (SELECT customer_key, me_utc_timestamp, branch, officer
      FROM k LEFT JOIN o USING (customer_key, d))
SELECT customer_key, me_utc_timestamp, CAST(branch AS VARCHAR) AS dynamic_branch_name,
       officer AS dynamic_officer_assignment
FROM (SELECT customer_key, me_utc_timestamp, branch FROM j GROUP BY 1, 2, 3
      QUALIFY row_number() OVER (PARTITION BY customer_key, me_utc_timestamp
        ORDER BY count(*) DESC, branch NULLS LAST) = 1)
JOIN (SELECT customer_key, me_utc_timestamp, officer FROM j GROUP BY 1, 2, 3
      QUALIFY row_number() OVER (PARTITION BY customer_key, me_utc_timestamp
        ORDER BY count(*) DESC, officer NULLS LAST) = 1)
  USING (customer_key, me_utc_timestamp)""", dates=("me_utc_timestamp",)),
    Report("reprocess_flags", reprocessed, """
WITH b AS (
  SELECT b.*, x.snapshot_date FROM d_base b
  JOIN (SELECT DISTINCT account_key, snapshot_date FROM d_xref) x USING (account_key))
SELECT customer_key, CAST(customer_key % 25 AS INTEGER) AS dynamic_branch_assignment,
       max(CASE WHEN conformed_status IN ('OPEN', 'DORMANT') THEN 'Y' ELSE 'N' END) AS is_active,
       max(CASE WHEN conformed_status IN ('OPEN', 'DORMANT') AND ownership_type = 'Direct'
           AND product_group IN ('Deposit', 'Lending') THEN 'Y' ELSE 'N' END) AS is_direct,
       snapshot_date
FROM b GROUP BY customer_key, snapshot_date""", dates=("snapshot_date",)),
    Report("user_branch_fallback", user_branch, """
WITH tr AS (SELECT user_id, CAST(ts AS DATE) AS d, event_id % 5 AS b
            FROM events WHERE event_type = 'purchase'),
dd AS (SELECT user_id, d, b FROM tr GROUP BY 1, 2, 3
       QUALIFY row_number() OVER (PARTITION BY user_id, d ORDER BY count(*) DESC, b) = 1),
oo AS (SELECT user_id, b FROM tr GROUP BY 1, 2
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, b) = 1)
SELECT e.event_id, e.user_id, CAST(e.ts AS DATE) AS log_date,
       coalesce(dd.b, oo.b) AS user_branch_number
FROM events e LEFT JOIN dd ON dd.user_id = e.user_id AND dd.d = CAST(e.ts AS DATE)
LEFT JOIN oo ON oo.user_id = e.user_id WHERE e.event_type = 'view'""", dates=("log_date",)),
    Report("latest_assignment", latest, """
SELECT customer_key, CAST(branch_number AS VARCHAR) AS dynamic_branch_name
FROM d_teller JOIN d_direct USING (account_key)
QUALIFY row_number() OVER (PARTITION BY customer_key
  ORDER BY transaction_date DESC, branch_number) = 1"""),
    Report("product_counts", counts, _COUNTS_SQL, dates=("me_utc_timestamp",)),
    Report("ppc_quarterly", quarterly, f"""
SELECT dynamic_branch_name, {', '.join(f'round(prior_year_Q{n}, 6) AS prior_year_Q{n}'
                                       for n in range(1, 5))}
FROM ({_quarter_sql(YEAR - 1, 'prior_year')})"""),
    Report("annual_goal", lambda t: _rounded(goals.annual_goal_stddev(counts(t), YEAR - 1)), f"""
SELECT dynamic_branch_name, round(current_year_annual_goal, 6) AS current_year_annual_goal
FROM ({_STDDEV_SQL})"""),
    Report("year_end_counts", lambda t: goals.year_end_counts(counts(t), YEAR - 1), _YEAR_END_SQL),
    Report("goal_ladder", ladder, _ladder_sql()),
    Report("ppc_monthly", monthly, f"""
SELECT dynamic_branch_name, me_utc_timestamp, round(mean_products, 6) AS mean_products
FROM ({_MONTH_SQL})""", dates=("me_utc_timestamp",)),
    Report("ppc_by_month", monthly_wide, _WIDE_SQL),
    Report("top_customers", top_customers, _TOP_SQL),
    Report("top_customers_ranked", lambda t: top_customers(t, "rank"), f"""
SELECT *, row_number() OVER (ORDER BY num_prod_svcs DESC, customer_key) AS rank
FROM ({_TOP_SQL})"""),
]
