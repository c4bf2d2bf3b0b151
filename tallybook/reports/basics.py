"""Ingest, filters, joins, picks and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook import functions as fn
from tallybook import operators as op
from tallybook.reports.report import Report
from tallybook.reports.shapes import Tables, money


def normalize_dates(t: Tables):
    d = F.to_date("o_orderdate")
    iso, us = F.date_format(d, "yyyy-MM-dd 00:00:00"), F.date_format(d, "M/dd/yyyy 0:00")
    text = fn.classify(
        [
            (F.col("o_orderpriority") == "1-URGENT", iso),
            (F.col("o_orderpriority") == "2-HIGH", us),
            (F.col("o_orderpriority") == "3-MEDIUM", F.date_format(d, "yyyy-MM-dd")),
            (F.col("o_orderpriority") == "5-LOW", F.lit("bad stamp")),
        ]
    )
    return t.raw("orders").select(
        F.col("o_orderkey").alias("account_key"),
        fn.normalize_snapshot_date(text).alias("snapshot_date"),
    )


def parse_datetimes(t: Tables):
    return t.raw("events").select(
        "event_id",
        fn.parse_datetime(F.date_format("ts", "MM/dd/yyyy HH:mm:ss"), "MM/dd/yyyy HH:mm:ss")
        .alias("event_date"),
        fn.parse_datetime(F.date_format("ts", "M/d/yyyy"), "M/d/yyyy").alias("short_date"),
        fn.parse_datetime("event_type", "M/d/yyyy").alias("not_a_date"),
        fn.date_prefix(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("day_text"),
    )


def normalize_keys(t: Tables):
    padded = F.lpad(F.col("c_custkey").cast("string"), 12, "0")
    return t.raw("customer").select(
        F.col("c_custkey").alias("customer_key"),
        fn.normalize_key(padded).alias("number_key"),
        fn.normalize_key(padded, "string").alias("text_key"),
        fn.normalize_key("c_name").alias("not_a_key"),
    )


def account_keys(t: Tables):
    letter = F.substring("o_orderstatus", 1, 1)
    kind = fn.classify([(letter == "F", "D"), (letter == "O", "T")], letter)
    return t.raw("orders").select(
        "o_orderkey",
        fn.build_account_key(kind, "o_orderkey").alias("account_key"),
        fn.derive_card_pan(F.lpad(F.col("o_orderkey").cast("string"), 16, "0")).alias("pan"),
    )


def sanitize(t: Tables):
    odd = t.raw("region").select(
        F.col("r_regionkey").alias("REGION KEY"),
        F.col("r_name").alias("db/cr_flag"),
        F.length("r_name").alias("TransactionDate&Time"),
    )
    return op.sanitize_columns(odd, {"REGION KEY": "region_key"})


def recode(t: Tables):
    names = t.raw("nation").select(
        F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("value")
    )
    coded = t.raw("supplier").select(
        "s_suppkey",
        F.col("s_nationkey").cast("string").alias("branch"),
        (F.col("s_nationkey") + 20).cast("string").alias("other_branch"),
        F.when(F.col("s_acctbal") < 0, "N").otherwise("P").alias("sign"),
    )
    named = op.recode_values(coded, ["branch", "other_branch"], names)
    return op.recode_values(named, ["sign"], {"N": "negative"})


def text_columns(t: Tables):
    return t.raw("part").select(
        "p_partkey",
        fn.first_non_blank(
            [F.when(F.col("p_size") > 40, F.col("p_brand")).otherwise(""),
             F.when(F.col("p_size") > 20, F.col("p_type"))]
        ).alias("label"),
        fn.trim_suffix_when("p_name", "ring", 2).alias("clean_name"),
    )


def periods(t: Tables):
    columns = fn.period_columns(F.to_date("o_orderdate"))
    return t.raw("orders").select(
        F.col("o_orderkey").alias("account_key"), *[c.alias(n) for n, c in columns.items()]
    )


def union_feeds(t: Tables):
    a = t.raw("customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name"),
        money("c_acctbal").alias("balance"),
    )
    b = t.raw("supplier").select(
        F.col("s_name").alias("party_name"), F.col("s_suppkey").alias("party_key")
    )
    c = t.raw("part").select("p_partkey", "p_name", money("p_retailprice"))
    return op.union_feeds(op.union_feeds(a, b, "name"), c, "position")


def filters(t: Tables):
    size = fn.classify(
        [(F.col("l_quantity") < 10, "small"), (F.col("l_quantity") < 30, "medium")], "large"
    )
    return (
        t.raw("lineitem")
        .where(fn.date_window(F.to_date("l_shipdate"), "1999-06-30", 365))
        .where(F.col("l_returnflag").isin("A", "R") & ~F.col("l_linenumber").isin(7))
        .select(
            F.col("l_orderkey").alias("account_key"),
            "l_linenumber",
            size.alias("size_class"),
            money("l_extendedprice").alias("amount"),
            F.lit(1).alias("transaction_count"),
        )
    )


def text_filters(t: Tables):
    name = F.col("p_name")
    return t.raw("part").where(
        (fn.contains_any(name, ["ANVIL", "Gear"]) & ~fn.contains_any(name, ["old g"], True))
        | fn.starts_with_any(name, ["hot "])
        | F.lower("p_brand").like("brand#1_")
    ).select("p_partkey", "p_name", "p_brand")


def inner_join(t: Tables):
    parts = t.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    suppliers = t.raw("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return (
        t.raw("lineitem").join(parts, "l_partkey").join(suppliers, "l_suppkey")
        .groupBy("p_brand", "s_nationkey")
        .agg(F.count(F.lit(1)).alias("line_count"), F.sum(money("l_extendedprice")).alias("amount"))
    )


def left_join(t: Tables):
    lines = t.raw("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("line_count")
    )
    return t.raw("orders").join(lines, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("account_key"), "line_count"
    )


def anti_join(t: Tables):
    shipped = t.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.raw("orders").join(shipped, "o_orderkey", "left_anti").select(
        F.col("o_orderkey").alias("account_key"), "o_orderstatus"
    )


def membership(t: Tables):
    year = F.year("o_orderdate")
    orders = t.raw("orders").select(F.col("o_custkey").alias("customer_key"), year.alias("year"))
    # every year against the year before it
    known, new = op.split_by_membership(
        orders, orders.withColumn("year", F.col("year") + 1), ["customer_key", "year"]
    )
    return (
        known.withColumn("side", F.lit("existing"))
        .unionByName(new.withColumn("side", F.lit("new")))
        .groupBy("side", "year", "customer_key").agg(F.count(F.lit(1)).alias("account_count"))
    )


def trailing(t: Tables):
    spine = t.month_spine
    daily = t.teller.groupBy("branch_number", "transaction_date").agg(
        F.count(F.lit(1)).alias("n")
    )
    placed = op.range_join_trailing(daily, spine, "transaction_date", 365)
    spread = placed.groupBy("branch_number", "seq_from", "seq_until").agg(F.sum("n").alias("n"))
    spread = spread.withColumn(
        "seq", F.explode(F.sequence(F.col("seq_from"), F.col("seq_until") - 1))
    )
    return (
        spread.groupBy("branch_number", "seq").agg(F.sum("n").alias("transaction_count"))
        .join(spine, "seq").select("branch_number", "snapshot_date", "transaction_count")
    )


def _purchases(t: Tables):
    return t.raw("events").where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.to_date("ts").alias("purchase_date")
    )


def _clicks(t: Tables):
    return t.raw("events").where(F.col("event_type") == "click").select(
        "user_id", F.to_date("ts").alias("click_date"), F.col("event_id").alias("click_id")
    )


def asof(direction: str):
    def build(t: Tables):
        return op.asof_join(
            _purchases(t), _clicks(t), ["user_id"], "purchase_date", "click_date",
            ["click_id"], direction,
        )
    return build


def _hot_user():
    """The user, but one key for all users of a third of the rows."""
    return F.when(F.pmod("user_id", F.lit(3)) == 0, -1).otherwise(F.col("user_id")).alias("user_key")


def asof_times(direction: str):
    def build(t: Tables):
        events = t.raw("events")
        asked = events.where(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("purchase_id"), _hot_user(), F.col("ts").alias("purchase_ts")
        )
        marks = events.where(F.col("event_type") == "click").select(
            _hot_user(), F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id")
        )
        found = op.asof_join(
            asked, marks, ["user_key"], "purchase_ts", "click_ts", ["click_id"], direction
        )
        return found.select("purchase_id", "user_key", "click_id")
    return build


_ASOF_TIMES_SQL = """
WITH e AS (SELECT *, CASE WHEN user_id % 3 = 0 THEN -1 ELSE user_id END AS user_key FROM events),
p AS (SELECT event_id AS purchase_id, user_key, ts AS purchase_ts FROM e WHERE event_type = 'purchase'),
c AS (SELECT user_key, ts AS click_ts, min(event_id) AS click_id FROM e
      WHERE event_type = 'click' GROUP BY 1, 2)
SELECT p.purchase_id, p.user_key, c.click_id
FROM p ASOF LEFT JOIN c ON p.user_key = c.user_key AND p.purchase_ts {op} c.click_ts"""

_ASOF_SQL = """
WITH p AS (SELECT event_id AS purchase_id, user_id, CAST(ts AS DATE) AS purchase_date
           FROM events WHERE event_type = 'purchase'),
c AS (SELECT user_id, CAST(ts AS DATE) AS click_date, event_id AS click_id
      FROM events WHERE event_type = 'click')
SELECT p.purchase_id, p.user_id, p.purchase_date, c.click_date, c.click_id
FROM p LEFT JOIN c ON p.user_id = c.user_id AND c.click_date {op} p.purchase_date
QUALIFY row_number() OVER (PARTITION BY p.purchase_id ORDER BY c.click_date {dir}, c.click_id) = 1
"""

LINE_TIES = ["l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_quantity"]


def _line(df):
    return df.select(
        F.col("l_orderkey").alias("account_key"), "l_linenumber", "l_suppkey", "l_partkey",
        F.to_date("l_shipdate").alias("ship_date"),
    )


def _line_sql(direction: str) -> str:
    return f"""
SELECT l_orderkey AS account_key, l_linenumber, l_suppkey, l_partkey,
       CAST(l_shipdate AS DATE) AS ship_date
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate {direction},
  l_linenumber, l_suppkey, l_partkey, l_extendedprice, l_quantity) = 1"""


def modes(t: Tables):
    return op.mode_per_key(
        t.raw("lineitem").select(
            F.col("l_suppkey").alias("org_key"), F.pmod("l_partkey", F.lit(25)).alias("product")
        ),
        ["org_key"], "product", "uses",
    )


def stats(t: Tables):
    return t.raw("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(money("l_extendedprice")).alias("amount"),
        F.min("l_quantity").alias("min_quantity"),
        F.max("l_quantity").alias("max_quantity"),
        F.round(F.avg("l_quantity"), 6).alias("avg_quantity"),
        F.round(F.stddev_samp("l_quantity"), 6).alias("stddev_quantity"),
    )


def nested(t: Tables):
    monthly = op.distinct_counts(
        t.raw("orders").select(
            F.pmod("o_custkey", F.lit(25)).alias("branch"), "o_custkey", "o_orderkey",
            F.last_day("o_orderdate").alias("month_end"), F.year("o_orderdate").alias("year"),
        ),
        ["branch", "o_custkey", "month_end", "year"], {"accounts": "o_orderkey"},
    )
    mean = op.nested_mean(
        monthly, [["branch", "month_end", "year"], ["branch", "year"]], "accounts", "mean_accounts"
    )
    return mean.withColumn("mean_accounts", F.round("mean_accounts", 6))


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

REPORTS = [
    Report("normalize_dates", normalize_dates, """
SELECT o_orderkey AS account_key,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
         THEN CAST(o_orderdate AS DATE) END AS snapshot_date
FROM orders""", dates=("snapshot_date",)),
    Report("parse_datetimes", parse_datetimes, """
SELECT event_id, CAST(ts AS DATE) AS event_date, CAST(ts AS DATE) AS short_date,
       CAST(NULL AS DATE) AS not_a_date, strftime(ts, '%Y-%m-%d') AS day_text
FROM events""", dates=("event_date", "short_date", "not_a_date")),
    Report("normalize_keys", normalize_keys, """
SELECT c_custkey AS customer_key, c_custkey AS number_key,
       CASE WHEN c_custkey = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS text_key,
       CAST(NULL AS BIGINT) AS not_a_key
FROM customer"""),
    Report("account_keys", account_keys, """
SELECT o_orderkey,
       '1-' || CASE o_orderstatus WHEN 'F' THEN 'DD' WHEN 'O' THEN 'CD' ELSE 'ERROR' END || '-'
         || lpad(CAST(o_orderkey AS VARCHAR), 20, '0') AS account_key,
       CASE WHEN o_orderkey = 0 THEN '' ELSE
         left(CAST(o_orderkey AS VARCHAR), length(CAST(o_orderkey AS VARCHAR)) - 1) END AS pan
FROM orders"""),
    Report("sanitize_columns", sanitize, """
SELECT r_regionkey AS region_key, r_name AS db_cr_flag,
       CAST(length(r_name) AS INTEGER) AS TransactionDate_Time
FROM region"""),
    Report("processing_dates", lambda t: op.processing_dates(t.presence), """
SELECT * FROM d_day_spine""", dates=("snapshot_date", "prior_date", "next_date")),
    Report("latest_two_dates",
           lambda t: op.latest_two_dates(op.processing_dates(t.presence), "2024-01-30"), """
SELECT snapshot_date AS latest_date, prior_date FROM d_day_spine
WHERE next_date IS NULL AND snapshot_date = DATE '2024-01-30'""",
           dates=("latest_date", "prior_date")),
    Report("recode_values", recode, """
SELECT s_suppkey, coalesce(n1.n_name, CAST(s_nationkey AS VARCHAR)) AS branch,
       coalesce(n2.n_name, CAST(s_nationkey + 20 AS VARCHAR)) AS other_branch,
       CASE WHEN s_acctbal < 0 THEN 'negative' ELSE 'P' END AS sign
FROM supplier LEFT JOIN nation n1 ON s_nationkey = n1.n_nationkey
LEFT JOIN nation n2 ON s_nationkey + 20 = n2.n_nationkey"""),
    Report("text_columns", text_columns, """
SELECT p_partkey,
       CASE WHEN p_size > 40 THEN p_brand WHEN p_size > 20 THEN p_type ELSE 'ERROR' END AS label,
       CASE WHEN contains(p_name, 'ring') THEN left(p_name, length(p_name) - 2) ELSE p_name END
         AS clean_name
FROM part"""),
    Report("period_columns", periods, """
SELECT o_orderkey AS account_key, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month,
       strftime(o_orderdate, '%Y-%m-01') AS month_start,
       last_day(CAST(o_orderdate AS DATE)) AS month_end,
       year(o_orderdate) || '_' || quarter(o_orderdate) AS quarter,
       last_day(CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE)) AS prior_month_end
FROM orders""", dates=("month_end", "prior_month_end")),
    Report("union_feeds", union_feeds, """
SELECT c_custkey AS party_key, c_name AS party_name, CAST(c_acctbal AS DECIMAL(18,2)) AS balance
FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier
UNION ALL SELECT p_partkey, p_name, CAST(p_retailprice AS DECIMAL(18,2)) FROM part""",
           money=("balance",)),
    Report("filter_rows", filters, """
SELECT l_orderkey AS account_key, l_linenumber,
       CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END
         AS size_class,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, 1 AS transaction_count
FROM lineitem
WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1999-06-30' - 365 AND DATE '1999-06-30'
  AND l_returnflag IN ('A', 'R') AND l_linenumber <> 7""", money=("amount",)),
    Report("text_filters", text_filters, """
SELECT p_partkey, p_name, p_brand FROM part
WHERE ((p_name LIKE '%anvil%' OR p_name LIKE '%gear%') AND p_name NOT LIKE '%old g%')
   OR p_name LIKE 'hot %' OR lower(p_brand) LIKE 'brand#1_'"""),
    Report("inner_join", inner_join, """
SELECT p_brand, s_nationkey, count(*) AS line_count,
       sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
GROUP BY p_brand, s_nationkey""", money=("amount",)),
    Report("left_join", left_join, """
SELECT o_orderkey AS account_key, line_count
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS line_count FROM lineitem GROUP BY 1)
  ON o_orderkey = l_orderkey"""),
    Report("anti_join", anti_join, """
SELECT o_orderkey AS account_key, o_orderstatus FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""),
    Report("split_by_membership", membership, """
WITH y AS (SELECT o_custkey AS customer_key, CAST(year(o_orderdate) AS INTEGER) AS year,
                  count(*) AS account_count FROM orders GROUP BY 1, 2)
SELECT CASE WHEN p.year IS NULL THEN 'new' ELSE 'existing' END AS side, y.*
FROM y LEFT JOIN y p ON p.customer_key = y.customer_key AND p.year = y.year - 1"""),
    Report("trailing_window_counts", trailing, """
SELECT branch_number, snapshot_date, count(*) AS transaction_count
FROM d_teller JOIN d_month_spine
  ON transaction_date BETWEEN snapshot_date - 365 AND snapshot_date
GROUP BY branch_number, snapshot_date""", dates=("snapshot_date",)),
    Report("asof_backward", asof("backward"), _ASOF_SQL.format(op="<=", dir="DESC NULLS LAST"),
           dates=("purchase_date", "click_date")),
    Report("asof_forward", asof("forward"), _ASOF_SQL.format(op=">=", dir="ASC NULLS LAST"),
           dates=("purchase_date", "click_date")),
    Report("asof_times_backward", asof_times("backward"), _ASOF_TIMES_SQL.format(op=">=")),
    Report("asof_times_forward", asof_times("forward"), _ASOF_TIMES_SQL.format(op="<=")),
    Report("latest_per_key",
           lambda t: _line(op.latest_per_key(t.raw("lineitem"), ["l_orderkey"], "l_shipdate",
                                             LINE_TIES)),
           _line_sql("DESC"), dates=("ship_date",)),
    Report("earliest_per_key",
           lambda t: _line(op.earliest_per_key(t.raw("lineitem"), ["l_orderkey"], "l_shipdate",
                                               LINE_TIES)),
           _line_sql("ASC"), dates=("ship_date",)),
    Report("distinct_rows",
           lambda t: t.raw("lineitem").select("l_suppkey", "l_returnflag", "l_linestatus",
                                              "l_linenumber").distinct(),
           "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_linenumber FROM lineitem"),
    Report("mode_per_key", modes, """
SELECT l_suppkey AS org_key, l_partkey % 25 AS product, count(*) AS uses
FROM lineitem GROUP BY 1, 2
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_partkey % 25) = 1"""),
    Report("top_k",
           lambda t: op.top_k(
               t.raw("orders").groupBy(F.col("o_custkey").alias("customer_key")).agg(
                   F.sum(money("o_totalprice")).alias("total")),
               "total", 100, ["customer_key"]), """
SELECT o_custkey AS customer_key, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100""", money=("total",)),
    Report("grouped_stats", stats, """
SELECT l_returnflag, l_linestatus, count(*) AS line_count,
       sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount,
       min(l_quantity) AS min_quantity, max(l_quantity) AS max_quantity,
       round(avg(l_quantity), 6) AS avg_quantity,
       round(stddev_samp(l_quantity), 6) AS stddev_quantity
FROM lineitem GROUP BY 1, 2""", money=("amount",)),
    Report("distinct_counts",
           lambda t: op.distinct_counts(
               t.raw("lineitem"), ["l_suppkey"],
               {"num_parts": "l_partkey", "num_accounts": "l_orderkey"}), """
SELECT l_suppkey, count(DISTINCT l_partkey) AS num_parts,
       count(DISTINCT l_orderkey) AS num_accounts
FROM lineitem GROUP BY 1"""),
    Report("global_aggregate",
           lambda t: t.raw("orders").agg(
               F.sum(money("o_totalprice")).alias("total"),
               F.max(F.to_date("o_orderdate")).alias("last_day"),
               F.count(F.lit(1)).alias("row_count")), """
SELECT sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total,
       CAST(max(o_orderdate) AS DATE) AS last_day, count(*) AS row_count
FROM orders""", dates=("last_day",), money=("total",)),
    Report("sum_numeric",
           lambda t: op.sum_numeric(
               t.raw("lineitem").select(
                   "l_returnflag", "l_linestatus", "l_linenumber", money("l_tax").alias("tax"),
                   F.col("l_quantity").cast("bigint").alias("quantity")),
               ["l_returnflag"]), """
SELECT l_returnflag, CAST(sum(l_linenumber) AS BIGINT) AS sum_l_linenumber,
       sum(CAST(l_tax AS DECIMAL(18,2))) AS sum_tax,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_quantity
FROM lineitem GROUP BY 1""", money=("sum_tax",)),
    Report("pivot_agg",
           lambda t: op.pivot_agg(t.raw("events"), ["user_id"], "event_type", EVENT_TYPES,
                                  F.count(F.lit(1))),
           "SELECT user_id, " + ", ".join(
               f"nullif(count(*) FILTER (event_type = '{e}'), 0) AS \"{e}\"" for e in EVENT_TYPES)
           + " FROM events GROUP BY user_id"),
    Report("nested_mean", nested, """
SELECT branch, year, round(avg(m), 6) AS mean_accounts FROM (
  SELECT branch, month_end, year, avg(n) AS m FROM (
    SELECT o_custkey % 25 AS branch, o_custkey, last_day(CAST(o_orderdate AS DATE)) AS month_end,
           CAST(year(o_orderdate) AS INTEGER) AS year, count(DISTINCT o_orderkey) AS n
    FROM orders GROUP BY ALL) GROUP BY ALL) GROUP BY ALL"""),
    Report("frequency_profile", lambda t: op.frequency_profile(t.raw("part"), "p_name"),
           "SELECT p_name, count(*) AS row_count FROM part GROUP BY 1"),
    Report("frequency_ranked", lambda t: op.frequency_profile(t.raw("part"), "p_name", "rank"), """
SELECT p_name, count(*) AS row_count, row_number() OVER (ORDER BY count(*) DESC, p_name) AS rank
FROM part GROUP BY 1"""),
    Report("orders_ranked",
           lambda t: op.ranked(
               t.raw("orders").select("o_orderkey", money("o_totalprice").alias("total")),
               [F.desc("total"), F.asc("o_orderkey")], "rank"), """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
       row_number() OVER (ORDER BY CAST(o_totalprice AS DECIMAL(18,2)) DESC, o_orderkey) AS rank
FROM orders""", money=("total",)),
]
