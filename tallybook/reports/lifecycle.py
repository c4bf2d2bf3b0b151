"""Customers gained and lost, and their ledger."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.operators import processing_dates, rows_per_snapshot, upsert
from tallybook.plans import lifecycle
from tallybook.reports.accounts import conformed
from tallybook.reports.report import Report
from tallybook.reports.shapes import Tables
from tallybook.sources.keyed import GROUP, merge_keyed, write_keyed_table

MIN_RETURN_DAYS, FRAUD_DAYS = 2, 1


def _spine(t: Tables):
    return processing_dates(t.presence)


def _events(t: Tables):
    return lifecycle.snapshot_diff(t.presence, _spine(t))


def _seed(t: Tables):
    return lifecycle.seed_ledger(t.masters)


def eligible(t: Tables):
    base = (
        t.xref.join(
            t.product_groups.withColumnRenamed("application_code", "application"),
            "application", "left",
        )
        .join(t.ownership, "relationship_key", "left")
        .join(conformed(t).select("account_key", "conformed_status"), "account_key", "left")
    )
    return lifecycle.eligible_customers(base)


def seed(t: Tables):
    return _seed(t)


def ledger(t: Tables):
    return lifecycle.acquisition_ledger(_seed(t), _events(t))


def history(t: Tables):
    return lifecycle.ledger_history(_seed(t), _events(t), _spine(t))


def incremental(t: Tables):
    """Ledger at 20 January, then brought up to date with the days after it."""
    spine = _spine(t)
    early = t.presence.where(F.col("snapshot_date") <= F.lit("2024-01-20").cast("date"))
    first = lifecycle.acquisition_ledger(
        _seed(t), lifecycle.snapshot_diff(early, processing_dates(early))
    )
    return lifecycle.ledger_incremental(first, t.presence, spine, "2024-01-20")


def incremental_keyed(t: Tables):
    """Ledger at 20 January in a keyed table, into which the changes of the days after are merged."""
    early = t.presence.where(F.col("snapshot_date") <= F.lit("2024-01-20").cast("date"))
    first = lifecycle.acquisition_ledger(
        _seed(t), lifecycle.snapshot_diff(early, processing_dates(early))
    )
    name = f"ledger_{uuid.uuid4().hex}"
    write_keyed_table(first, name, ["customer_key"], groups=16, buckets=4)
    changes = lifecycle.ledger_changes(t.spark, name, t.presence, _spine(t), "2024-01-20")
    merge_keyed(t.spark, name, changes)
    return t.spark.read.table(name).drop(GROUP)


def merged(t: Tables, merge=upsert):
    """Totals of every year merged with those of the next on the customer, in all four shapes."""
    totals = t.raw("orders").groupBy(
        F.col("o_custkey").alias("customer_key"), F.year("o_orderdate").alias("year")
    ).agg(
        F.count(F.lit(1)).alias("account_count"),
        F.max(F.to_date("o_orderdate")).alias("last_opened"),
    )
    following = totals.withColumn("year", F.col("year") - 1)
    keys = ["customer_key", "year"]
    shapes = {
        "update some, insert": {"update": ["last_opened"]},
        "update only": {"insert": []},
        "insert only": {"update": []},
        "update, insert": {},
    }
    parts = [
        merge(totals, following, keys, **kind).withColumn("shape", F.lit(name))
        for name, kind in shapes.items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def _keyed_merge(target: DataFrame, source: DataFrame, keys, **kind) -> DataFrame:
    """The same merge, done to a keyed table of the target."""
    spark, name = target.sparkSession, f"totals_{uuid.uuid4().hex}"
    write_keyed_table(target, name, keys, groups=8, buckets=2)
    merge_keyed(spark, name, source, **kind)
    return spark.read.table(name).drop(GROUP)


def flags(t: Tables):
    spine = _spine(t)
    runs = lifecycle.ledger_runs(_seed(t), _events(t), spine)
    return lifecycle.customer_status_flags(runs, spine, MIN_RETURN_DAYS, FRAUD_DAYS)


def flags_with_branch(t: Tables):
    named = t.presence.distinct().select(
        "customer_key", "snapshot_date",
        F.pmod("customer_key", F.lit(25)).cast("string").alias("dynamic_branch_id"),
    ).withColumn("dynamic_branch_name", F.concat(F.lit("Branch "), "dynamic_branch_id"))
    return lifecycle.with_branch(flags(t), named)


def reconcile(t: Tables):
    columns = lifecycle.LEDGER_COLUMNS[1:]
    early = t.presence.where(F.col("snapshot_date") <= F.lit("2024-01-20").cast("date"))
    first = lifecycle.acquisition_ledger(
        _seed(t), lifecycle.snapshot_diff(early, processing_dates(early))
    )
    return lifecycle.reconcile(first, ledger(t), "customer_key", columns[1:])


def misdated(t: Tables):
    rows = t.raw("lineitem").select(
        F.col("l_returnflag").alias("feed"),
        F.to_date("l_shipdate").alias("snapshot_date"),
        F.last_day("l_shipdate").alias("expected_date"),
    )
    return lifecycle.misdated_rows(rows, "expected_date")


_LAST = "SELECT * EXCLUDE (snapshot_date) FROM d_ledger_history WHERE snapshot_date = {}"
_FINAL = _LAST.format("(SELECT max(snapshot_date) FROM d_day_spine)")
_LEDGER_DATES = (
    "original_acquisition_date", "most_recent_acquisition_date", "most_recent_lost_date",
)

_FLAGS_SQL = f"""
WITH c AS (
  SELECT *, coalesce(most_recent_acquisition_date, original_acquisition_date) AS recent,
         coalesce(most_recent_acquisition_date, original_acquisition_date)
           - most_recent_lost_date AS away
  FROM d_ledger_history),
k AS (SELECT c.*, s.prior_date FROM c JOIN d_day_spine s USING (snapshot_date)
      WHERE away IS NULL OR NOT (away >= 0 AND away < {FRAUD_DAYS}))
SELECT snapshot_date, customer_key, 1 AS new_customer_flag,
       CAST(NULL AS INTEGER) AS returning_customer_flag,
       CAST(NULL AS INTEGER) AS lost_customer_flag,
       CAST(NULL AS INTEGER) AS relost_customer_flag,
       CAST(NULL AS DATE) AS most_recent_acquisition_date
FROM k WHERE original_acquisition_date = snapshot_date
UNION ALL
SELECT snapshot_date, customer_key, NULL, 1, NULL, NULL, NULL
FROM k WHERE recent = snapshot_date AND recent <> original_acquisition_date
  AND away > {MIN_RETURN_DAYS}
UNION ALL
SELECT snapshot_date, customer_key, NULL, NULL,
       CASE WHEN recent = original_acquisition_date THEN 1 END,
       CASE WHEN recent <> original_acquisition_date THEN 1 END, recent
FROM k WHERE most_recent_lost_date = prior_date"""

_UPSERT_SQL = """
WITH t AS (SELECT o_custkey AS customer_key, CAST(year(o_orderdate) AS INTEGER) AS year,
                  count(*) AS n, CAST(max(o_orderdate) AS DATE) AS d FROM orders GROUP BY 1, 2),
s AS (SELECT customer_key, CAST(year - 1 AS INTEGER) AS year, n, d FROM t)
SELECT customer_key, year, coalesce(t.n, s.n) AS account_count, coalesce(s.d, t.d) AS last_opened,
       'update some, insert' AS shape
FROM t FULL JOIN s USING (customer_key, year)
UNION ALL
SELECT customer_key, year, coalesce(s.n, t.n), coalesce(s.d, t.d), 'update only'
FROM t LEFT JOIN s USING (customer_key, year)
UNION ALL
SELECT customer_key, year, coalesce(t.n, s.n), coalesce(t.d, s.d), 'insert only'
FROM t FULL JOIN s USING (customer_key, year)
UNION ALL
SELECT customer_key, year, coalesce(s.n, t.n), coalesce(s.d, t.d), 'update, insert'
FROM t FULL JOIN s USING (customer_key, year)"""

REPORTS = [
    Report("eligible_customers", eligible, """
SELECT DISTINCT b.customer_key, x.snapshot_date
FROM d_base b JOIN (SELECT DISTINCT account_key, snapshot_date FROM d_xref) x USING (account_key)
WHERE ownership_type = 'Direct' AND product_group <> 'Services'
  AND conformed_status IN ('OPEN', 'DORMANT')""", dates=("snapshot_date",)),
    Report("snapshot_diff", _events, "SELECT * FROM d_changes",
           dates=("processing_date", "acquired_on", "lost_on")),
    Report("seed_ledger", seed, """
SELECT *, CAST(NULL AS DATE) AS most_recent_acquisition_date,
       CAST(NULL AS DATE) AS most_recent_lost_date FROM d_seed""", dates=_LEDGER_DATES),
    Report("acquisition_ledger", ledger, _FINAL, dates=_LEDGER_DATES),
    Report("ledger_history", history, "SELECT * FROM d_ledger_history",
           dates=(*_LEDGER_DATES, "snapshot_date")),
    Report("ledger_incremental", incremental, _FINAL, dates=_LEDGER_DATES),
    Report("ledger_keyed", incremental_keyed, _FINAL, dates=_LEDGER_DATES),
    Report("upsert", merged, _UPSERT_SQL, dates=("last_opened",)),
    Report("upsert_keyed", lambda t: merged(t, _keyed_merge), _UPSERT_SQL, dates=("last_opened",)),
    Report("status_flags", flags, _FLAGS_SQL,
           dates=("snapshot_date", "most_recent_acquisition_date")),
    Report("status_flags_branch", flags_with_branch, f"""
SELECT f.*, b.dynamic_branch_id,
       'Branch ' || b.dynamic_branch_id AS dynamic_branch_name
FROM ({_FLAGS_SQL}) f
LEFT JOIN (SELECT customer_key, snapshot_date,
                  CAST(customer_key % 25 AS VARCHAR) AS dynamic_branch_id FROM d_presence) b
  USING (customer_key, snapshot_date)""",
           dates=("snapshot_date", "most_recent_acquisition_date")),
    Report("reconcile", reconcile, f"""
WITH a AS ({_LAST.format("DATE '2024-01-20'")}), b AS ({_FINAL})
SELECT customer_key, a.most_recent_acquisition_date AS most_recent_acquisition_date_a,
       a.most_recent_lost_date AS most_recent_lost_date_a,
       a.customer_key IS NOT NULL AS in_a,
       b.most_recent_acquisition_date AS most_recent_acquisition_date_b,
       b.most_recent_lost_date AS most_recent_lost_date_b,
       b.customer_key IS NOT NULL AS in_b
FROM a FULL JOIN b USING (customer_key)
WHERE a.customer_key IS NULL OR b.customer_key IS NULL
   OR a.most_recent_acquisition_date IS DISTINCT FROM b.most_recent_acquisition_date
   OR a.most_recent_lost_date IS DISTINCT FROM b.most_recent_lost_date""",
           dates=("most_recent_acquisition_date_a", "most_recent_lost_date_a",
                  "most_recent_acquisition_date_b", "most_recent_lost_date_b")),
    Report("rows_per_snapshot", lambda t: rows_per_snapshot(t.presence.distinct()), """
SELECT snapshot_date, count(*) AS row_count,
       coalesce(count(*) >= lag(count(*)) OVER (ORDER BY snapshot_date), TRUE) AS grew
FROM d_presence GROUP BY 1""", dates=("snapshot_date",)),
    Report("misdated_rows", misdated, """
SELECT l_returnflag AS feed, count(*) AS row_count,
       count(*) FILTER (CAST(l_shipdate AS DATE) <> last_day(CAST(l_shipdate AS DATE)))
         AS misdated_count
FROM lineitem GROUP BY 1"""),
]
