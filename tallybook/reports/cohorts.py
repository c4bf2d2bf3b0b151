"""Balances of new and lost customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.plans import cohorts
from tallybook.reports.report import Report
from tallybook.reports.shapes import Tables


def _flags(t: Tables):
    """First and last account opening of each customer, as joining and leaving."""
    orders = t.raw("orders").select(
        F.col("o_custkey").alias("customer_key"), F.to_date("o_orderdate").alias("day")
    )
    ends = orders.groupBy("customer_key").agg(F.min("day").alias("f"), F.max("day").alias("l"))
    yes, no = F.lit(1), F.lit(None).cast("int")
    return ends.select(
        "customer_key",
        F.inline(
            F.array(
                F.struct(
                    F.col("f").alias("snapshot_date"),
                    yes.alias("new_customer_flag"),
                    no.alias("lost_customer_flag"),
                ),
                F.struct(
                    F.col("l").alias("snapshot_date"),
                    no.alias("new_customer_flag"),
                    yes.alias("lost_customer_flag"),
                ),
            )
        ),
    )


def _balances(t: Tables):
    return t.accounts.select(
        "account_key",
        "snapshot_date",
        F.col("opening_amount").alias("average_collected_balance_mtd"),
        (F.col("opening_amount") * 3).cast("decimal(18,2)").alias(
            "average_collected_balance_last_12_months"
        ),
    )


def resolved(months: int, month_end: bool):
    def build(t: Tables):
        return cohorts.resolve_snapshot(
            t.raw("orders").select(F.to_date("o_orderdate").alias("snapshot_date")),
            t.month_spine, months, month_end,
        )
    return build


def new_dollars(t: Tables):
    return cohorts.new_customer_dollars(_flags(t), t.xref, _balances(t), t.month_spine)


def lost_dollars(t: Tables):
    return cohorts.lost_customer_dollars(_flags(t), t.xref, _balances(t), t.month_spine)


def month_dollars(t: Tables):
    """The spine holds both the cohort days and the month-end files."""
    flags = _flags(t).withColumn(
        "snapshot_date", F.date_sub(F.last_day("snapshot_date"), 1)
    )
    return cohorts.new_dollars_for_month(
        flags, t.xref, _balances(t), t.month_spine, "1995-05-15"
    )


_TARGET = {
    "forward": "last_day(CAST(d + INTERVAL 2 MONTH AS DATE))",
    "backward": "CAST(d - INTERVAL 2 MONTH AS DATE)",
}


def _resolved_sql(direction: str) -> str:
    return f"""
SELECT d AS snapshot_date, target_date, resolved_date,
       (SELECT max(snapshot_date) FROM d_month_spine) >= target_date AS is_complete
FROM (SELECT d, {_TARGET[direction]} AS target_date,
        (SELECT max(snapshot_date) FROM d_month_spine
         WHERE snapshot_date <= {_TARGET[direction]}) AS resolved_date
      FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders))
WHERE resolved_date IS NOT NULL"""


def _dollars_sql(end: str, direction: str, amount: str, name: str) -> str:
    return f"""
WITH f AS (SELECT o_custkey AS customer_key, CAST({end}(o_orderdate) AS DATE) AS d
           FROM orders GROUP BY 1),
r AS ({_resolved_sql(direction)})
SELECT f.d AS snapshot_date, sum({amount}) AS {name}
FROM f JOIN r ON r.snapshot_date = f.d
LEFT JOIN (SELECT * FROM d_xref WHERE primary_customer_flag = 'Y') x
  ON x.customer_key = f.customer_key AND x.snapshot_date = r.resolved_date
LEFT JOIN d_accounts a ON a.account_key = x.account_key AND a.snapshot_date = r.resolved_date
GROUP BY 1"""


REPORTS = [
    Report("resolve_snapshot_forward", resolved(2, True), _resolved_sql("forward"),
           dates=("snapshot_date", "target_date", "resolved_date")),
    Report("resolve_snapshot_backward", resolved(-2, False), _resolved_sql("backward"),
           dates=("snapshot_date", "target_date", "resolved_date")),
    Report("new_customer_dollars", new_dollars,
           _dollars_sql("min", "forward", "opening_amount", "deposit_dollars_new"),
           dates=("snapshot_date",), money=("deposit_dollars_new",)),
    Report("lost_customer_dollars", lost_dollars,
           _dollars_sql("max", "backward", "opening_amount * 3", "deposit_dollars_lost"),
           dates=("snapshot_date",), money=("deposit_dollars_lost",)),
    Report("new_dollars_for_month", month_dollars, """
WITH f AS (
  SELECT o_custkey AS customer_key,
         CAST(last_day(CAST(min(o_orderdate) AS DATE)) - INTERVAL 1 DAY AS DATE) AS d
  FROM orders GROUP BY 1),
n AS (SELECT max(snapshot_date) AS due FROM d_month_spine WHERE snapshot_date <= DATE '1995-04-30')
SELECT f.d AS snapshot_date, sum(opening_amount) AS deposit_dollars_new
FROM f JOIN n ON last_day(f.d) = last_day(CAST(due - INTERVAL 2 MONTH AS DATE))
LEFT JOIN (SELECT * FROM d_xref WHERE primary_customer_flag = 'Y') x
  ON x.customer_key = f.customer_key AND x.snapshot_date = due
LEFT JOIN d_accounts a ON a.account_key = x.account_key AND a.snapshot_date = due
GROUP BY 1""", dates=("snapshot_date",), money=("deposit_dollars_new",)),
]
