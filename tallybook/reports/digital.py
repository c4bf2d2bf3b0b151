"""Digital usage, audit logs and a round trip through the sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallybook.plans import digital
from tallybook.reports.report import Report
from tallybook.reports.shapes import Tables
from tallybook.session import shared_dir
from tallybook.sources import (
    copy_tables,
    export_csv,
    read_csv,
    read_snapshots,
    replace_table,
    snapshot_spine,
    write_snapshot,
    write_table,
)

METHODS = [f"{d} - {c}" for d in ("PHONE", "TABLET", "DESKTOP") for c in
           ("Browser", "Mobile", "App")]
LARGE_TRANSFER = 150


def logins(t: Tables):
    users = t.raw("customer").select(
        F.when(F.col("c_mktsegment") != "MACHINERY", F.pmod("c_custkey", F.lit(1000))).alias(
            "individual_id"
        ),
        F.concat(F.lit("U"), "c_custkey").alias("user_id"),
        F.col("c_nationkey").alias("enrolled_at"),
    )
    return digital.login_pivot(t.digital, users, METHODS, "2024-01-30", 20)


def without_event(t: Tables):
    large = (F.col("transaction_type") == "Transfer") & (F.col("amount") >= LARGE_TRANSFER)
    return digital.users_without_event(t.digital, large)


def unrecovered(t: Tables):
    kind, result = F.col("transaction_type"), F.col("result")
    people = t.raw("customer").select(
        F.concat(F.lit("U"), "c_custkey").alias("user_id"), "c_mktsegment"
    )
    return digital.unrecovered_failures(
        t.digital,
        (kind == "Get RDC Configuration") & (result == "FAILURE"),
        (kind == "Remote Deposit Capture") & (result == "SUCCESS"),
        people,
    )


def transfers(t: Tables, rank: str | None = None):
    feed = t.digital.where(F.col("transaction_type") == "Transfer").select(
        F.col("event_id").alias("transfer_id"),
        F.col("transaction_date").alias("transfer_date"),
        F.last_day("transaction_date").alias("snapshot_date"),
        "amount",
    )
    return digital.transfers_since(feed, "2024-01-15", rank)


def _teller(t: Tables):
    """Branch use of employees; only every other employee works a till."""
    return t.raw("lineitem").select(
        (F.col("l_partkey") * 2).alias("user_id"),
        F.to_date("l_shipdate").alias("transaction_date"),
        F.pmod("l_suppkey", F.lit(10)).alias("branch_number"),
    )


def _view_log(t: Tables):
    sessions = t.raw("orders").select(
        F.col("o_orderkey").alias("logging_session_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("create_date"),
        F.col("o_orderpriority").alias("source"),
    )
    views = t.raw("lineitem").select(
        F.col("l_orderkey").alias("logging_session_id"),
        F.col("l_linenumber").alias("logging_view_id"),
        F.concat(F.lit("View "), "l_linenumber").alias("view_name"),
    ).distinct()
    activity = t.raw("lineitem").select(
        F.col("l_orderkey").alias("logging_session_id"),
        F.col("l_linenumber").alias("logging_view_id"),
        F.col("l_returnflag").alias("application"),
        F.col("l_quantity").cast("bigint").alias("view_count"),
    )
    return digital.view_log(sessions, views, activity, _teller(t))


def view_log(t: Tables):
    return _view_log(t).drop("create_date")


def unresolved(t: Tables):
    return digital.unresolved_users(_view_log(t).select("user_id", "view_count",
                                                        "user_branch_number"))


def update_log(t: Tables):
    step = ["logging_session_id", "logging_view_id", "transaction_id"]
    update = [*step, "update_id"]

    def laid(keys: list[str], *rest: str):
        """Lines laid out by the keys, the other columns in one, so that all feeds read the same exchange."""
        lines = t.raw("lineitem").select(
            F.col("l_orderkey").alias("logging_session_id"),
            F.col("l_linenumber").alias("logging_view_id"),
            F.col("l_suppkey").alias("transaction_id"),
            F.col("l_partkey").alias("update_id"),
            *rest,
        )
        others = [c for c in lines.columns if c not in keys]
        whole = lines.select(*keys, F.struct(*others).alias("line")).repartition(*keys)
        return whole.select(*keys, F.inline(F.array("line")))

    by_step = laid(step, "l_shipdate")
    transactions = by_step.groupBy(*step).agg(
        F.min("update_id").alias("user_id"), F.min("l_shipdate").alias("create_date")
    )
    updates = by_step.groupBy(*update).agg(F.count(F.lit(1)).alias("line_count"))
    by_update = laid(update, "l_linestatus", "l_quantity", "l_discount")
    accounts = by_update.where(F.col("l_linestatus") == "F").select(*update).distinct().withColumn(
        "account_customer_key", F.col("logging_session_id") * 10
    )
    columns = F.explode(F.array(F.lit("quantity"), F.lit("discount"))).alias("column_name")
    keys = by_update.select(*update).distinct().select("*", columns)
    values = by_update.groupBy(*update).agg(
        F.min("l_quantity").alias("quantity"), F.min("l_discount").alias("discount")
    )
    values = values.select(
        "logging_session_id", "logging_view_id", "transaction_id", "update_id",
        F.inline(
            F.array(
                F.struct(F.lit("quantity").alias("column_name"),
                         F.col("quantity").alias("new_column_value")),
                F.struct(F.lit("discount").alias("column_name"),
                         F.col("discount").alias("new_column_value")),
            )
        ),
    )
    return digital.update_log(transactions, updates, accounts, keys, values, _teller(t)).drop(
        "create_date"
    )


def round_trip(t: Tables):
    """Events written as dated snapshots, one day again, read back; and types by CSV."""
    base = f"{shared_dir(t.spark)}/round_trip_{uuid.uuid4().hex}"
    events = t.raw("events").select(
        "event_id", "event_type", "value", F.to_date("ts").alias("snapshot_date")
    )
    write_snapshot(events, f"{base}/snapshots")
    write_snapshot(
        events.where(F.col("snapshot_date") == F.lit("2024-01-05").cast("date")),
        f"{base}/snapshots",
    )
    kinds = t.raw("events").select("event_type").distinct().withColumn(
        "letters", F.length("event_type")
    )
    export_csv(kinds, f"{base}/kinds", single_file=True)
    back = read_snapshots(t.spark, f"{base}/snapshots", layout="partitioned")
    names = read_csv(t.spark, f"{base}/kinds", "event_type STRING, letters INT")
    return (
        back.join(names, "event_type")
        .groupBy("snapshot_date", "event_type", "letters")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.sum(F.col("value").cast("decimal(18,2)")).alias("amount"),
        )
    )


def day_folders(t: Tables):
    """Events in a year/month/day tree, one day written again, and a range of it read back.

    Days, their positions and the folders to read come from folder names.
    """
    base = f"{shared_dir(t.spark)}/day_folders_{uuid.uuid4().hex}"
    events = t.raw("events").select(
        "event_id", "event_type", "value", F.to_date("ts").alias("snapshot_date")
    )
    write_snapshot(events, base, layout="folders")
    again = events.where(F.col("snapshot_date") == F.lit("2024-01-10").cast("date"))
    write_snapshot(again, base, layout="folders")
    span = {"start": "2024-01-08", "end": "2024-01-26", "years": [2023, 2024]}
    spine = snapshot_spine(t.spark, base, **span)
    back = read_snapshots(t.spark, base, **span)
    counts = back.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum(F.col("value").cast("decimal(18,2)")).alias("amount"),
    )
    return spine.join(counts, "snapshot_date", "left").select(
        "snapshot_date", "seq", "prior_date", "event_count", "amount"
    )


def _daily_events(t: Tables):
    return t.raw("events").select(
        "event_id", "event_type", F.to_date("ts").alias("snapshot_date")
    )


def tables(t: Tables):
    """A table written whole, appended by a day, replaced by a version of itself, and copied."""
    name = f"events_{uuid.uuid4().hex}"
    events, day = _daily_events(t), F.lit("2024-01-20").cast("date")
    write_table(events.where(F.col("snapshot_date") < day), name, partition_by="snapshot_date")
    for later in (F.col("snapshot_date") == day, F.col("snapshot_date") > day):
        write_table(events.where(later), name, "append", partition_by="snapshot_date")
    replace_table(t.spark.read.table(name).withColumn("version", F.lit(2)), name)
    t.spark.sql(f"CREATE DATABASE IF NOT EXISTS copy_of_{name}")
    (copied,) = copy_tables(t.spark, [name], f"copy_of_{name}")
    return t.spark.read.table(copied)


_TELLER_SQL = """
tr AS (SELECT l_partkey * 2 AS user_id, CAST(l_shipdate AS DATE) AS d, l_suppkey % 10 AS b
       FROM lineitem),
dd AS (SELECT user_id, d, b FROM tr GROUP BY 1, 2, 3
       QUALIFY row_number() OVER (PARTITION BY user_id, d ORDER BY count(*) DESC, b) = 1),
oo AS (SELECT user_id, b FROM tr GROUP BY 1, 2
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, b) = 1)"""

_VIEW_SQL = f"""
WITH {_TELLER_SQL}
SELECT l_orderkey AS logging_session_id, l_linenumber AS logging_view_id,
       o_custkey AS user_id, o_orderpriority AS source,
       'View ' || CAST(l_linenumber AS VARCHAR) AS view_name, l_returnflag AS application,
       CAST(l_quantity AS BIGINT) AS view_count, CAST(o_orderdate AS DATE) AS log_date,
       coalesce(dd.b, oo.b) AS user_branch_number
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
LEFT JOIN dd ON dd.user_id = o_custkey AND dd.d = CAST(o_orderdate AS DATE)
LEFT JOIN oo ON oo.user_id = o_custkey"""

_TRANSFERS_SQL = """
SELECT event_id AS transfer_id, transaction_date AS transfer_date,
       last_day(transaction_date) AS snapshot_date, amount,
       (SELECT count(*) FROM d_digital e WHERE e.transaction_type = 'Transfer'
          AND last_day(e.transaction_date) = last_day(d.transaction_date)) AS snapshot_rows
FROM d_digital d WHERE transaction_type = 'Transfer' AND transaction_date > DATE '2024-01-15'"""

REPORTS = [
    Report("login_pivot", logins, """
WITH u AS (
  SELECT c_custkey % 1000 AS individual_id, 'U' || CAST(c_custkey AS VARCHAR) AS user_id
  FROM customer WHERE c_mktsegment <> 'MACHINERY'
  QUALIFY row_number() OVER (PARTITION BY c_custkey % 1000
    ORDER BY c_nationkey DESC, 'U' || CAST(c_custkey AS VARCHAR)) = 1),
l AS (SELECT user_id, """ + ", ".join(
        f"nullif(count(*) FILTER (device || ' - ' || channel = '{m}'), 0) AS \"{m}\""
        for m in METHODS) + ", nullif(count(*) FILTER (device || ' - ' || channel NOT IN ("
    + ", ".join(f"'{m}'" for m in METHODS) + """)), 0) AS other
  FROM d_digital WHERE transaction_type = 'Login' AND device <> 'UNKNOWN'
    AND transaction_date BETWEEN DATE '2024-01-30' - 20 AND DATE '2024-01-30' GROUP BY 1)
SELECT individual_id, l.* EXCLUDE (user_id) FROM u LEFT JOIN l ON l.user_id = u.user_id"""),
    Report("usage_by_channel", lambda t: digital.usage_by_channel(t.digital), """
SELECT transaction_date, transaction_type, channel, count(*) AS event_count
FROM d_digital WHERE transaction_type NOT IN ('PFM Login', 'Login', 'Authenticate', 'Logout')
GROUP BY ALL""", dates=("transaction_date",)),
    Report("users_without_event", without_event, f"""
SELECT DISTINCT individual_id, user_id, first_name, last_name FROM d_digital
WHERE individual_id NOT IN (SELECT individual_id FROM d_digital
  WHERE transaction_type = 'Transfer' AND amount >= {LARGE_TRANSFER})"""),
    Report("unrecovered_failures", unrecovered, """
SELECT DISTINCT individual_id, user_id, first_name, last_name, c_mktsegment
FROM d_digital LEFT JOIN customer ON user_id = 'U' || CAST(c_custkey AS VARCHAR)
WHERE transaction_type = 'Get RDC Configuration' AND result = 'FAILURE'
  AND individual_id NOT IN (SELECT individual_id FROM d_digital
    WHERE transaction_type = 'Remote Deposit Capture' AND result = 'SUCCESS')"""),
    Report("result_trend",
           lambda t: digital.result_trend(t.digital, "Remote Deposit Capture"), """
SELECT left(transaction_stamp, 10) AS transaction_day, result, count(*) AS event_count
FROM d_digital WHERE transaction_type = 'Remote Deposit Capture' GROUP BY 1, 2"""),
    Report("channel_device_counts", lambda t: digital.channel_device_counts(t.digital), """
SELECT channel, device, count(*) AS event_count FROM d_digital
WHERE transaction_type = 'Login' AND result = 'SUCCESS' GROUP BY 1, 2"""),
    Report("transfers_since", transfers, _TRANSFERS_SQL, dates=("transfer_date", "snapshot_date")),
    Report("transfers_ranked", lambda t: transfers(t, "rank"), f"""
SELECT *, row_number() OVER (ORDER BY transfer_date DESC, transfer_id) AS rank
FROM ({_TRANSFERS_SQL})""", dates=("transfer_date", "snapshot_date")),
    Report("view_log", view_log, _VIEW_SQL, dates=("log_date",)),
    Report("unresolved_users", unresolved, f"""
SELECT user_id, CAST(sum(view_count) AS BIGINT) AS sum_view_count
FROM ({_VIEW_SQL}) WHERE user_branch_number IS NULL GROUP BY 1"""),
    Report("update_log", update_log, f"""
WITH {_TELLER_SQL},
t AS (SELECT l_orderkey, l_linenumber, l_suppkey, min(l_partkey) AS user_id,
             CAST(min(l_shipdate) AS DATE) AS log_date FROM lineitem GROUP BY 1, 2, 3),
u AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, count(*) AS line_count,
             min(l_quantity) AS q, min(l_discount) AS d,
             CASE WHEN bool_or(l_linestatus = 'F') THEN l_orderkey * 10 END AS link
      FROM lineitem GROUP BY 1, 2, 3, 4)
SELECT l_orderkey AS logging_session_id, l_linenumber AS logging_view_id,
       l_suppkey AS transaction_id, l_partkey AS update_id, t.user_id, t.log_date, line_count,
       link AS account_customer_key, column_name,
       CASE column_name WHEN 'quantity' THEN q ELSE u.d END AS new_column_value,
       coalesce(dd.b, oo.b) AS user_branch_number
FROM u JOIN t USING (l_orderkey, l_linenumber, l_suppkey)
JOIN (VALUES ('quantity'), ('discount')) c(column_name) ON TRUE
LEFT JOIN dd ON dd.user_id = t.user_id AND dd.d = t.log_date
LEFT JOIN oo ON oo.user_id = t.user_id""", dates=("log_date",)),
    Report("sink_roundtrip", round_trip, """
SELECT CAST(ts AS DATE) AS snapshot_date, event_type,
       CAST(length(event_type) AS INTEGER) AS letters, count(*) AS event_count,
       sum(CAST(value AS DECIMAL(18,2))) AS amount
FROM events GROUP BY ALL""",
           dates=("snapshot_date",), money=("amount",)),
    Report("day_folders", day_folders, """
SELECT snapshot_date, CAST(row_number() OVER o AS INTEGER) AS seq,
       lag(snapshot_date) OVER o AS prior_date, event_count, amount
FROM (SELECT CAST(ts AS DATE) AS snapshot_date, count(*) AS event_count,
             sum(CAST(value AS DECIMAL(18,2))) AS amount
      FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-26'
      GROUP BY 1)
WINDOW o AS (ORDER BY snapshot_date)""",
           dates=("snapshot_date", "prior_date"), money=("amount",)),
    Report("table_roundtrip", tables, """
SELECT event_id, event_type, CAST(ts AS DATE) AS snapshot_date, 2 AS version FROM events""",
           dates=("snapshot_date",)),
]
