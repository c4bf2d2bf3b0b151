"""Physical plans: no pairing of all rows, no Python in the hot path, pruned scans."""

import re

import pytest
from pyspark.sql import functions as F

from tallybook.operators import pivot_agg, processing_dates
from tallybook.plans import lifecycle
from tallybook.plans.branches import direct_branch
from tallybook.reports.registry import all_reports
from tallybook.sources import read_snapshots, write_snapshot

SF_DIR = "/root/testdata/sf0.001"
REPORTS = all_reports()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(REPORTS))
def test_no_cross_joins_and_no_python(spark, name):
    plan = physical(REPORTS[name].run(spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["latest_per_key", "earliest_per_key", "mode_per_key"])
def test_picks_cut_rows_before_the_exchange(spark, name):
    plan = physical(REPORTS[name].run(spark, SF_DIR))
    assert plan.count("WindowGroupLimit") == 2
    exchange = plan.rindex("Exchange hashpartitioning") if "latest" in name else None
    if exchange is not None:
        assert "WindowGroupLimit" in plan[exchange:]


def test_scan_reads_only_needed_columns(spark):
    plan = physical(REPORTS["direct_branch"].run(spark, SF_DIR))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all(s.count(":") == 3 for s in lineitem)


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "trans")
    spark.sql(
        "SELECT id AS account_key, cast(id % 5 AS int) AS branch_number, "
        "date_add(date'1999-01-01', cast(id AS int)) AS transaction_date, 'x' AS unused "
        "FROM range(50)"
    ).write.parquet(path)
    owners = spark.sql("SELECT id AS account_key, id AS customer_key, 'Y' AS primary_customer_flag"
                       " FROM range(50)")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = physical(direct_branch(spark.read.parquet(path), owners, "1999-02-01", 10))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "GreaterThanOrEqual(transaction_date" in pushed
    assert "LessThanOrEqual(transaction_date" in pushed
    assert "unused" not in re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)


def test_day_range_prunes_partitions(spark, tmp_path):
    base = str(tmp_path / "snapshots")
    write_snapshot(
        spark.sql("SELECT id, date_add(date'2024-01-01', cast(id AS int)) AS snapshot_date "
                  "FROM range(5)"),
        base,
    )
    plan = physical(read_snapshots(spark, base, start="2024-01-04", layout="partitioned"))
    assert re.search(r"PartitionFilters: \[[^\]]*snapshot_date", plan)


def test_status_flags_read_presence_once(spark):
    plan = physical(REPORTS["status_flags"].run(spark, SF_DIR))
    assert len(re.findall(r"FileScan parquet \[[^\]]*user_id", plan)) == 1


def _snapshots(spark, base, days=6):
    rows = spark.sql(
        "SELECT id % 7 AS customer_key, id % 7 AS account_key, "
        f"date_add(date'2024-01-01', cast(id % {days} AS int)) AS snapshot_date FROM range(300)"
    )
    write_snapshot(rows.repartition(8), base)
    return spark.read.parquet(base)


def _partitions_read(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", text)


def test_writer_files_follow_the_data(spark, tmp_path):
    base = tmp_path / "snapshots"
    _snapshots(spark, str(base))
    assert len(list(base.glob("snapshot_date=*/*.parquet"))) == 6


def test_incremental_ledger_reads_recent_days_only(spark, tmp_path):
    presence = _snapshots(spark, str(tmp_path / "presence"))
    spine = processing_dates(presence)
    ledger = lifecycle.acquisition_ledger(
        spark.sql("SELECT cast(id AS bigint) AS customer_key, cast(null AS date) AS "
                  "original_acquisition_date, cast(null AS date) AS most_recent_acquisition_date, "
                  "cast(null AS date) AS most_recent_lost_date FROM range(7)"),
        lifecycle.snapshot_diff(presence, spine),
    )
    found = _partitions_read(lifecycle.ledger_incremental(ledger, presence, spine, "2024-01-05"))
    assert any("ubquery" in f and ">=" in f for f in found)


def test_presence_is_laid_out_once(spark, tmp_path):
    presence = _snapshots(spark, str(tmp_path / "presence"))
    spine = spark.sql(
        "SELECT date'2024-01-01' AS snapshot_date, 1 AS seq, cast(null AS date) AS prior_date, "
        "date'2024-01-02' AS next_date"
    )
    plan = physical(lifecycle.snapshot_diff(presence, spine))
    assert plan.count("Exchange hashpartitioning") == 1


def test_spine_refuses_stamps_finer_than_days(spark):
    with pytest.raises(TypeError, match="must be a DATE"):
        processing_dates(spark.sql("SELECT current_timestamp() AS snapshot_date"))


def test_unlisted_pivot_values_are_not_lost(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, 'a'), (1, 'b'), (2, null) AS t(k, v)")
    got = pivot_agg(rows, ["k"], "v", ["a"], F.count(F.lit(1)), other="other").orderBy("k")
    assert [tuple(r) for r in got.collect()] == [(1, 1, 1), (2, None, 1)]
    with pytest.raises(Exception, match="not listed"):
        pivot_agg(rows, ["k"], "v", ["a"], F.count(F.lit(1))).collect()
