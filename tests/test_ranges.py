"""As-of joins on times and ranks in a total order, split however one key or value dominates."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallybook.operators import asof_join, frequency_profile, ranked, rows_per_snapshot
from tallybook.operators.joins import _time_bounds

T0 = datetime(2024, 1, 1)


def brute(asked, marks, backward):
    out = []
    for i, k, t in asked:
        near = [
            m for m in marks
            if k is not None and t is not None and m[0] == k and m[1] is not None and (m[1] <= t if backward else m[1] >= t)
        ]
        best = min(near, key=lambda m: (-(m[1] - T0).total_seconds() if backward else (m[1] - T0).total_seconds(), m[2]), default=None)
        out.append((i, best[2] if best else None))
    return sorted(out)


@pytest.mark.parametrize("slices, kind", [(1, "timestamp"), (2, "timestamp_ntz"), (7, "timestamp"), (64, "timestamp_ntz")])
@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof_over_times_equals_brute_force(spark, slices, kind, direction):
    """One key with most times, ties on both sides, nulls, keys on one side only."""
    rng = random.Random(slices)

    def moment():
        return T0 + timedelta(seconds=rng.choice([rng.randint(0, 50), rng.randint(0, 100_000)]), microseconds=rng.choice([0, 1]))

    asked = [(i, rng.choice([1, 1, 1, 2, 3, None]), moment() if i % 50 else None) for i in range(600)]
    marks = [(rng.choice([1, 1, 1, 2, 4, None]), moment() if j % 50 else None, j) for j in range(500)]
    left = spark.createDataFrame(asked, f"id int, k int, t {kind}")
    right = spark.createDataFrame(marks, f"k int, rt {kind}, v int")
    got = asof_join(left, right, ["k"], "t", "rt", ["v"], direction, slices)
    assert sorted((r.id, r.v) for r in got.collect()) == brute(asked, marks, direction == "backward")


def test_one_key_is_split(spark):
    """All rows on one key: no group holds more than its share of the times."""
    left = spark.sql("SELECT 1 AS k, timestamp_seconds(id * id) AS t FROM range(20000)")
    right = spark.sql("SELECT 1 AS k, timestamp_seconds(id * id + 5) AS rt, id AS v FROM range(20000)")
    bounds = _time_bounds(left, "t", right, "rt", 16)
    assert len(bounds) == 15
    micros = [r[0] for r in left.select(F.unix_micros("t")).collect()]
    shares = [0] * 16
    for m in micros:
        shares[sum(b < m for b in bounds)] += 1
    assert max(shares) < 1.2 * 20_000 / 16
    got = asof_join(left, right, ["k"], "t", "rt", slices=16)
    assert got.where("v IS NULL").count() == 3  # the first times, 0 to 4, come before any mark
    assert got.where("unix_seconds(t) < unix_seconds(rt)").count() == 0


def test_asof_refuses_other_times(spark):
    stamps = spark.sql("SELECT 1 AS k, timestamp'2024-01-01' AS t, date'2024-01-01' AS d, '2024-01-01' AS s")
    other = stamps.select("k", F.col("t").alias("rt"), F.col("d").alias("rd"), F.col("s").alias("rs"))
    for a, b in (("t", "rd"), ("d", "rt"), ("s", "rs")):
        with pytest.raises(TypeError, match="DATE or TIMESTAMP"):
            asof_join(stamps, other.select("k", b), ["k"], a, b)


def test_rank_equals_row_number(spark):
    df = spark.sql(
        "SELECT id, cast(if(id % 3 = 0, 0, id % 17) AS int) AS v, if(id % 11 = 0, null, id % 5) AS w FROM range(3000)"
    ).repartition(7)
    order = [F.desc("v"), F.asc_nulls_last("w"), F.asc("id")]
    got = {r.id: r.rank for r in ranked(df, order).collect()}
    rows = sorted(df.collect(), key=lambda r: (-r.v, r.w is None, r.w or 0, r.id))
    assert got == {r.id: i for i, r in enumerate(rows, 1)}
    assert ranked(df.limit(0), order).count() == 0


def test_rank_uses_no_single_task(spark):
    laid = ranked(spark.range(10_000), [F.desc("id")])
    plan = laid._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_order_of_profiles(spark):
    df = spark.sql("SELECT if(id % 4 = 0, null, cast(id % 7 AS string)) AS v FROM range(200)")
    listed = [tuple(r) for r in frequency_profile(df, "v").collect()]
    assert [(*r[:2], i) for i, r in enumerate(listed, 1)] == [
        tuple(r) for r in frequency_profile(df, "v", "rank").orderBy("rank").collect()
    ]
    assert listed == sorted(listed, key=lambda r: (-r[1], r[0] is None, r[0] or ""))
    days = spark.sql("SELECT date_add(date'2024-01-01', cast(id % 9 AS int)) AS snapshot_date FROM range(50)")
    newest = [r.snapshot_date for r in rows_per_snapshot(days).collect()]
    assert newest == sorted(newest, reverse=True)
