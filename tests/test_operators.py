from datetime import date, timedelta

from pyspark.sql import functions as F

from tallybook import operators as op


def days(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(
        F.col("t").cast("date").alias("snapshot_date")
    )


def test_picks_break_ties(spark, rows):
    df = spark.createDataFrame(
        [(1, 5, "b"), (1, 5, "a"), (1, 4, "z"), (2, None, "n"), (2, 1, "m")],
        "k int, d int, v string",
    )
    assert rows(op.latest_per_key(df, ["k"], "d", ["v"])) == [(1, 5, "a"), (2, 1, "m")]
    assert rows(op.earliest_per_key(df, ["k"], "d", ["v"])) == [(1, 4, "z"), (2, 1, "m")]
    assert rows(op.top_k(df, "d", 2, ["v"])) == [(1, 5, "a"), (1, 5, "b")]


def test_mode_ties_and_nulls(spark, rows):
    df = spark.createDataFrame(
        [(1, 3), (1, 2), (1, 3), (1, 2), (2, None), (2, None), (2, 7)], "k int, v int"
    )
    assert rows(op.mode_per_key(df, ["k"], "v", "n")) == [(1, 2, 2), (2, None, 2)]


def test_most_used_agrees_with_mode(spark, rows):
    df = spark.sql(
        "SELECT id % 40 AS k, cast(pmod(hash(id), 9) - 4 AS int) AS v FROM range(600)"
    ).withColumn("v", F.when(F.col("v") != 0, F.col("v")))
    counts = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    packed = counts.groupBy("k").agg(op.most_used("v", "n").alias("v"))
    assert rows(packed) == rows(op.mode_per_key(df, ["k"], "v"))


def test_most_used_extremes(spark, rows):
    low, high = -(2**31), 2**31 - 1
    df = spark.createDataFrame(
        [
            (1, low, 5), (1, high, 5),  # tie goes to the smallest
            (2, 9, 2**40), (2, low, 2**40), (2, high, 2**31),  # too large for one bigint
            (3, 9, 2**30), (3, 1, 2**30 - 1),  # either side of the packing limit
            (4, 9, 0),  # unused
            (5, None, 8), (5, 3, 7),  # null has most
        ],
        "k int, v int, n bigint",
    )
    best = df.groupBy("k").agg(op.most_used("v", "n").alias("v"))
    assert rows(best) == [(1, low), (2, low), (3, 9), (4, None), (5, None)]


def test_spine(spark, rows):
    spine = op.processing_dates(days(spark, "2022-01-03", "2022-01-07", "2022-01-03", None))
    assert rows(spine) == [
        ("2022-01-03", 1, None, "2022-01-07"), ("2022-01-07", 2, "2022-01-03", None),
    ]
    assert rows(op.latest_two_dates(spine, "2022-01-07")) == [("2022-01-07", "2022-01-03")]
    assert rows(op.latest_two_dates(spine, "2022-01-08")) == []
    assert rows(op.processing_dates(spine, since="2022-01-04"), "snapshot_date", "seq") == [
        ("2022-01-07", 1)
    ]
    assert rows(op.day_positions(spine, before=1, after=1)) == [
        ("2022-01-02", 1), ("2022-01-03", 1), ("2022-01-04", 2), ("2022-01-05", 2),
        ("2022-01-06", 2), ("2022-01-07", 2), ("2022-01-08", 3),
    ]


def test_trailing_window_equals_between(spark, rows):
    spine = op.processing_dates(days(spark, "2022-01-31", "2022-02-28", "2022-03-31", "2022-06-30"))
    start = date(2021, 1, 1)
    events = spark.createDataFrame(
        [(i, start + timedelta(days=7 * i)) for i in range(90)], "id int, d date"
    )
    placed = op.range_join_trailing(events, spine, "d", 60).withColumn(
        "seq", F.explode(F.sequence(F.col("seq_from"), F.col("seq_until") - 1))
    )
    wanted = events.join(
        spine, F.col("d").between(F.date_sub("snapshot_date", 60), F.col("snapshot_date"))
    )
    assert rows(placed, "id", "seq") == rows(wanted, "id", "seq")


def test_asof_join(spark, rows):
    left = spark.createDataFrame(
        [(1, "a", "2022-01-05"), (1, "b", "2022-01-01"), (2, "c", "2022-01-05"),
         (None, "d", "2022-01-05"), (1, "e", None)],
        "k int, id string, t string",
    ).withColumn("ld", F.col("t").cast("date")).drop("t")
    right = spark.createDataFrame(
        [(1, "2022-01-05", "y"), (1, "2022-01-05", "x"), (1, "2022-01-02", "w"),
         (1, "2022-01-09", "v"), (None, "2022-01-05", "n")],
        "k int, t string, v string",
    ).withColumn("rd", F.col("t").cast("date")).drop("t")
    back = op.asof_join(left, right, ["k"], "ld", "rd", ["v"])
    assert rows(back, "id", "rd", "v") == [
        ("a", "2022-01-05", "x"), ("b", None, None), ("c", None, None), ("d", None, None),
        ("e", None, None),
    ]
    ahead = op.asof_join(left, right, ["k"], "ld", "rd", ["v"], "forward")
    assert rows(ahead, "id", "v")[:2] == [("a", "x"), ("b", "w")]


def test_membership_keeps_null_keys_as_new(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    known, new = op.split_by_membership(df, keys, "k")
    assert rows(known) == [(1,)] and rows(new) == [(2,), (None,)]


def test_upsert_shapes(spark, rows):
    target = spark.createDataFrame(
        [(1, "a", "x"), (2, "b", "y")], "k int, a string, b string"
    )
    source = spark.createDataFrame([(2, "B", "Y"), (3, "C", "Z")], "k int, a string, b string")
    all_all = op.upsert(target, source, ["k"])
    assert rows(all_all) == [(1, "a", "x"), (2, "B", "Y"), (3, "C", "Z")]
    assert rows(op.upsert(all_all, source, ["k"])) == rows(all_all)  # again: no change
    update_one = op.upsert(target, source.drop("b"), ["k"], update=["a"], insert=[])
    assert rows(update_one) == [(1, "a", "x"), (2, "B", "y")]
    insert_only = op.upsert(target, source, ["k"], update=[])
    assert rows(insert_only) == [(1, "a", "x"), (2, "b", "y"), (3, "C", "Z")]
    subset = op.upsert(target, source, ["k"], update=["a"], insert=["a"])
    assert rows(subset) == [(1, "a", "x"), (2, "B", "y"), (3, "C", None)]
    cleared = op.upsert(target, source.withColumn("a", F.lit(None).cast("string")), ["k"])
    assert rows(cleared)[1] == (2, None, "Y")


def test_rows_per_snapshot_marks_shrinking_days(spark, rows):
    feed = days(spark, "2022-01-03", "2022-01-03", "2022-01-04", "2022-01-05", "2022-01-05")
    assert rows(op.rows_per_snapshot(feed)) == [
        ("2022-01-03", 2, True), ("2022-01-04", 1, False), ("2022-01-05", 2, True),
    ]


def test_nested_mean_is_a_mean_of_means(spark, rows):
    df = spark.createDataFrame(
        [("b", 1, 1.0), ("b", 1, 3.0), ("b", 2, 10.0)], "b string, m int, v double"
    )
    assert rows(op.nested_mean(df, [["b", "m"], ["b"]], "v", "mean")) == [("b", 6.0)]


def test_hot_key_results_stay_whole(spark, rows):
    """A third of all rows on one key, and many ties."""
    df = spark.sql(
        "SELECT if(id % 3 = 0, 0, id) AS k, cast(id % 11 AS int) AS v, id % 5 AS d FROM range(3000)"
    )
    latest = op.latest_per_key(df, ["k"], "d", ["v"])
    assert latest.count() == df.select("k").distinct().count()
    assert rows(latest.where("k = 0")) == [(0, 0, 4)]
