"""Snapshot trees by folder names, and tables that are merged group by group."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallybook.operators import processing_dates, upsert
from tallybook.sources import days as tree_days, keyed
from tallybook.sources import list_days, merge_keyed, read_keyed, read_snapshots, snapshot_spine
from tallybook.sources import write_keyed_table, write_snapshot


@pytest.fixture
def tree(spark, tmp_path):
    """Day folders of three years; what is no day must be passed over."""
    base = tmp_path / "tree"
    for text in ("2021/12/30", "2021/12/31", "2022/01/03", "2022/02/28", "2022/02/31", "2023/01/02", "2023/xx/01"):
        spark.range(2).coalesce(1).write.parquet(f"{base}/{text}")
    (base / "_SUCCESS").write_text("")
    (base / "notes").mkdir()
    return str(base)


def test_days_of_a_tree(spark, tree):
    found = list_days(spark, tree)
    assert list(found) == [
        date(2021, 12, 30), date(2021, 12, 31), date(2022, 1, 3), date(2022, 2, 28), date(2023, 1, 2),
    ]
    assert found[date(2022, 1, 3)] == f"{tree}/2022/01/03"
    assert list(list_days(spark, tree, "2021-12-31", "2022-01-31")) == [date(2021, 12, 31), date(2022, 1, 3)]
    assert list(list_days(spark, tree, years=[2023])) == [date(2023, 1, 2)]
    assert list(list_days(spark, tree, start="2022-01-01", years=[2021, 2022])) == [date(2022, 1, 3), date(2022, 2, 28)]
    assert list_days(spark, f"{tree}/nowhere") == {}


def test_only_folders_in_range_are_listed(spark, tree, monkeypatch):
    listed = []
    real = tree_days._subfolders
    monkeypatch.setattr(tree_days, "_subfolders", lambda s, p: listed.append(p.removeprefix(tree)) or real(s, p))
    assert list(list_days(spark, tree, "2022-02-01", "2022-02-28")) == [date(2022, 2, 28)]
    assert listed == ["", "/2022", "/2022/02"]
    listed.clear()
    list_days(spark, tree, years=[2021])
    assert listed == ["", "/2021", "/2021/12"]


@pytest.mark.parametrize("layout", ["folders", "partitioned"])
def test_spine_opens_no_file(spark, rows, tmp_path, layout):
    base = tmp_path / "tree"
    names = ["2022/01/03", "2022/01/07", "2022/01/10"]
    for name in names:
        folder = name if layout == "folders" else "snapshot_date=" + name.replace("/", "-")
        (base / folder).mkdir(parents=True)
        (base / folder / "part-0.parquet").write_text("no parquet file at all")
    spine = snapshot_spine(spark, str(base), start="2022-01-04", layout=layout)
    assert rows(spine) == [
        ("2022-01-07", 1, None, "2022-01-10"), ("2022-01-10", 2, "2022-01-07", None),
    ]
    assert "FileScan" not in spine._jdf.queryExecution().executedPlan().toString()


def test_spine_equals_that_of_the_feed(spark, rows, tree):
    assert rows(snapshot_spine(spark, tree, end="2022-02-27")) == rows(
        processing_dates(read_snapshots(spark, tree, end="2022-02-27"))
    )
    assert snapshot_spine(spark, tree, start="2030-01-01").count() == 0


def test_range_without_days(spark, tree):
    assert read_snapshots(spark, tree, start="2030-01-01", schema="id long").columns == ["id", "snapshot_date"]
    with pytest.raises(ValueError, match="no processing day"):
        read_snapshots(spark, tree, start="2030-01-01")


def test_day_folders_replace_their_days(spark, rows, tmp_path):
    base = str(tmp_path / "out")
    feed = spark.sql("SELECT id, date_add(date'2024-01-30', cast(id % 3 AS int)) AS snapshot_date FROM range(9)")
    write_snapshot(feed, base, layout="folders")
    write_snapshot(feed.where("id = 1").drop("snapshot_date"), base, "2024-01-31", layout="folders")
    back = read_snapshots(spark, base)
    assert rows(back.groupBy("snapshot_date").agg(F.count("*").alias("n"))) == [
        ("2024-01-30", 3), ("2024-01-31", 1), ("2024-02-01", 3),
    ]
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["2024"]


def _ledger(spark, n=400):
    return spark.range(n).select(F.col("id").alias("k"), F.lit("old").alias("a"), (F.col("id") % 7).alias("b"))


def _files(spark, name):
    found = spark.read.table(name).select("_key_group", F.input_file_name().alias("f")).distinct()
    out = {}
    for group, file in found.collect():
        out.setdefault(group, set()).add(file)
    return out


def test_merge_rewrites_touched_groups_only(spark, rows):
    name = "keyed_files"
    write_keyed_table(_ledger(spark), name, ["k"], groups=32, buckets=4)
    before = _files(spark, name)
    assert len(before) == 32 and all(len(f) <= 4 for f in before.values())
    # the change set reads the table it is merged into; ids come in another type
    changes = spark.read.table(name).where("k IN (3, 5)").select(F.col("k").cast("int"), F.lit("new").alias("a"))
    changes = changes.union(spark.sql("SELECT 1000, 'born'"))
    expected = rows(upsert(_ledger(spark), changes.withColumn("k", F.col("k").cast("long")), ["k"]))
    merge_keyed(spark, name, changes)
    assert rows(spark.read.table(name).drop("_key_group")) == expected
    after = _files(spark, name)
    changed = {g for g in after if after[g] != before.get(g)}
    assert 1 <= len(changed) <= 3
    merge_keyed(spark, name, changes)  # again: no change
    assert rows(spark.read.table(name).drop("_key_group")) == expected
    merge_keyed(spark, name, changes.limit(0))
    assert rows(spark.read.table(name).drop("_key_group")) == expected


@pytest.mark.parametrize("kind", [{"update": ["a"]}, {"insert": []}, {"update": []}, {"update": ["b"], "insert": ["a"]}, {}])
def test_keyed_merge_equals_upsert(spark, rows, kind):
    name = f"keyed_{abs(hash(str(kind)))}"
    target = _ledger(spark, 60).withColumn("j", F.col("k") % 3)
    source = spark.sql(
        "SELECT id AS k, if(id % 2 = 0, 'new', null) AS a, -id AS b, id % 3 AS j FROM range(50, 70) "
        "UNION ALL SELECT null, 'nobody', 1, null"
    )
    write_keyed_table(target, name, ["k", "j"], groups=8, buckets=3)
    merge_keyed(spark, name, source, **kind)
    back = spark.read.table(name).select(*target.columns)
    assert rows(back) == rows(upsert(target, source, ["k", "j"], **kind))


def test_merge_does_not_shuffle_the_table(spark):
    name = "keyed_plan"
    write_keyed_table(_ledger(spark), name, ["k"], groups=8, buckets=4)
    source = _ledger(spark, 50)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys, target, _ = keyed._touched(spark, name, source)
        plans = [upsert(target.drop("_key_group"), source, keys), read_keyed(spark, name, source)]
        for df in plans:
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            scan = plan[: plan.index("FileScan")].splitlines()[-12:]
            assert "Bucketed: true" in plan
            joined = [k for k, line in enumerate(scan) if "SortMergeJoin" in line]
            assert not any("Exchange" in line for line in (scan[joined[-1] :] if joined else scan))
            assert "PartitionFilters: [_key_group" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_keyed_tables_are_merged(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("plain_table")
    with pytest.raises(ValueError, match="write_keyed_table"):
        merge_keyed(spark, "plain_table", spark.range(1))
