"""Lookups used as values: same rows as a join, and the large side stays where it is."""

import pytest
from pyspark.sql import functions as F

from tallybook.operators import lookups, recode_values, small_lookup
from tallybook.plans import branches, conform


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(df) -> int:
    """Exchanges of the main plan; subqueries over local relations move nothing large."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Subqueries")[0].count("Exchange hashpartitioning")


def test_lookup_equals_left_join(spark, rows):
    df = spark.sql("SELECT id AS n, if(id % 7 = 0, null, cast(id % 40 AS string)) AS k, id % 3 AS j FROM range(200)")
    names = spark.sql("SELECT cast(id AS string) AS k, id % 3 AS j, if(id % 5 = 0, null, concat('v', id)) AS v FROM range(30)")
    for keys in (["k"], ["k", "j"]):
        lookup = names.select(*keys, "v")
        found = small_lookup(lookup, keys, "v")
        got = df.select("n", found.get(*keys, typed=[df.schema[k].dataType for k in keys]).alias("v"))
        assert rows(got) == rows(df.join(lookup, keys, "left").select("n", "v"))


def test_other_types_are_cast(spark, rows):
    found = small_lookup(spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') t(k, v)"), ["k"], "v")
    df = spark.sql("SELECT * FROM VALUES ('1'), ('02'), ('x'), (null) t(k)")
    assert rows(df.select("k", found.get("k").alias("v"))) == [("02", "b"), ("1", "a"), ("x", None), (None, None)]


def test_what_is_no_small_lookup(spark):
    many = spark.range(lookups.LOOKUP_ROWS + 1).select(F.col("id").alias("k"), F.col("id").alias("v"))
    assert small_lookup(many, ["k"], "v") is None
    assert small_lookup(many.where("k > 0"), ["k"], "v") is not None
    wide = spark.range(100).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 100_000).alias("v"))
    assert small_lookup(wide, ["k"], "v") is None
    twice = spark.sql("SELECT * FROM VALUES (1, 'a'), (1, 'b') t(k, v)")
    assert small_lookup(twice, ["k"], "v") is None
    empty = small_lookup(twice.limit(0), ["k"], "v")
    assert spark.range(2).select(empty.get(F.lit(1)).alias("v")).collect() == [(None,), (None,)]


@pytest.mark.parametrize("most", [lookups.LOOKUP_ROWS, 2])
def test_recoding_in_place_or_by_combinations(spark, rows, monkeypatch, most):
    monkeypatch.setattr(small_lookup, "__defaults__", (most,))
    df = spark.sql("SELECT id, if(id % 9 = 0, null, cast(id % 5 AS string)) AS a, cast(id % 2 AS string) AS b, 'z' AS c FROM range(50)")
    names = spark.sql("SELECT * FROM VALUES ('0', 'null'), ('1', 'one'), ('3', 'three'), ('4', null) t(key, value)")
    known = {"0": "null", "1": "one", "3": "three"}
    expected = [(r.id, known.get(r.a, r.a), known.get(r.b, r.b), "z") for r in df.collect()]
    got = recode_values(df, ["a", "b"], names)
    assert got.columns == df.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_names_of_a_hot_branch_move_no_assignment(spark, no_broadcast):
    assigned = spark.sql(
        "SELECT id AS customer_key, cast(if(id % 10 = 0, id % 25, 3) AS int) AS primary_branch_number,"
        " 3 AS direct_branch_number, 4 AS acct_branch_number, 5 AS opening_branch, 3 AS"
        " dynamic_branch_assignment, 'Y' AS is_active, 'N' AS is_direct, date'2022-01-03' AS snapshot_date"
        " FROM range(2000)"
    )
    lookup = spark.sql("SELECT cast(id AS int) AS branch_id, concat('B', id) AS branch_description, 1 AS utc_timestamp FROM range(20)")
    named = branches.assignment_with_names(assigned, lookup)
    assert exchanges(named) == 0
    names = named.groupBy("primary_branch_name", "acct_branch_name").count().collect()
    assert {tuple(r) for r in names} == {
        ("B3", "B4", 1800), ("B0", "B4", 40), ("B5", "B4", 40), ("B10", "B4", 40), ("B15", "B4", 40), ("20", "B4", 40),
    }


def test_relationships_of_a_hot_application_are_moved_once(spark, no_broadcast):
    xref = spark.sql(
        "SELECT id AS account_key, if(id % 10 = 0, 'LN', 'DD') AS application, if(id % 10 = 0, '1-B', '1-A') AS"
        " relationship_key, id AS customer_key, 'Y' AS primary_customer_flag FROM range(2000)"
    )
    groups = spark.sql("SELECT * FROM VALUES ('DD', 'Deposit') t(application_code, product_group)")
    owners = spark.sql("SELECT * FROM VALUES ('1-A', 'Direct'), ('1-B', 'Indirect') t(relationship_key, ownership_type)")
    accounts = spark.sql("SELECT id AS account_key, 'OPEN' AS conformed_status FROM range(1900)")
    base = conform.build_relationship_base(xref, groups, owners, accounts)
    assert exchanges(base) == 2  # xref and accounts meet by account, the key with a row each
    got = base.groupBy("product_group", "ownership_type", "conformed_status").count().collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [
        ("Deposit", "Direct", "OPEN", 1710), ("Deposit", "Direct", None, 90),
        (None, "Indirect", "OPEN", 190), (None, "Indirect", None, 10),
    ]))
