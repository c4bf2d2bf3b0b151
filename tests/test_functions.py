from pyspark.sql import functions as F

from tallybook import functions as fn
from tallybook.operators import recode_values, sanitize_columns, union_feeds


def one(spark, column, **values):
    """Value of an expression over one row of text columns."""
    schema = ", ".join(f"{name} string" for name in values)
    df = spark.createDataFrame([tuple(values.values())], schema)
    return df.select(column.alias("v")).first()["v"]


def test_snapshot_date_reads_both_formats(spark):
    cases = {
        "2022-05-06 00:00:00": "2022-05-06",
        "2022-05-06": "2022-05-06",
        "5/06/2022 00:00": "2022-05-06",
        "12/06/2021 0:00": "2021-12-06",
        "1/3/2022 0:00": "2022-01-03",
        "bad": None,
        "": None,
        None: None,
    }
    for text, day in cases.items():
        got = one(spark, fn.normalize_snapshot_date("t"), t=text)
        assert (got and got.isoformat()) == day, text


def test_parse_datetime_is_null_when_malformed(spark):
    good = one(spark, fn.parse_datetime("t", "MM/dd/yyyy HH:mm:ss"), t="03/04/2022 05:06:07")
    assert good.isoformat() == "2022-03-04"
    assert one(spark, fn.parse_datetime("t", "M/d/yyyy"), t="2022-03-04") is None
    assert one(spark, fn.date_prefix("t"), t="2022-03-04 05:06:07") == "2022-03-04"


def test_keys(spark):
    assert one(spark, fn.normalize_key("k"), k="000123") == 123
    assert one(spark, fn.normalize_key("k"), k="12a") is None
    assert one(spark, fn.normalize_key("k", "string"), k="000123") == "123"
    assert one(spark, fn.normalize_key("k", "string"), k="000") == ""
    assert one(spark, fn.derive_card_pan("k"), k="0004111222233334") == "411122223333"
    key = fn.build_account_key("t", "n")
    assert one(spark, key, t="T", n="42") == "1-CD-" + "0" * 18 + "42"
    assert one(spark, key, t="X", n="7").startswith("1-ERROR-")


def test_text(spark):
    blank = fn.first_non_blank(["a", "b"])
    assert one(spark, blank, a="", b="NSF") == "NSF"
    assert one(spark, blank, a=None, b="") == "ERROR"
    trim = fn.trim_suffix_when("a", "OWN", 2)
    assert one(spark, trim, a="MAIN OWN-1") == "MAIN OWN"
    assert one(spark, trim, a="MAIN") == "MAIN"
    assert one(spark, fn.contains_any("a", ["PayPal", "sq*"]), a="xx SQ* yy") is True
    assert one(spark, fn.contains_any("a", ["PayPal"], True), a="paypal") is False
    assert one(spark, fn.contains_any("a", []), a="paypal") is False
    assert one(spark, fn.starts_with_any("a", ["RET", "Retail"]), a="Retail loan") is True
    assert one(spark, fn.starts_with_any("a", ["RET"]), a="xRET") is False


def test_window_edges(spark):
    inside = fn.date_window(F.col("d").cast("date"), "2022-03-31", 91)
    assert one(spark, inside, d="2021-12-30") is True  # exactly 91 days before
    assert one(spark, inside, d="2021-12-29") is False
    assert one(spark, inside, d="2022-03-31") is True
    assert one(spark, inside, d="2022-04-01") is False
    active = fn.active_within(F.col("d").cast("date"), "2022-03-31", 30)
    assert one(spark, active, d="2022-03-01") == "no"  # exactly 30 days is not newer
    assert one(spark, active, d="2022-03-02") == "yes"
    assert one(spark, active, d=None) == "no"


def test_classify_takes_the_first_rule(spark):
    rule = fn.classify([(F.col("a") > "1", "x"), (F.col("a") > "0", "y")], "z")
    assert [one(spark, rule, a=v) for v in ("2", "1", "0", None)] == ["x", "y", "z", "z"]


def test_period_columns(spark):
    columns = fn.period_columns(F.col("d").cast("date"))
    got = {n: one(spark, c, d="2024-12-31") for n, c in columns.items()}
    assert (got["year"], got["month"], got["quarter"]) == (2024, 12, "2024_4")
    assert got["month_start"] == "2024-12-01"
    assert got["month_end"].isoformat() == "2024-12-31"
    assert got["prior_month_end"].isoformat() == "2024-11-30"


def test_frames(spark, rows):
    odd = spark.createDataFrame([(1, "x", "y")], ["db/cr_flag", "0", "USER ID"])
    assert sanitize_columns(odd, {"0": "prediction"}).columns == [
        "db_cr_flag", "prediction", "USER_ID",
    ]
    coded = spark.createDataFrame([("1",), ("9",), (None,)], "b string")
    names = spark.createDataFrame([("1", "Main")], "key string, value string")
    assert rows(recode_values(coded, ["b"], names)) == [("9",), ("Main",), (None,)]
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k int")
    assert rows(union_feeds(a, b)) == [(1, "x", None), (2, None, "y")]
