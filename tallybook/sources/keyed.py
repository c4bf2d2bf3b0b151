"""Tables laid out by hash groups of a key, into which small change sets are merged.

A table is partitioned by a group number, a hash of the key, and each group is bucketed by the
key. A merge reads and rewrites the groups that its change set touches and leaves the files of
all others as they are; the join inside uses the buckets, so the table itself is never shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators.upserts import upsert
from tallybook.session import shared_dir

GROUP = "_key_group"
_GROUPS, _KEYS = "keyed.groups", "keyed.keys"
_MODE = "spark.sql.sources.partitionOverwriteMode"


def _group(keys: Sequence[str], groups: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int").alias(GROUP)


def write_keyed_table(
    df: DataFrame, name: str, keys: Sequence[str], groups: int = 256, buckets: int = 16
) -> None:
    """Write a managed table in ``groups`` hash groups of its key, each in up to ``buckets`` files.

    Choose ``groups`` so that a usual change set touches few of them, and ``buckets`` so that one bucket of
    all touched groups fits a task. Key types must stay as they are written.
    """
    out = df.withColumn(GROUP, _group(keys, groups)).repartition(buckets, *keys)
    writer = out.write.format("parquet").mode("overwrite").partitionBy(GROUP)
    writer.bucketBy(buckets, *keys).saveAsTable(name)
    listed = f"'{_GROUPS}'='{groups}', '{_KEYS}'='{','.join(keys)}'"
    df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


def _layout(spark: SparkSession, name: str) -> tuple[list[str], int]:
    known = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if _GROUPS not in known:
        raise ValueError(f"{name} was not written by write_keyed_table")
    return known[_KEYS].split(","), int(known[_GROUPS])


def _touched(spark: SparkSession, name: str, rows: DataFrame) -> tuple[list[str], DataFrame, int]:
    """The key, and the table's rows of those groups that ``rows`` has keys of."""
    keys, groups = _layout(spark, name)
    kinds = dict(spark.read.table(name).dtypes)
    same = [F.col(k).cast(kinds[k]).alias(k) for k in keys]
    numbers = rows.select(*same).select(_group(keys, groups)).distinct().collect()  # at most ``groups``
    wanted = F.col(GROUP).isin([r[0] for r in numbers]) if numbers else F.lit(False)
    return keys, spark.read.table(name).where(wanted), groups


def read_keyed(spark: SparkSession, name: str, wanted: DataFrame) -> DataFrame:
    """Rows of a keyed table whose key is in ``wanted``; only their groups are read."""
    keys, rows, _ = _touched(spark, name, wanted)
    return rows.drop(GROUP).join(wanted.select(*keys).distinct(), keys, "left_semi")


def merge_keyed(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    update: Sequence[str] | None = None,
    insert: Sequence[str] | None = None,
) -> None:
    """Merge a change set (one row per key) into a keyed table, as ``upsert`` does.

    The change set is written aside first, so it is computed once and may read the table itself.
    Groups are replaced when all rows are written; a merge that breaks off before leaves the table as
    it was, and merging again changes nothing. Rows with a null key are new ones.
    """
    aside = f"{shared_dir(spark)}/changes-{uuid.uuid4().hex}"
    source.write.parquet(aside)
    changes = spark.read.schema(source.schema).parquet(aside)
    keys, target, groups = _touched(spark, name, changes)
    columns = spark.read.table(name).columns
    merged = upsert(target.drop(GROUP), changes, keys, update, insert)
    out = merged.withColumn(GROUP, _group(keys, groups)).select(*columns)
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, "dynamic")  # only the groups that come out are replaced
    try:
        out.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(_MODE, before)
