"""Reading tables, row selection by document, and tables written in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.session import shared_dir

_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder, read back.

    Cuts lineage for steps that are read more than once: a lost executor takes no finished
    part of it along, and nothing before it runs again. Shuffle files of the write go with its end.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tallybook-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_SHUFFLES, None)
    spark.conf.set(_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES)
        else:
            spark.conf.set(_SHUFFLES, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`stored` that nothing will read again."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        conf = table.sparkSession._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)


def keep_documents(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs``, all columns, whose id is in ``kept``; null meets null.

    Rows that repeat an id are one document and share its fate.
    """
    wanted = kept.select(F.col(id_col).alias("id")).alias("__kept")
    same: Column = F.col(f"__docs.{id_col}").eqNullSafe(F.col("__kept.id"))
    return docs.alias("__docs").join(wanted, same, "left_semi").select("__docs.*")


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
