"""Dated snapshot trees and CSV files."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybook.functions.dates import as_date
from tallybook.sources.days import list_days


def read_snapshots(
    spark: SparkSession,
    base: str,
    start: date | str | None = None,
    end: date | str | None = None,
    years: Iterable[int] | None = None,
    layout: str = "folders",
    schema: StructType | str | None = None,
) -> DataFrame:
    """Parquet snapshots of some or all processing days, with ``snapshot_date``.

    ``layout="folders"`` reads a ``yyyy/MM/dd`` tree and takes the day from the file path.
    Range and years become the paths of the days that exist, so other folders are neither
    listed nor opened. ``layout="partitioned"`` reads a tree written by
    :func:`write_snapshot`, where a day range prunes partitions. No day in range gives no rows if a
    ``schema`` is declared, else it is an error.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if layout == "partitioned":
        df = reader.parquet(base)
        if years is not None:
            df = df.where(F.year("snapshot_date").isin(list(years)))
        if start is not None:
            df = df.where(F.col("snapshot_date") >= as_date(start))
        if end is not None:
            df = df.where(F.col("snapshot_date") <= as_date(end))
        return df
    paths = list(list_days(spark, base, start, end, years).values())
    if not paths:
        if schema is None:
            raise ValueError(f"no processing day of {base} is in range, and no schema is declared")
        empty = spark.createDataFrame([], schema)
        return empty.withColumn("snapshot_date", F.lit(None).cast("date"))
    stamp = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4}/\d{2}/\d{2})/[^/]+$", 1)
    return reader.parquet(*paths).withColumn("snapshot_date", F.to_date(stamp, "yyyy/MM/dd"))


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header; without a schema the types are inferred, which reads it twice."""
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.csv(path, header=True, schema=schema)
