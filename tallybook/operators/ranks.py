"""Positions of rows in a total order, without sorting all rows in one task."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.session import shared_dir


def ranked(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Rows with their position (from 1, bigint) in ``order``, which should leave no ties.

    Rows are dealt to ranges of the order and sorted within them; a row's position is its place in its range
    plus the rows of the ranges before, of which one count each passes through the driver. The
    sorted rows are written in the shared folder first, since ranges found anew need not be the same.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/ranked-{uuid.uuid4().hex}"
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = laid.select(
        "*",
        F.spark_partition_id().alias("_range"),
        F.monotonically_increasing_id().alias("_place"),
    )
    placed.write.parquet(path)
    kept = spark.read.schema(placed.schema).parquet(path)
    counts = dict(kept.groupBy("_range").count().collect())  # a number per range
    before, offsets = 0, []
    for k in range(max(counts, default=-1) + 1):
        offsets.append(before)
        before += counts.get(k, 0)
    # Spark numbers the rows of partition k from k * 2**33 on
    place = F.col("_place") - F.shiftleft(F.col("_range").cast("bigint"), 33)
    first = F.get(F.lit(offsets or [0]).cast("array<bigint>"), F.col("_range"))
    return kept.withColumn(name, first + place + 1).drop("_range", "_place")
