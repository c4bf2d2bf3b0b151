"""Shards of bounded size by extendible hashing.

The directory is a prefix tree over hash bits. A bucket within the byte limit stays; only an oversized
one splits on its next bit. A bucket's size depends on its prefix alone, so the directory is
found from sums per prefix, added up in Spark from fine cells to coarse ones; the splits are
the same as if rows came one by one. Nothing of it passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.frames import stored

SHARD_BYTES = 4 << 20
#: Bits by which the first cells are finer than the directory is expected to be.
_FINER_BITS = 6
_MAX_BITS = 62


def _cell(bits: int) -> Column:
    return F.shiftrightunsigned("hash", 64 - bits)


def _directory(cells: DataFrame, depth: int, top: int, limit: int) -> DataFrame:
    """Buckets (prefix, bits, bytes, rows) that fit, and those at ``depth`` that do not.

    ``cells`` has sums per prefix of ``depth`` bits; a bucket is the shortest prefix, of ``top`` bits or
    more, that fits the limit, or a cell that still does not.
    """
    levels = cells.select(F.lit(depth).alias("bits"), "cell", "bytes", "rows")
    every = F.explode(F.sequence(F.lit(top), F.lit(depth)))
    sums = levels.withColumn("at", every)
    sums = sums.withColumn("prefix", F.expr(f"shiftright(cell, {depth} - at)"))
    sums = sums.groupBy("at", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    parent = sums.select((F.col("at") + 1).alias("p_at"), F.col("prefix").alias("p_prefix"), F.col("bytes").alias("p_bytes"))
    on = (F.col("at") == F.col("p_at")) & (F.shiftright("prefix", 1) == F.col("p_prefix"))
    joined = sums.join(parent, on, "left")
    split = F.col("p_bytes").isNull() | (F.col("p_bytes") > limit)
    ends = (F.col("bytes") <= limit) | (F.col("at") == depth)
    return joined.where(split & ends).select("prefix", F.col("at").alias("bits"), "bytes", "rows")


def extendible_shards(
    docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, bytes, bits, prefix, page.

    A shard is (bits, prefix, page) and its texts have at most ``limit`` UTF-8 bytes together, or it
    holds one row that is larger. Rows that repeat id and text have one hash, which no bit can split: if
    they exceed the limit, they overflow into further pages. Null text has no bytes; a null
    id is hashed as such. An empty table gives no rows. Only id and text are read.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("bytes"),
        F.xxhash64(F.lit("shard"), id_col, text_col).alias("hash"),
    )
    # equal rows travel as one with a count
    rows = stored(rows.groupBy("doc_id", "bytes", "hash").agg(F.count("*").alias("copies")), "hashed")
    total = rows.agg(F.coalesce(F.sum(F.col("bytes") * F.col("copies")), F.lit(0))).first()[0]
    depth, top = _FINER_BITS, 0
    while depth < _MAX_BITS and total > limit << (depth - _FINER_BITS):
        depth += 1
    done, open_rows = [], rows
    while True:
        cells = open_rows.groupBy(_cell(depth).alias("cell")).agg(
            F.sum(F.col("bytes") * F.col("copies")).alias("bytes"), F.count("*").alias("rows")
        )
        found = stored(_directory(cells, depth, top, limit), "directory")
        large = found.where((F.col("bytes") > limit) & (F.col("rows") > 1))
        done.append((depth, top, found))
        if depth == _MAX_BITS or large.isEmpty():
            break
        large = large.select(F.col("prefix").alias("large"))
        open_rows = open_rows.join(large, _cell(depth) == F.col("large"), "left_semi")
        depth, top = min(_MAX_BITS, depth + 8), depth + 1
    return _assigned(rows, done, limit)


def _assigned(rows: DataFrame, done: list, limit: int) -> DataFrame:
    out = None
    for k, (depth, top, found) in enumerate(done):
        last = k == len(done) - 1
        settled = found if last else found.where(~((F.col("bytes") > limit) & (F.col("rows") > 1)))
        # a row meets its bucket on the bucket's range of finest cells
        width = F.expr(f"shiftleft(1L, {depth} - bits)")
        ends = settled.select("bits", "prefix", F.col("bytes").alias("bucket_bytes"), F.explode(
            F.sequence(F.col("prefix") * width, (F.col("prefix") + 1) * width - 1)
        ).alias("cell"))
        met = rows.join(ends, _cell(depth) == F.col("cell")).drop("cell")
        out = met if out is None else out.union(met)
    # a bucket above the limit is one row with its copies, but for rows of equal hash by chance
    size = F.greatest(F.col("bytes"), F.lit(1))
    per_page = F.greatest(F.floor(F.lit(limit) / size), F.lit(1))
    over = F.col("bucket_bytes") > limit
    out = out.withColumn("per_page", F.when(over, per_page).otherwise(F.col("copies")))
    order = Window.partitionBy("bits", "prefix").orderBy("hash", "doc_id", "bytes")
    before = F.sum(F.ceil(F.col("copies") / F.col("per_page"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    late = out.where(over).withColumn("base", F.coalesce(before, F.lit(0)))
    both = out.where(~over).withColumn("base", F.lit(0).cast("bigint")).union(late)
    each = both.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    page = (F.col("base") + F.floor(F.col("copy") / F.col("per_page"))).cast("bigint").alias("page")
    return each.select("doc_id", "bytes", "bits", "prefix", page)


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> str:
    """``docs`` as Parquet, one folder ``shard=bits-prefix-page`` per shard; ids must be unique.

    Returns the folders' column: ``shard``, with underscores behind it while ``docs`` has one of that name.
    """
    column = "shard"
    while column in {c.lower() for c in docs.columns}:
        column += "_"
    found = extendible_shards(docs, limit, id_col, text_col)
    name = F.concat_ws("-", "bits", "prefix", "page").alias(column)
    named = found.select(F.col("doc_id").alias("id"), name).alias("__named")
    same = F.col(f"__docs.{id_col}").eqNullSafe(F.col("__named.id"))
    rows = docs.alias("__docs").join(named, same).select("__docs.*", f"__named.{column}")
    rows.repartition(column).write.partitionBy(column).parquet(path)
    return column
