"""Tables, dated snapshots and CSV exports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybook.functions.dates import as_date


def _declared(df: DataFrame, schema: StructType | str | None) -> DataFrame:
    if schema is None:
        return df
    struct = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in struct])


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    schema: StructType | str | None = None,
    partition_by: str | None = None,
) -> None:
    """Overwrite or append a managed parquet table, in its declared schema if given.

    ``partition_by`` is a column of few values, such as the day, by which reads are pruned.
    """
    out = _declared(df, schema)
    if partition_by is None:
        out.write.format("parquet").mode(mode).saveAsTable(name)
    else:
        rows = out.hint("rebalance", partition_by).write.format("parquet")
        rows.mode(mode).partitionBy(partition_by).saveAsTable(name)


def replace_table(df: DataFrame, name: str) -> None:
    """Replace a table by a DataFrame that may read that same table.

    The new version is written beside the old one and then takes its name, so the
    files being read are never the files being written. The old version is put aside, not
    dropped, until the new one has the name: a swap that breaks off is mended by renaming.
    """
    spark = df.sparkSession
    df.write.format("parquet").mode("overwrite").saveAsTable(f"{name}__next")
    existed = spark.catalog.tableExists(name)
    if existed:
        spark.sql(f"DROP TABLE IF EXISTS {name}__old")
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
    spark.sql(f"ALTER TABLE {name}__next RENAME TO {name}")
    if existed:
        spark.sql(f"DROP TABLE {name}__old")


def write_snapshot(
    df: DataFrame,
    base: str,
    day: str | None = None,
    date_col: str = "snapshot_date",
    layout: str = "partitioned",
) -> None:
    """Write rows under one folder per day, replacing only the days written.

    All days of a many-day result go out in one job. Rows are laid out by day first, so the
    number of files follows the data; a large day still splits. Running a day again replaces it.
    ``layout="folders"`` gives a ``yyyy/MM/dd`` tree; days are written aside and then take their
    places by renaming. Rows without a day are left out of such a tree.
    """
    out = df.withColumn(date_col, as_date(day)) if day is not None else df
    if layout == "folders":
        aside = f"{base.rstrip('/')}/_writing-{uuid.uuid4().hex}"
        write_snapshot(out.where(F.col(date_col).isNotNull()), aside, date_col=date_col)
        _take_places(df.sparkSession, aside, base.rstrip("/"), date_col)
        return
    (
        out.hint("rebalance", date_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_col)
        .parquet(base)
    )


def _take_places(spark: SparkSession, aside: str, base: str, date_col: str) -> None:
    """Rename day folders into a ``yyyy/MM/dd`` tree; one step per calendar day written."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(aside).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path(aside)):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{date_col}="):
            target = path(f"{base}/{name.split('=')[1].replace('-', '/')}")
            files.mkdirs(target.getParent())
            files.delete(target, True)
            if not files.rename(status.getPath(), target):
                raise OSError(f"could not move {status.getPath()} to {target}")
    files.delete(path(aside), True)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` is for hand-over extracts of known small size."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").csv(path, header=True)


def copy_tables(spark: SparkSession, tables: list[str], target_db: str) -> list[str]:
    """Rewrite tables under another database; returns the new names."""
    made = []
    for table in tables:
        name = f"{target_db}.{table.split('.')[-1]}"
        write_table(spark.read.table(table), name)
        made.append(name)
    return made
