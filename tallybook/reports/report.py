"""A report: a Spark query over a table folder and the SQL that must agree with it."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from tallybook.reports.shapes import SHAPES_SQL, Tables


@dataclass(frozen=True)
class Report:
    """``dates`` and ``money`` name the columns the SQL renders as text and double."""

    name: str
    build: Callable[[Tables], DataFrame]
    sql: str
    dates: tuple[str, ...] = ()
    money: tuple[str, ...] = ()

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(self.build(Tables(spark, sf_dir)))

    def oracle(self) -> str:
        casts = [f"CAST({c} AS VARCHAR) AS {c}" for c in self.dates]
        casts += [f"CAST({c} AS DOUBLE) AS {c}" for c in self.money]
        body = self.sql.strip()
        if casts:
            body = f"SELECT * REPLACE ({', '.join(casts)}) FROM (\n{body}\n)"
        return with_shapes(body)


def plain(df: DataFrame) -> DataFrame:
    """Dates as ISO text and decimals as double, so both engines print values alike."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            column = column.cast("string").alias(field.name)
        elif isinstance(field.dataType, DecimalType):
            column = column.cast("double").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def with_shapes(body: str) -> str:
    """Prefix a query with the shapes it names, in definition order."""
    wanted: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name in SHAPES_SQL:
            if name not in wanted and re.search(rf"\b{name}\b", text):
                wanted.add(name)
                pending.append(SHAPES_SQL[name])
    if not wanted:
        return body
    if body.startswith("WITH"):
        body = f"SELECT * FROM (\n{body}\n)"
    ctes = ",\n".join(f"{n} AS (\n{q.strip()}\n)" for n, q in SHAPES_SQL.items() if n in wanted)
    return f"WITH {ctes}\n{body}"
