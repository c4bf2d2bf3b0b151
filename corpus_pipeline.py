"""From raw documents to packed training sequences: five stages, each with an operator of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.contamination import drop_leaks
from tallybook.llm.exact import drop_exact_duplicates
from tallybook.llm.frames import read_table, stored
from tallybook.llm.packing import pack_pieces, token_pieces
from tallybook.llm.quality import keep_quality
from tallybook.llm.queries import tokenizer_path
from tallybook.llm.setjoin import drop_similar


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return keep_quality(docs, read_table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of the largest id."""
    return drop_exact_duplicates(docs)


def similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts, that of the smallest id."""
    return drop_similar(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    pieces = token_pieces(docs, tokenizer_path())
    return pack_pieces(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("quality", quality),
    ("exact", exact),
    ("similar", similar),
    ("decontaminated", decontaminated),
    ("packed", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: A fitted classifier and an online packing have no SQL; tests compare with brute force.
ORACLE_SQL = None
