"""A training corpus from raw documents: known languages, no copies, no near copies, packed.

Each stage takes what the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.llm.base import table, written
from flowframe.llm.exact_dedup import exact_dedup
from flowframe.llm.jaccard_join import jaccard_groups
from flowframe.llm.language import identify, learn, learnable
from flowframe.llm.packing import pack
from flowframe.llm.queries import SEQUENCES

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier tells; it learns from the labelled ones among them."""
    return identify(docs, learn(docs.filter(learnable()))).filter("not rejected").select(docs.columns)


def one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup(docs).filter("kept").select(docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that links connect the one with the smallest id, null ids last, and of equal ids the smallest row hash.

    Rows are told apart by id and hash, not by the id alone, so ids may be null or repeated.
    Of rows that are equal in all columns one stays; rows without a word all stay.
    """
    columns = docs.columns
    whole = F.xxhash64(*(F.col(f"`{c}`") for c in columns), *(F.col(f"`{c}`").isNull() for c in columns))
    key = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), whole.alias("row"))
    rows = docs.withColumn("__row", key)
    groups = jaccard_groups(rows, doc_id="__row").filter("class is not null")
    judged = groups.groupBy("__row").agg(F.max(F.col("component_id") != F.col("__row")).alias("dropped"), F.count(F.lit(1)).alias("n"))
    judged = written(judged.filter("dropped or n > 1"), "near-copies")
    kept = rows.join(judged.select("__row"), "__row", "left_anti").select(columns)
    equal = judged.filter("not dropped").select("__row")
    if equal.isEmpty():
        return kept
    return kept.union(rows.join(equal, "__row", "left_semi").dropDuplicates(["__row"]).select(columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return pack(docs, F.length("text"), capacities=SEQUENCES)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("exact_dedup", one_of_copies),
    ("near_dedup", one_of_near_copies),
    ("packing", packed),
]

#: Compression and packing have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
