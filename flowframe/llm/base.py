"""What the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.plans.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the folder that all executors share."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns whose names an operator's results take (any case)."""
    taken = {name.lower() for name in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def fold(text: str | Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    text = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())


def pieces(total: int, each: int) -> int:
    """How many parts of about ``each`` hold ``total``."""
    return max(1, -(-total // each))
