"""Registry of wired queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.envelope import to_messages
from flowframe.plans.scratch import scratch_path
from flowframe.sinks.objects import write_objects
from flowframe.sinks.routes import write_partitioned

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages: the JSON text is the payload, two facts are headers."""
    return to_messages(
        table(spark, sf_dir, "events"),
        "props",
        headers={"contentType": "'application/json'", "kind": "event_type", "user-id": "user_id"},
        msg_id="event_id",
        msg_ts="ts",
        keep=["event_id", "user_id", "event_type", "value"],
    )


def flat_map(column: str | Column) -> Column:
    """A map as text ``k=v,k=v`` in key order, for comparing."""
    entries = F.array_sort(F.map_entries(column))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], F.coalesce(e["value"], F.lit("null")))), ",")


def joined(column: str | Column, by: str = ",") -> Column:
    """A list as text, for comparing."""
    return F.array_join(F.transform(column, lambda one: one.cast("string")), by, "null")


def document_files(spark: SparkSession, sf_dir: str, by: str) -> str:
    """The documents written as text files, one folder per value of ``by``."""
    path = scratch_path(spark, f"documents-by-{by}")
    docs = table(spark, sf_dir, "documents").select(by, F.col("text").alias("content"))
    write_partitioned(docs, path, [by])
    return path


def document_objects(spark: SparkSession, sf_dir: str) -> str:
    """The documents as files of their own, ``<lang>/<doc_id>.txt``, bytes as they are."""
    root = scratch_path(spark, "document-objects")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name")
    docs = table(spark, sf_dir, "documents").select("lang", name, F.col("text").alias("content"))
    write_objects(docs, root, ["lang", "name"])
    return root


def document_of(path: str | Column = "path") -> Column:
    """The document's id, from the name of its file."""
    return F.regexp_extract(path, r"/(?:done-)?(\d+)\.txt$", 1).cast("bigint")
