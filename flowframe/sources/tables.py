"""Rows from queries over tables and document collections."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.functions.columns import as_col
from flowframe.plans.ordered import lists_of
from flowframe.plans.scratch import cut_lineage, path_exists

def sql_query_source(
    spark: SparkSession, query: str, tables: dict[str, DataFrame] | None = None, *, max_rows: int = 0
) -> DataFrame:
    """The result of a user's query; ``{name}`` in it stands for a given table.

    ``max_rows`` caps the result, 0 means all rows.
    """
    rows = spark.sql(query, **(tables or {}))
    return rows.limit(max_rows) if max_rows > 0 else rows


def jdbc_query_source(
    spark: SparkSession, url: str, query: str, *, max_rows: int = 0, options: dict[str, str] | None = None
) -> DataFrame:
    """A query sent to a database as it is.

    For a parallel read give ``partitionColumn``, ``lowerBound``, ``upperBound``
    and ``numPartitions`` in ``options``; the query then runs as a subquery. Without
    them, and without ``max_rows``, the read is refused: all rows would come
    through one task.
    """
    options = options or {}
    if "partitionColumn" not in options and max_rows <= 0:
        raise ValueError("give partitionColumn and its bounds, or max_rows")
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if "partitionColumn" in options:
        reader = reader.option("dbtable", f"({query}) rows_of")
    else:
        reader = reader.option("query", query)
    rows = reader.load()
    return rows.limit(max_rows) if max_rows > 0 else rows


def rows_or_list(df: DataFrame, order_by: list[str], *, list_rows: int | None = None, chunks: int | None = None) -> DataFrame:
    """The rows as they are, or as lists of ``list_rows`` rows in order: ``part`` 0, 1, ...

    One list of all rows would have to fit into one task, so the caller says how
    long a list may be.
    """
    if list_rows is None:
        return df
    lists = lists_of(df, [], order_by, F.struct(*df.columns), list_rows, chunks=chunks)
    return lists.withColumnRenamed("items", "payload")


def unseen_rows(df: DataFrame, seen: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose key is not in the table of seen keys; null is a key like any other."""
    named = seen.select(*[F.col(name).alias(f"__{name}") for name in key])
    same = F.lit(True)
    for name in key:
        same = same & F.col(name).eqNullSafe(F.col(f"__{name}"))
    return df.join(named, same, "left_anti")


def mark_seen(
    df: DataFrame, seen_path: str, key: list[str], deliver: Callable[[DataFrame], None] | None = None
) -> DataFrame:
    """Rows not read before; remembers them, so that the next call leaves them out.

    The fresh rows are written to the shared folder first. ``deliver`` gets them and
    runs before their keys are marked: if it fails, the next call gives them again
    (at least once). Without it the rows returned are marked already (at most once).
    """
    spark = df.sparkSession
    seen = spark.read.schema(df.select(*key).schema).parquet(seen_path) if path_exists(spark, seen_path) else None
    fresh = cut_lineage(df if seen is None else unseen_rows(df, seen, key))
    if deliver is not None:
        deliver(fresh)
    fresh.select(*key).distinct().write.mode("append").parquet(seen_path)
    return fresh


def document_query(
    df: DataFrame,
    document: str,
    *,
    equals: dict[str, str | int | float | bool] | None = None,
    exists: dict[str, bool] | None = None,
) -> DataFrame:
    """Documents (JSON text) whose fields have given values, or are (not) there.

    Without conditions all documents are found. Paths are dotted names.
    """
    kinds = {bool: "boolean", int: "bigint", float: "double", str: "string"}

    def fits(doc: Column) -> Column:
        test = F.lit(True)
        for path, value in (equals or {}).items():
            test = test & (F.try_variant_get(doc, f"$.{path}", kinds[type(value)]) == F.lit(value))
        for path, wanted in (exists or {}).items():
            there = F.try_variant_get(doc, f"$.{path}", "variant").isNotNull()
            test = test & (there if wanted else ~there)
        return test

    if not equals and not exists:
        return df
    # Inside the one-element array the document is parsed once for all conditions.
    return df.filter(F.exists(F.array(F.try_parse_json(F.col(document))), fits))


def document_update(
    df: DataFrame, document: str, changes: dict[str, str | int | float | bool | None], found: str | Column = "true"
) -> DataFrame:
    """The documents with top-level fields set, as after a read that marks what it read.

    Only rows for which ``found`` is true change; other fields, and documents that are
    no JSON objects, stay as they are.
    """
    fields = F.from_json(F.col(document), "map<string,variant>")
    pairs = [part for name, value in changes.items() for part in (F.lit(name), F.parse_json(F.lit(json.dumps(value))))]
    changed = F.to_json(F.map_concat(F.map_filter(fields, lambda name, _: ~name.isin(*changes)), F.create_map(*pairs)))
    return df.withColumn(document, F.when(as_col(found), F.coalesce(changed, F.col(document))).otherwise(F.col(document)))


def document_rows(
    df: DataFrame, columns: list[str] | None = None, *, group_by: list[str] | None = None,
    order_by: list[str] | None = None, list_rows: int | None = None, chunks: int | None = None,
) -> DataFrame:
    """Rows as JSON messages: one object per row, or arrays of ``list_rows`` objects per group, ``part`` 0, 1, ..."""
    body = F.struct(*(columns or df.columns))
    json_type = F.create_map(F.lit("contentType"), F.lit("application/json")).alias("headers")
    if group_by is None:
        return df.select(F.to_json(body).alias("payload"), json_type)
    if list_rows is None:
        raise ValueError("say how many objects an array may hold")
    lists = lists_of(df, group_by, order_by or [], body, list_rows, chunks=chunks)
    return lists.select(*group_by, "part", F.to_json("items").alias("payload"), json_type)
