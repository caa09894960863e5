"""Where each row goes: documents, objects, collections, topics, queues, logs."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.functions.columns import as_col, fixed_or_expr
from flowframe.functions.patterns import simple_pattern

# The headers that route a document.
INDEX_ID = "INDEX_ID"
INDEX_NAME = "INDEX_NAME"


def index_route(
    df: DataFrame,
    index: str,
    *,
    doc_id: str | Column | None = None,
    routing: str | Column | None = None,
) -> DataFrame:
    """Add the document's ``index``, ``id`` and body ``doc``.

    Headers win over the configured index and the id expression; without either
    the id is null and the store chooses one. Text and map payloads are
    documents; any other payload has no body.
    """
    kind = dict(df.dtypes)["payload"]
    if kind == "string":
        body = F.col("payload")
    elif kind.startswith(("map", "struct")):
        body = F.to_json("payload")
    else:
        body = F.lit(None).cast("string")
    own_id = F.lit(None).cast("string") if doc_id is None else as_col(doc_id).cast("string")
    rows = df.withColumn("index", F.coalesce(F.col("headers")[INDEX_NAME], F.lit(index)))
    rows = rows.withColumn("id", F.coalesce(F.col("headers")[INDEX_ID], own_id)).withColumn("doc", body)
    return rows if routing is None else rows.withColumn("routing", as_col(routing).cast("string"))


def last_documents(df: DataFrame, order_by: list[str]) -> DataFrame:
    """What the index holds at the end: the last write per (index, id); rows without an id all stay."""
    rest = [name for name in df.columns if name not in ("index", "id")]
    named = df.filter(F.col("id").isNotNull()).groupBy("index", "id").agg(
        F.max_by(F.struct(*rest), F.struct(*order_by)).alias("__last")
    )
    unnamed = df.filter(F.col("id").isNull()).select("index", "id", F.struct(*rest).alias("__last"))
    return named.unionByName(unnamed).select("index", "id", "__last.*")


def bulk_write(
    df: DataFrame, write: Callable[[], Callable[[pa.RecordBatch], list[str | None]]], *, batch_rows: int = 1000
) -> DataFrame:
    """Send rows in bulk from each task; gives one (index, id, error) row per item.

    ``write`` is called once per task and returns a function from a record batch with
    ``index``, ``id``, ``doc`` and, where the frame has it, ``routing`` to a list of
    error texts (None where an item went well). A timeout is the client's own setting.
    """
    sent = ["index", "id", "doc", *(["routing"] if "routing" in df.columns else [])]

    def send(batches):
        import pyarrow as pa

        bulk = write()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                part = batch.slice(start, batch_rows)
                errors = pa.array(bulk(part), pa.string())
                yield pa.RecordBatch.from_arrays([part.column("index"), part.column("id"), errors], names=["index", "id", "error"])

    return df.select(*sent).mapInArrow(send, "index string, id string, error string")


def bulk_result_check(
    results: DataFrame, bulk: list[str], order_by: list[str], *, error: str = "error"
) -> DataFrame:
    """The bulk requests that failed: items, failed items and the joined message.

    ``bulk`` names the request an item was sent in; requests are small, so the
    errors of one fit into a row. The message joins the error of every item in
    order with `` : ``; items that went well add an empty text.
    """
    item = F.struct(*order_by, F.coalesce(F.col(error), F.lit("")).alias("__text"))
    requests = results.groupBy(*bulk).agg(
        F.count(F.lit(1)).alias("items"),
        F.count(error).alias("failed"),
        F.sort_array(F.collect_list(item)).alias("__all"),
    ).filter(F.col("failed") > 0)
    texts = F.transform("__all", lambda one: one["__text"])
    return requests.select(*bulk, "items", "failed", F.array_join(texts, " : ").alias("message"))


class BulkError(RuntimeError):
    """A bulk request with failed items; ``table`` holds the message of every request that failed."""

    def __init__(self, requests: int, items: int, first: str, table: str):
        super().__init__(f"{items} items of {requests} bulk requests failed, all of them in {table}: {first}")
        self.requests, self.items, self.table = requests, items, table


def raise_bulk_errors(requests: DataFrame, path: str) -> None:
    """Fail if any request did: takes the rows of ``bulk_result_check`` and writes them all to ``path`` first."""
    requests.write.mode("overwrite").parquet(path)
    failed = requests.sparkSession.read.schema(requests.schema).parquet(path)
    totals = failed.agg(F.count(F.lit(1)).alias("n"), F.sum("failed").alias("items"), F.min("message").alias("first")).first()
    if totals["n"]:
        raise BulkError(totals["n"], totals["items"], totals["first"], path)


def with_suffix(name: Column, suffix: str | None) -> Column:
    """The file name with its suffix; the dot is added if it is missing."""
    if not suffix:
        return name
    return F.concat(name, F.lit(suffix if suffix.startswith(".") else f".{suffix}"))


def file_write(
    df: DataFrame,
    *,
    directory: str | None = None,
    directory_expr: str | Column | None = None,
    name: str | None = None,
    name_expr: str | Column | None = None,
    suffix: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """What is written where: ``dir``, ``file`` and the text or bytes ``content``."""
    return df.select(
        *(keep or []),
        fixed_or_expr(directory, directory_expr, "directory").cast("string").alias("dir"),
        with_suffix(fixed_or_expr(name, name_expr, "file name").cast("string"), suffix).alias("file"),
        F.col("payload").alias("content"),
    )


def write_partitioned(
    df: DataFrame, path: str, by: list[str], *, content: str = "content", mode: str = "append",
    files_each: int | None = None, share_by: str | Column | None = None, line_end: str = "\n",
) -> None:
    """Write records under one folder per destination, as lines of UTF-8.

    ``mode`` is what to do with what is there: append, overwrite, ignore or error.
    Each record ends with ``line_end``; bytes as they are, exact names, other charsets
    and metadata go through ``write_objects``. Without ``files_each`` nothing is shuffled and each task writes
    a file per destination it meets. With it the rows of a destination are first
    brought into that many shares, for few files; a large destination needs several.
    ``share_by`` (the content unless given) should differ between its rows.
    """
    if dict(df.dtypes)[content] == "binary":
        raise ValueError("write bytes with write_objects: lines would change them")
    rows = df.select(
        *by, F.col(content).cast("string").alias("value"),
        *([] if share_by is None else [as_col(share_by).alias("__share_by")]),
    )
    if files_each is not None:
        share = F.pmod(F.xxhash64("value" if share_by is None else "__share_by"), F.lit(files_each))
        rows = rows.withColumn("__share", share).repartition(*by, "__share")
    rows.select(*by, "value").write.partitionBy(*by).mode(mode).option("lineSep", line_end).text(path)


def object_write(
    df: DataFrame,
    *,
    bucket: str | None = None,
    bucket_expr: str | Column | None = None,
    key_expr: str | Column,
    acl: str | None = None,
    acl_expr: str | Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Object store writes: ``bucket``, ``key``, ``acl`` and ``content``; a null ACL is an error."""
    if acl is not None and acl_expr is not None:
        raise ValueError("give a fixed ACL or an ACL expression, not both")
    if acl_expr is not None:
        access = F.coalesce(
            as_col(acl_expr).cast("string"), F.raise_error(F.lit("the ACL must not be null")).cast("string")
        )
    else:
        access = F.lit(acl).cast("string")
    return df.select(
        *(keep or []),
        fixed_or_expr(bucket, bucket_expr, "bucket").cast("string").alias("bucket"),
        as_col(key_expr).cast("string").alias("key"),
        access.alias("acl"),
        F.col("payload").alias("content"),
    )


def collection_write(
    df: DataFrame,
    *,
    collection: str | None = None,
    collection_expr: str | Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """The collection each document is stored in, with the document as JSON text."""
    kind = dict(df.dtypes)["payload"]
    body = F.to_json("payload") if kind.startswith(("struct", "map", "array")) else F.col("payload")
    return df.select(
        *(keep or []),
        fixed_or_expr(collection, collection_expr, "collection").cast("string").alias("collection"),
        body.alias("doc"),
    )


def record_publish(
    df: DataFrame,
    *,
    topic: str | None = None,
    topic_expr: str | Column | None = None,
    key: str | None = None,
    key_expr: str | Column | None = None,
    partition: int | None = None,
    partition_expr: str | Column | None = None,
    timestamp_expr: str | Column | None = None,
    header_patterns: list[str] | None = None,
) -> DataFrame:
    """Rows for Spark's record writer: topic, key, value, partition, headers.

    An expression wins over a fixed value. Headers are filtered by name patterns
    and carried as UTF-8; the writer knows no record time, so a timestamp goes
    to the header ``timestamp``.
    """

    def pick(fixed, expression, kind) -> Column:
        value = F.lit(fixed).cast(kind)
        return value if expression is None else F.coalesce(as_col(expression).cast(kind), value)

    any_of = "|".join(simple_pattern(pattern) for pattern in header_patterns or ["*"])
    kept = F.map_filter("headers", lambda name, _: name.rlike(any_of))
    entries = F.array_sort(F.map_entries(kept))
    headers = F.transform(
        entries, lambda one: F.struct(one["key"].alias("key"), F.encode(one["value"], "UTF-8").alias("value"))
    )
    if timestamp_expr is not None:
        stamp = F.encode(as_col(timestamp_expr).cast("string"), "UTF-8")
        headers = F.concat(headers, F.array(F.struct(F.lit("timestamp").alias("key"), stamp.alias("value"))))
    return df.select(
        pick(topic, topic_expr, "string").alias("topic"),
        pick(key, key_expr, "string").alias("key"),
        F.col("payload").alias("value"),
        pick(partition, partition_expr, "int").alias("partition"),
        headers.alias("headers"),
    )


def kafka_write(df: DataFrame, servers: str, options: dict[str, str] | None = None) -> None:
    """Publish the rows of ``record_publish``. Needs Spark's connector jar."""
    df.write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "includeHeaders", "true"
    ).options(**(options or {})).save()


def route_project(
    df: DataFrame,
    *,
    kind: str,
    dest: str | None = None,
    dest_expr: str | Column | None = None,
    routing_key: str | None = None,
    routing_key_expr: str | Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``dest_kind``, ``dest`` and ``routing_key``.

    An exchange takes a routing key, fixed or computed; a key, queue or topic
    takes exactly one of a name and an expression.
    """
    if kind == "exchange":
        if routing_key is None and routing_key_expr is None:
            raise ValueError("an exchange needs a routing key or an expression for it")
        place = as_col(dest_expr) if dest_expr is not None else F.lit(dest or "")
        route = as_col(routing_key_expr) if routing_key_expr is not None else F.lit(routing_key)
    elif kind in ("key", "queue", "topic"):
        place, route = fixed_or_expr(dest, dest_expr, kind), F.lit(None)
    else:
        raise ValueError(f"'{kind}' is not one of exchange, key, queue and topic")
    return df.select(
        *(keep or []),
        F.lit(kind).alias("dest_kind"),
        place.cast("string").alias("dest"),
        route.cast("string").alias("routing_key"),
        F.col("payload").alias("content"),
    )


# The log levels.
LEVELS = ("FATAL", "ERROR", "WARN", "INFO", "DEBUG", "TRACE")


def log_write(
    df: DataFrame, expression: str | Column = "payload", *, level: str = "INFO", name: str = "log",
    keep: list[str] | None = None,
) -> DataFrame:
    """Log lines: level, logger name and the text of an expression."""
    if level.upper() not in LEVELS:
        raise ValueError(f"'{level}' is not a log level")
    return df.select(
        *(keep or []),
        F.lit(level.upper()).alias("level"),
        F.lit(name).alias("logger"),
        as_col(expression).cast("string").alias("text"),
    )


def write_log(lines: DataFrame) -> None:
    """Log the rows of ``log_write`` where they are, in the tasks, on the workers' error stream.

    The logger takes the level of the lines, so that every line appears at any level.
    """

    def log(batches):
        import logging
        import sys

        numbers = {"FATAL": 50, "TRACE": 5}
        shown = logging.StreamHandler(sys.stderr)
        shown.setFormatter(logging.Formatter("%(levelname)s %(name)s %(message)s"))
        for batch in batches:
            for level, name, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                logger = logging.getLogger(f"flowframe.lines.{name}")
                if not logger.handlers:
                    logger.addHandler(shown)
                    logger.propagate = False
                    logger.setLevel(1)
                logger.log(numbers.get(level) or logging.getLevelName(level), text)
            yield batch.slice(0, 0)

    lines.select("level", "logger", "text").mapInArrow(log, "level string, logger string, text string").write.format("noop").mode("overwrite").save()
