"""Table sinks: which columns a row gets, how rows are batched, and upserts."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.functions.columns import as_col
from flowframe.functions.settings import parse_column_map
from flowframe.operators.aggregate import aggregate
from flowframe.plans.ordered import number_groups
from flowframe.plans.scratch import cut_lineage

# The default mapping, and the type of columns made by default.
DEFAULT_COLUMNS = "payload: string(payload)"
DEFAULT_TYPE = "VARCHAR(2000)"

# How an ISO date begins, and the text form of a UUID.
ISO_DATE = r"^\d{4}-\d{2}"
UUID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def _resolves(df: DataFrame, expression: str | Column) -> bool:
    """Whether Spark can make sense of the expression on this frame."""
    names = {name.lower() for name in df.columns}
    if isinstance(expression, str) and re.fullmatch(r"[A-Za-z_]\w*", expression) and expression.lower() not in names:
        return False
    try:
        return bool(df.select(as_col(expression)).columns)
    except AnalysisException:
        return False


def tried_casts(expression: str) -> str:
    """The expression with ``try_cast`` for ``cast``, outside of quoted text."""
    parts = re.split(r"('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`)", expression)
    return "".join(p if k % 2 else re.sub(r"(?i)(?<![\w.])cast(?=\s*\()", "try_cast", p) for k, p in enumerate(parts))


def column_map_insert(
    df: DataFrame,
    columns: str | dict[str, str | Column] = DEFAULT_COLUMNS,
    *,
    payload_type: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """The rows to insert: one column per ``column:expression`` of the mapping.

    An expression is tried as it is written, then with ``payload.`` in front, and
    the first value that is not null counts, row by row; what resolves neither way
    is null. If both resolve with different types the column is text, so that either
    value can stand in it. ``payload_type`` is the declared type of a JSON text payload,
    whose fields the mapping may then name. Casts in the mapping's text are tried casts:
    a value that does not fit is null and fails no other row.
    """
    rows = df
    if payload_type is not None:
        rows = rows.withColumn("payload", F.from_json(F.col("payload"), payload_type))
    mapping = parse_column_map(columns) if isinstance(columns, str) else columns
    chosen = [F.col(name) for name in keep or []]
    for name, expression in mapping.items():
        candidates = [expression] if isinstance(expression, Column) else [
            tried_casts(c) for c in (expression, *([] if expression.startswith("payload") else [f"payload.{expression}"]))
        ]
        fits = [as_col(c) for c in candidates if _resolves(rows, c)]
        if len({rows.select(fit).dtypes[0][1] for fit in fits}) > 1:
            fits = [fit.cast("string") for fit in fits]
        chosen.append((F.coalesce(*fits) if fits else F.lit(None).cast("string")).alias(name))
    return rows.select(*chosen)


def jdbc_write(
    df: DataFrame, url: str, table: str, *, batch_rows: int = 1, writers: int | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Append rows to a database table, ``batch_rows`` per statement, ``writers`` connections at most."""
    rows = df if writers is None else df.repartition(writers)
    rows.write.format("jdbc").option("url", url).option("dbtable", table).option(
        "batchsize", batch_rows
    ).options(**(options or {})).mode("append").save()


def table_init(
    spark: SparkSession, table: str, columns: list[str] | dict[str, str], *, location: str | None = None,
    using: str = "parquet",
) -> None:
    """Drop the table if it is there and make it anew; untyped columns are text of 2000."""
    types = columns if isinstance(columns, dict) else {name: DEFAULT_TYPE for name in columns}
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    body = ", ".join(f"`{name}` {kind}" for name, kind in types.items())
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {table} ({body}) USING {using}{place}")


def table_script(spark: SparkSession, script: str) -> None:
    """Run a user's set-up script: SQL statements, each ended by a semicolon at the end of a line."""
    for statement in re.split(r";[ \t]*(?:\n|$)", script):
        if statement.strip():
            spark.sql(statement)


def table_append(df: DataFrame, table: str) -> None:
    """Append rows to a table by column name, as text where the table says so."""
    target = df.sparkSession.table(table).schema
    df.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in target]).write.insertInto(table)


def jdbc_table_init(
    df: DataFrame, url: str, table: str, *, column_types: str | None = None, options: dict[str, str] | None = None
) -> None:
    """Drop and make a database table for these columns; each is text of 2000 unless typed."""
    types = column_types
    rows = df.limit(0)
    if types is None:
        rows = rows.select(*[F.col(name).cast("string").alias(name) for name in df.columns])
        types = ", ".join(f"{name} {DEFAULT_TYPE}" for name in df.columns)
    rows.write.format("jdbc").option("url", url).option("dbtable", table).option(
        "createTableColumnTypes", types
    ).options(**(options or {})).mode("overwrite").save()


def batch_flush(
    df: DataFrame,
    order_by: list[str],
    *,
    batch_rows: int,
    idle: str | None = None,
    time: str | None = None,
    kind: str | Column = "'all'",
    payload: str | Column = "payload",
    chunks: int | None = None,
) -> DataFrame:
    """The batches a buffering sink writes: full ones, and what an idle time leaves.

    ``kind`` keeps payload types apart. Without an idle time the last batch of a
    kind is still written, as the input ends there.
    """
    return aggregate(
        df, {"kind": kind}, order_by, payload=payload, count=batch_rows, gap=idle, time=time,
        partial=True, chunks=chunks,
    )


def json_ingest_rows(
    df: DataFrame,
    row_type: str,
    *,
    payload: str = "payload",
    names: dict[str, str] | None = None,
    dates: list[str] | None = None,
    uuids: list[str] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of JSON payloads: an array of objects, or one object, per message.

    ``row_type`` declares the columns in order; a key that is missing is null.
    ``names`` maps a column to the JSON key it is bound to. Text columns in
    ``dates`` become dates if they are ISO dates (a time after it is left off);
    those in ``uuids`` must have the form of a UUID; else the value is null.
    """
    fields = _declared(df.sparkSession, row_type)
    bound = names or {}
    keyed = ", ".join(f"`{bound.get(name, name)}` {kind}" for name, kind in fields)
    text = F.col(payload)
    as_list = F.when(F.ltrim(text).startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    rows = df.select(
        *(keep or []), F.explode(F.from_json(as_list, f"array<struct<{keyed.replace('` ', '`:')}>>")).alias("__row")
    )
    columns = []
    for name, _ in fields:
        value = F.col("__row")[bound.get(name, name)]
        if name in (dates or []):
            value = F.when(value.rlike(ISO_DATE), value.try_cast("date"))
        elif name in (uuids or []):
            value = F.when(value.rlike(UUID), F.lower(value))
        columns.append(value.alias(name))
    return rows.select(*(keep or []), *columns)


def _declared(spark: SparkSession, row_type: str) -> list[tuple[str, str]]:
    from pyspark.sql.types import StructType

    return [(field.name, field.dataType.simpleString()) for field in StructType.fromDDL(row_type).fields]


def table_upsert(
    table: DataFrame,
    changes: DataFrame,
    key: list[str],
    order_by: list[str],
    *,
    update_only: bool = False,
    ttl: str | None = None,
    written_at: str | Column | None = None,
) -> DataFrame:
    """The table after the changes: per key the last change, else the old row.

    ``update_only`` keeps out keys that are new. With ``ttl`` each changed row
    gets ``expires_at``; old rows carry theirs. The changes of a key are combined
    per task before the shuffle.
    """
    rest = [name for name in table.columns if name not in key and name != "expires_at"]
    fresh = changes
    if ttl is not None:
        fresh = fresh.withColumn("expires_at", as_col(written_at) + F.expr(f"interval {ttl}"))
        rest.append("expires_at")
        if "expires_at" not in table.columns:
            kind = dict(fresh.dtypes)["expires_at"]
            table = table.withColumn("expires_at", F.lit(None).cast(kind))
    fresh = fresh.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order_by)).alias("__new"))
    old = table.select(*key, F.struct(*rest).alias("__old"))
    merged = old.join(fresh, key, "left" if update_only else "full")
    return merged.select(
        *key, *[F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(f"__old.{c}")).alias(c) for c in rest]
    )


#: The column that names a row's bucket in a bucketed table's folders.
BUCKET = "bucket_no"


def bucket_of(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def create_buckets(rows: DataFrame, path: str, key: list[str], buckets: int) -> None:
    """Store a table in folders by a hash of its key, for ``upsert_buckets``."""
    rows.withColumn(BUCKET, bucket_of(key, buckets)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)


def upsert_buckets(
    spark: SparkSession, path: str, changes: DataFrame, key: list[str], order_by: list[str], buckets: int, **options
) -> int:
    """Apply changes to a table of ``create_buckets``; gives the number of buckets that were rewritten.

    Only folders with changes are read, merged as by ``table_upsert`` (whose ``options``
    these are) and replaced, each as a whole when the job commits; others keep their files.
    Changes that would make the same rows again rewrite a bucket without harm, so a run
    that was lost can be repeated. ``buckets`` must be the number the table was made with.
    """
    fresh = cut_lineage(changes.withColumn(BUCKET, bucket_of(key, buckets)))
    # At most as many numbers as there are buckets.
    touched = [row[0] for row in fresh.select(BUCKET).distinct().collect()]
    if not touched:
        return 0
    table = spark.read.parquet(path).filter(F.col(BUCKET).isin(*touched))
    merged = table_upsert(table.drop(BUCKET), fresh.drop(BUCKET), key, order_by, **options)
    placed = merged.withColumn(BUCKET, bucket_of(key, buckets)).repartition(BUCKET)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    return len(touched)


def live_rows(table: DataFrame, now: str | Column) -> DataFrame:
    """The rows whose time to live is not over."""
    return table.filter(F.col("expires_at").isNull() | (F.col("expires_at") > as_col(now)))


def flush_numbers(df: DataFrame, order_by: list[str], batch_rows: int, *, kind: str = "kind",
                  chunks: int | None = None) -> DataFrame:
    """Tag each row with the number of the batch it is written in."""
    placed = number_groups(df, [kind], order_by, count=batch_rows, chunks=chunks)
    number = F.floor((F.col("position") - 1) / batch_rows).cast("bigint")
    return placed.withColumn("batch_no", number).drop("position", "group_start", "group_pos")
