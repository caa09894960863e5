"""Streaming sources, sinks and the smaller stateful operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery


def file_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    *,
    schema: str | None = None,
    glob: str | None = None,
    max_files: int | None = None,
    clean: str | None = None,
    archive_dir: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """New files of a folder; the checkpoint remembers what was read.

    ``clean`` is what happens to a file after it was read: ``delete``, or
    ``archive`` into ``archive_dir``; nothing without it. ``max_files`` caps a poll.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if clean is not None:
        reader = reader.option("cleanSource", clean)
        if clean == "archive":
            reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.load(path)


def run_available(
    df: DataFrame,
    checkpoint: str,
    *,
    each: Callable[[DataFrame, int], None] | None = None,
    path: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Process what is there now, then stop: into ``each`` batch function or parquet files."""
    query = run_polling(df, checkpoint, each=each, path=path, mode=mode)
    query.awaitTermination()
    return query


def run_polling(
    df: DataFrame,
    checkpoint: str,
    *,
    interval: str | None = None,
    each: Callable[[DataFrame, int], None] | None = None,
    path: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Start a query that polls its source once per ``interval`` until stopped; without one it takes what is there."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    writer = df.writeStream.option("checkpointLocation", checkpoint).outputMode(mode).trigger(**trigger)
    return writer.foreachBatch(each).start() if each is not None else writer.format("parquet").start(path)


def stream_dedup(df: DataFrame, key: list[str], *, time: str | None = None, delay: str | None = None) -> DataFrame:
    """First record per key. With a ``delay`` keys are forgotten once the watermark has passed them."""
    if delay is None:
        return df.dropDuplicates(key)
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def latest_by_key(df: DataFrame, key: list[str], order_by: list[str]) -> DataFrame:
    """The last row per key so far, held in Spark's state store: one row per key, combined in each task first.

    In update mode a batch gives the keys it touched: write them with ``changes_each``.
    """
    return _picked(df, key, F.max_by, order_by)


def first_by_key(df: DataFrame, key: list[str], order_by: list[str]) -> DataFrame:
    """The first row per key so far, in the same way as ``latest_by_key``."""
    return _picked(df, key, F.min_by, order_by)


def _picked(df: DataFrame, key: list[str], pick, order_by: list[str]) -> DataFrame:
    rest = [name for name in df.columns if name not in key]
    chosen = df.groupBy(*key).agg(pick(F.struct(*rest), F.struct(*order_by)).alias("__row"))
    return chosen.select(*[F.col(name) if name in key else F.col(f"__row.{name}") for name in df.columns])


def changes_each(path: str) -> Callable[[DataFrame, int], None]:
    """A batch function that writes the rows an update touched, each batch to a folder of its own.

    A batch that is run again overwrites just its own folder; nothing older is read or written.
    """
    place = path.rstrip("/")

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{place}/batch={batch_id}")

    return each


def read_changes(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """The table that the written changes make: the row of the last batch per key."""
    rows = spark.read.parquet(path)
    rest = [name for name in rows.columns if name not in (*key, "batch")]
    last = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("__row"))
    return last.select(*key, "__row.*")


def accept_stream(df: DataFrame, key: str, modified: str, order_by: list[str]) -> DataFrame:
    """The listed files that are new, or changed since they were last accepted.

    Spark's state store keeps one time per file; a file's listings within a batch are
    taken in order. Rows come out whole.
    """
    schema = df.schema

    class Ledger(StatefulProcessor):
        """What a file's time was when it was last accepted."""

        def init(self, handle):
            self.seen = handle.getValueState("seen", T.StructType([T.StructField("modified", schema[modified].dataType)]))

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            batch = pd.concat(list(rows), ignore_index=True).sort_values(order_by, kind="stable")
            last = self.seen.get()[0] if self.seen.exists() else None
            # Pandas shows whole numbers next to nulls as floats.
            whole = isinstance(schema[modified].dataType, T.IntegralType)
            times = [None if pd.isna(x) else int(x) if whole else x for x in batch[modified].tolist()]
            before = [last, *times[:-1]]
            # A file's first listing counts even where its time is the null that stands for none.
            known = self.seen.exists()
            new = [not (known or i) or a != b for i, (a, b) in enumerate(zip(times, before, strict=True))]
            self.seen.update((times[-1],))
            yield batch[new]

        def close(self):
            pass

    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=Ledger(), outputStructType=schema, outputMode="append", timeMode="none"
    )
