"""Regroup the messages of a stream batch by batch, a key of any size spread over tasks.

Each micro-batch is numbered like a batch frame (``plans.ordered``), so one key's share of
it is cut into chunks. What a key carries on is one small row: how many messages it had, how
many of them are in its open group, and when that group would time out. Messages are written
as they come, each with the group it belongs to; a group that is open at the end of a batch
simply goes on in the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.operators.aggregate import Release, prepare
from flowframe.plans.ordered import number_groups
from flowframe.plans.scratch import path_exists


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    other = right.select(*[F.col(c).alias(f"__{c}" if c in keys else c) for c in right.columns])
    same = F.lit(True)
    for name in keys:
        same = same & F.col(name).eqNullSafe(F.col(f"__{name}"))
    return left.join(other, same, how).drop(*(f"__{name}" for name in keys))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _drop(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def regroup_each(
    path: str, correlate: dict[str, str | Column], order_by: list[str], *, payload: str | Column = "payload", count: int | None = None,
    closes: str | Column | None = None, gap: str | Column | None = None, time: str | None = None, chunks: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """A batch function that writes under ``path`` each message with its ``position`` in its key, ``group_start`` and ``group_pos``.

    The release rules are those of ``aggregate``. Within a batch messages are taken in
    ``order_by``; those of a later batch come after all before. A batch that is run again
    reads the same state and overwrites its own folders only. The state is one row per
    key, written anew with each batch; the two before are kept.
    """
    rule = Release(count=count, closes=closes, gap=gap, time=time)
    keys, place = list(correlate), path.rstrip("/")

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = prepare(batch, correlate, order_by, rule, payload=payload)
        told = F.col("__gap") if isinstance(gap, Column) else gap
        numbered = number_groups(
            rows, keys, order_by, closes="__ends" if closes is not None else None, gap=told, time=time, chunks=chunks
        )
        ends = F.col("__ends") if closes is not None else F.lit(False)
        at = F.col(time).cast("timestamp") if time is not None else F.lit(None).cast("timestamp")
        due = (at + (F.expr(f"interval {gap}") if isinstance(gap, str) else told)) if gap is not None else F.lit(None).cast("timestamp")
        light = numbered.select(
            *keys, "position", F.col("group_start").alias("segment"), F.col("__payload").alias("payload"), ends.alias("__last"), at.alias("__at"), due.alias("__due")
        )
        stored = _stored(light, f"{place}/work/batch={batch_id}/numbered")
        last = F.max_by(F.struct("position", "segment", "__last", "__due"), "position")
        facts = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min_by("__at", "position").alias("first_at"), last.alias("last"))
        before = f"{place}/state/batch={batch_id - 1}"
        kinds = ", ".join(f"`{name}` {stored.schema[name].dataType.simpleString()}" for name in keys)
        schema = f"{kinds}, total bigint, open bigint, due timestamp"
        state = spark.read.schema(schema).parquet(before) if batch_id and path_exists(spark, before) else spark.createDataFrame([], schema)
        known = _same(facts, state, keys, "left")
        zero = F.lit(0).cast("bigint")
        goes_on = F.coalesce(F.col("first_at") <= F.col("due"), F.lit(True)) if gap is not None else F.lit(True)
        known = known.select(
            *keys, "n", "last", F.coalesce("total", zero).alias("total"), F.when(goes_on, F.coalesce("open", zero)).otherwise(zero).alias("open")
        )
        known = _stored(known, f"{place}/work/batch={batch_id}/known")

        def since(position: Column, segment: Column) -> Column:
            """How many messages of the segment came before, in this batch and earlier."""
            return position - segment + F.when(segment == 1, F.col("open")).otherwise(zero)

        placed = _same(stored, known.select(*keys, "total", "open"), keys, "inner")
        earlier = since(F.col("position"), F.col("segment"))
        group_pos = (earlier % count if count is not None else earlier) + 1
        whole = F.col("total") + F.col("position")
        messages = placed.select(*keys, whole.alias("position"), (whole - group_pos + 1).alias("group_start"), group_pos.alias("group_pos"), "payload")
        messages.write.mode("overwrite").parquet(f"{place}/messages/batch={batch_id}")

        held = since(F.col("last.position"), F.col("last.segment")) + 1
        held = F.when(F.col("last.__last"), zero).otherwise(held % count if count is not None else held)
        touched = known.select(*keys, (F.col("total") + F.col("n")).alias("total"), held.alias("open"), F.col("last.__due").alias("due"))
        left = _same(state, touched.select(*keys), keys, "left_anti")
        left.unionByName(touched).write.mode("overwrite").parquet(f"{place}/state/batch={batch_id}")
        _drop(spark, f"{place}/work/batch={batch_id}")
        if batch_id > 2:
            _drop(spark, f"{place}/state/batch={batch_id - 3}")

    return each


def read_regrouped(spark: SparkSession, path: str, keys: list[str], *, partial: bool = False) -> DataFrame:
    """The messages of the groups released so far, each with its group's ``n``; with ``partial`` of the open ones too."""
    place = path.rstrip("/")
    rows = spark.read.parquet(f"{place}/messages").drop("batch")
    sizes = rows.groupBy(*keys, "group_start").agg(F.count(F.lit(1)).alias("n"))
    if not partial:
        states = spark.read.parquet(f"{place}/state")
        last = states.select(F.max("batch").alias("newest"))
        now = states.join(F.broadcast(last), F.col("batch") == F.col("newest")).select(*keys, (F.col("total") - F.col("open")).alias("released"))
        sizes = _same(sizes, now, keys, "inner").filter(F.col("group_start") <= F.col("released")).drop("released")
    return _same(rows.select(*keys, "group_start", "position", "payload"), sizes, [*keys, "group_start"], "inner")
