"""Carry a state over the blocks of a key in a tree, so that no task follows a whole key.

Each block is a function of the state it is entered in. Functions of neighbouring blocks
are composed pairwise, 1, 2, 4, ... blocks at a time (up), then the state a span is entered
in gives those of its two halves (down). Each level is one shuffle of half as many rows.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.plans.scratch import scratch_path


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, to be read more than once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _rows(table: pa.Table) -> list[tuple[int, bytes]]:
    return sorted(zip(table["block"].to_pylist(), table["f"].to_pylist(), strict=True))


def _composed(compose: Callable[[bytes, bytes], bytes]):
    def pair(table: pa.Table) -> pa.Table:
        rows = _rows(table)
        f = rows[0][1] if len(rows) == 1 else compose(rows[0][1], rows[1][1])
        return pa.table([table["key"].slice(0, 1), pa.array([rows[0][0] >> 1], pa.int64()), pa.array([f], pa.binary())], names=["key", "block", "f"])

    return pair


def _halves(apply: Callable[[bytes, bytes], bytes]):
    def down(table: pa.Table) -> pa.Table:
        rows = _rows(table)
        state = table["state"][0].as_py()
        states = [state] if len(rows) == 1 else [state, apply(rows[0][1], state)]
        key = table["key"].take(pa.array([0] * len(rows)))
        return pa.table([key, pa.array([b for b, _ in rows], pa.int64()), pa.array(states, pa.binary())], names=["key", "block", "state"])

    return down


def _ended(apply: Callable[[bytes, bytes], bytes], start: bytes):
    def ended(batches):
        for batch in batches:
            states = [apply(f, start) for f in batch.column("f").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(states, pa.binary())], names=["key", "state"])

    return ended


def entering_states(
    functions: DataFrame, compose: Callable[[bytes, bytes], bytes], apply: Callable[[bytes, bytes], bytes], start: bytes
) -> tuple[DataFrame, DataFrame]:
    """The ``state`` each block is entered in, by ``key`` and ``block``, and the state each ``key`` ends in.

    ``functions`` is a stored frame of ``key`` (a struct), ``block`` (0, 1, ... without
    gaps) and ``f``, a block's function as bytes; ``compose(f, g)`` is f before g, and
    ``apply(f, state)`` a state behind. Keys of one block take no part in the levels.
    """
    spark, key = functions.sparkSession, f"key {functions.schema['key'].dataType.simpleString()}"
    large = functions.filter("block > 0").select(F.col("key").alias("large")).distinct()
    level = functions.join(large, F.col("key") == F.col("large"), "left_semi")
    single = functions.join(large, F.col("key") == F.col("large"), "left_anti")
    top = functions.agg(F.max("block")).first()[0] or 0
    at_start = F.lit(bytearray(start)).cast("binary").alias("state")
    states = single.select("key", "block", at_start)
    ends = single.mapInArrow(_ended(apply, start), f"{key}, state binary")
    if not top:
        return states, ends
    levels = [kept(level, "span")]
    while top:
        parent = levels[-1].withColumn("parent", F.shiftright("block", 1))
        levels.append(kept(parent.groupBy("key", "parent").applyInArrow(_composed(compose), f"{key}, block long, f binary"), "span"))
        top >>= 1
    ends = ends.unionByName(levels[-1].mapInArrow(_ended(apply, start), f"{key}, state binary"))
    entered = levels[-1].select("key", "block", at_start)
    for below in reversed(levels[:-1]):
        above = entered.select(F.col("key").alias("__key"), F.col("block").alias("__block"), "state")
        halves = below.join(above, (F.col("key") == F.col("__key")) & (F.shiftright("block", 1) == F.col("__block")))
        halves = halves.select("key", "block", "f", "state", F.shiftright("block", 1).alias("parent"))
        entered = halves.groupBy("key", "parent").applyInArrow(_halves(apply), f"{key}, block long, state binary")
    return states.unionByName(entered), ends
