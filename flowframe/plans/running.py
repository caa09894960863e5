"""Groups that end when a running sum reaches a limit, and begin anew behind it.

Where such a group begins depends on all rows before it, so rows are cut into blocks, and
a block is a function of the open sum it is entered with: that sum decides at which of the
block's record highs the open group ends, and each row then knows by doubled pointers where
the last group begins that the block leaves open. ``plans.spans`` carries the open sum over
the blocks of a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.functions.columns import as_col
from flowframe.plans.ordered import number_groups
from flowframe.plans.spans import entering_states, kept

#: Rows of a block.
BLOCK = 8_192

# A function as bytes: three equal rows of integers - the open sums from which a step holds
# (ascending), the sum it leaves, and the row its open group begins at - behind the total
# that is added where no group ends.


def packed(total: int, steps: np.ndarray) -> bytes:
    return np.concatenate([[total], steps.ravel()]).astype("<i8").tobytes()


def unpacked(data: bytes) -> tuple[int, np.ndarray]:
    numbers = np.frombuffer(data, dtype="<i8")
    return int(numbers[0]), numbers[1:].reshape(3, -1)


def _fewer(steps: np.ndarray) -> np.ndarray:
    """Without steps that leave what the one below them leaves."""
    if steps.shape[1] < 2:
        return steps
    same = (steps[1:, 1:] == steps[1:, :-1]).all(axis=0)
    return steps[:, np.concatenate([[True], ~same])]


def next_starts(amounts: np.ndarray, limit: int) -> np.ndarray:
    """For a group begun at each row the row after its last, or one past the end if it stays open: ``len + 1``."""
    n = len(amounts)
    before = np.concatenate([[0], np.cumsum(amounts)])
    target = before[:-1] + limit
    # Highest sums over 1, 2, 4, ... rows; the first that reaches the target is found by halving.
    highest = [before[1:]]
    while 2 ** len(highest) <= n:
        last, step = highest[-1], 2 ** (len(highest) - 1)
        highest.append(np.maximum(last[: len(last) - step], last[step:]))
    at = np.arange(n)
    for power in range(len(highest) - 1, -1, -1):
        table = highest[power]
        inside = at < len(table)
        short = np.zeros(n, dtype=bool)
        short[inside] = table[at[inside]] < target[inside]
        at = np.where(short, at + 2**power, at)
    return np.where(at < n, at + 1, n + 1)


def left_open(following: np.ndarray) -> np.ndarray:
    """For each row, and the one past the end, the last start on the way of a group begun there."""
    n = len(following)
    starts = np.arange(n + 1)
    jump = np.concatenate([np.where(following <= n, following, np.arange(n)), [n]])
    while True:
        further = jump[jump]
        if (further == jump).all():
            return jump[starts]
        jump = further


def block_function(amounts: np.ndarray, limit: int, first: int) -> bytes:
    """How a block of rows that begins at position ``first`` turns an open sum into another."""
    before = np.concatenate([[0], np.cumsum(amounts)])
    total = int(before[-1])
    opens = left_open(next_starts(amounts, limit))
    highs = np.maximum.accumulate(before[1:]) if len(amounts) else before[1:]
    rising = np.flatnonzero(np.concatenate([[True], highs[1:] > highs[:-1]])) if len(amounts) else np.zeros(0, dtype=np.int64)
    # An open sum s ends its group at the first high h with s + h >= limit.
    ends = rising[::-1]
    begin = opens[ends + 1]
    steps = np.stack([limit - highs[ends], total - before[begin], first + begin])
    return packed(total, _fewer(steps))


def compose(f: bytes, g: bytes) -> bytes:
    """``f`` before ``g``: sums below f's first step go to g with f's total; each step of f leaves a sum for g."""
    total_f, steps_f = unpacked(f)
    total_g, steps_g = unpacked(g)
    shifted = steps_g.copy()
    shifted[0] -= total_f
    if steps_f.shape[1]:
        shifted = shifted[:, shifted[0] < steps_f[0, 0]]
    at = np.searchsorted(steps_g[0], steps_f[1], side="right") - 1
    hit = at >= 0
    after = steps_f.copy()
    after[1] = np.where(hit, steps_g[1][np.maximum(at, 0)] if steps_g.shape[1] else 0, steps_f[1] + total_g)
    after[2] = np.where(hit, steps_g[2][np.maximum(at, 0)] if steps_g.shape[1] else 0, steps_f[2])
    return packed(total_f + total_g, _fewer(np.concatenate([shifted, after], axis=1)))


def apply(f: bytes, state: bytes) -> bytes:
    """The open sum and the row its group begins at, behind a block."""
    total, steps = unpacked(f)
    held, start = (int(x) for x in np.frombuffer(state, dtype="<i8"))
    at = int(np.searchsorted(steps[0], held, side="right")) - 1
    new = (held + total, start) if at < 0 else (int(steps[1, at]), int(steps[2, at]))
    return np.array(new, dtype="<i8").tobytes()


def _functions(limit: int):
    def function(table: pa.Table) -> pa.Table:
        order = np.argsort(table["position"].to_numpy())
        amounts = table["amount"].to_numpy()[order]
        f = block_function(amounts, limit, int(table["position"].to_numpy().min()))
        return pa.table([table["key"].slice(0, 1), table["block"].slice(0, 1), pa.array([f], pa.binary())], names=["key", "block", "f"])

    return function


def _starts(limit: int):
    def starts(rows: pa.Table, state: pa.Table) -> pa.Table:
        order = np.argsort(rows["position"].to_numpy())
        place, amounts = rows["position"].to_numpy()[order], rows["amount"].to_numpy()[order]
        held, start = np.frombuffer(state["state"][0].as_py(), dtype="<i8").tolist()
        n, first = len(place), int(place[0])
        reached = np.flatnonzero(held + np.cumsum(amounts) >= limit)
        at = int(reached[0]) + 1 if len(reached) else n
        begun = np.full(n, start, dtype=np.int64)
        following = next_starts(amounts, limit)
        while at < n:
            to = min(int(following[at]), n)
            begun[at:to] = first + at
            at = to
        return pa.table([rows["key"], pa.array(place), pa.array(begun)], names=["key", "position", "group_start"])

    return starts


def running_groups(
    df: DataFrame, keys: list[str], order_by: list[str], amount: str | Column, limit: int, *, block_rows: int = BLOCK, chunks: int | None = None
) -> DataFrame:
    """Add ``position``, ``group_start``, ``group_pos`` and ``closed`` per key.

    A group ends with the row at which the sum of its ``amount`` (an integer; null counts
    as 0, negative ones may occur) is ``limit`` or more; ``closed`` tells whether that has
    happened. ``order_by`` must be a total order within a key, and keys may have any number
    of rows. Memory of a task follows a block of rows, or a function with a step for each
    row of the longest group at most. The numbered rows are written once.
    """
    if limit <= 0:
        raise ValueError("a group must reach a limit above 0")
    value = F.coalesce(as_col(amount).cast("bigint"), F.lit(0).cast("bigint"))
    numbered = number_groups(df.withColumn("__amount", value), keys, order_by, chunks=chunks).drop("group_start", "group_pos")
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    rows = kept(numbered, "numbered").withColumn("__key", key)
    light = rows.select(
        F.col("__key").alias("key"), F.floor((F.col("position") - 1) / block_rows).cast("long").alias("block"), "position", F.col("__amount").alias("amount")
    )
    kind = f"key {light.schema['key'].dataType.simpleString()}"
    functions = kept(light.groupBy("key", "block").applyInArrow(_functions(limit), f"{kind}, block long, f binary"), "span")
    start = np.array([0, 1], dtype="<i8").tobytes()
    states, ends = entering_states(functions, compose, apply, start)
    apart = light.select(*[F.col(c).alias(c) for c in light.columns])
    entered = states.select(*[F.col(c).alias(c) for c in states.columns])
    begun = apart.groupBy("key", "block").cogroup(entered.groupBy("key", "block")).applyInArrow(
        _starts(limit), f"{kind}, position long, group_start long"
    )
    open_from = ends.mapInArrow(_open_from, f"{kind}, open_from long").select(F.col("key").alias("__open_key"), "open_from")
    begun = begun.select(F.col("key").alias("__begun_key"), F.col("position").alias("__begun_at"), "group_start")
    marked = rows.join(begun, (F.col("__key") == F.col("__begun_key")) & (F.col("position") == F.col("__begun_at")))
    marked = marked.join(open_from, F.col("__key") == F.col("__open_key"))
    return marked.withColumns(
        {"group_pos": F.col("position") - F.col("group_start") + 1, "closed": F.col("group_start") < F.col("open_from")}
    ).drop("__amount", "__key", "__begun_key", "__begun_at", "__open_key", "open_from")


def _open_from(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        starts = [int(np.frombuffer(s, dtype="<i8")[1]) for s in batch.column("state").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(starts, pa.int64())], names=["key", "open_from"])
