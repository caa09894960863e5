"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows fall into blocks by a hash of their key. From the blocks' counts the driver draws
how many rows each block sends to each bin, a stretch of a shard's slots: exactly the
law of a uniform permutation, since the matrix of such a permutation is multivariate
hypergeometric. Each block is then permuted and dealt out by its row of the matrix,
the bins are exchanged, and each bin is permuted again.

The driver holds one count per block and the matrix, at most ``MOST`` by ``MOST``
numbers at any input size; past that, blocks and bins grow, and their sorts spill.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.base import pieces, without, written

MOST = 1024
#: Rows that a block or a bin holds as long as ``MOST`` allows.
ROWS = 1_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good ones among ``draws`` without return; beyond numpy's range by Stadlober's ratio of uniforms."""
    if max(good, bad) < 10**9:
        return int(rng.hypergeometric(good, bad, draws)) if good + bad else 0
    total, few, many, m = good + bad, min(good, bad), max(good, bad), min(draws, good + bad - draws)
    share = few / total
    centre = m * share + 0.5
    spread = math.sqrt((total - m) * draws * share * (1 - share) / (total - 1) + 0.5)
    width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
    log = lambda z: sum(map(math.lgamma, (z + 1, few - z + 1, m - z + 1, many - m + z + 1)))
    at_mode = log((m + 1) * (few + 1) // (total + 2))
    end = min(min(m, few) + 1, math.floor(centre + 16 * spread))
    while True:
        x, y = 1 - rng.random(), rng.random()
        w = centre + width * (y - 0.5) / x
        if 0 <= w < end and 2 * math.log(x) <= at_mode - log(math.floor(w)):
            z = math.floor(w)
            z = m - z if good > bad else z
            return good - z if m < draws else z


def draw_matrix(rng: np.random.Generator, sent: list[int], room: list[int]) -> list[list[int]]:
    """Rows that block b sends to bin t; row sums are ``sent``, column sums are ``room``."""
    room, left, matrix = list(room), sum(room), []
    for n in sent:
        row, others = [], left
        for t, free in enumerate(room):
            others -= free
            take = hypergeometric(rng, free, others, n)
            row.append(take)
            room[t] -= take
            n -= take
        left -= sum(row)
        matrix.append(row)
    return matrix


def even(total: int, parts: int) -> list[int]:
    """Sizes that differ by one at most."""
    return [total // parts + (i < total % parts) for i in range(parts)]


def _rows(df: DataFrame, values: list[dict], schema: str) -> DataFrame:
    """A bounded list as a written table, through one literal that later plans need not carry."""
    literal = F.from_json(F.lit(json.dumps(values)), f"array<struct<{schema}>>")
    return written(df.sparkSession.range(1).select(F.inline(literal)), "matrix")


def shard(df: DataFrame, key: list[str], shards: int = 40, seed: int = 7) -> DataFrame:
    """All rows with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    Shard sizes differ by one at most; with fewer rows than shards the last ones stay
    empty. The result depends on the rows and the seed only, not on how they are
    partitioned. ``key`` should tell rows apart: rows with an equal key share a block
    (nulls are a value), are ordered by their other columns, and, if equal in all, are
    interchangeable. Columns named like a result give way to it.
    """
    df = without(df, *(c for c in ("shard", "slot") if c not in key))
    keys = [F.col(f"`{c}`") for c in key]
    whole = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    salted = lambda salt: (F.xxhash64(F.lit(seed), F.lit(salt), *keys), F.xxhash64(F.lit(salt), *whole))
    cell = F.pmod(salted("block")[0], F.lit(MOST)).cast("int")
    counts = dict(map(tuple, df.groupBy(cell.alias("cell")).count().collect()))
    total = sum(counts.values())
    blocks = min(MOST, 1 << (pieces(total, ROWS) - 1).bit_length())
    fold = MOST // blocks
    sent = [sum(counts.get(b * fold + i, 0) for i in range(fold)) for b in range(blocks)]
    per_shard = max(1, min(MOST // shards, pieces(total, ROWS * shards)))
    bins = [
        {"__llm_bin": s * per_shard + i, "__llm_first": sum(parts[:i]), "shard": s, "size": size}
        for s, n in enumerate(even(total, shards))
        for parts in [even(n, per_shard)]
        for i, size in enumerate(parts)
    ]
    matrix = draw_matrix(np.random.default_rng(seed), sent, [b["size"] for b in bins])
    dealt = [{"__llm_block": b, "__llm_ends": np.cumsum(row).tolist()} for b, row in enumerate(matrix)]
    place = Window.partitionBy("__llm_block").orderBy(*salted("first"))
    seat = Window.partitionBy("__llm_bin").orderBy(*salted("second"))
    placed = df.withColumn("__llm_block", F.floor(cell / fold).cast("int")).withColumn("__llm_place", F.row_number().over(place))
    sent_to = placed.join(_rows(df, dealt, "__llm_block int, __llm_ends array<bigint>"), "__llm_block").withColumn("__llm_bin", _first_over("__llm_ends", F.col("__llm_place")))
    seated = sent_to.withColumn("__llm_seat", F.row_number().over(seat))
    out = seated.join(_rows(df, bins, "__llm_bin int, __llm_first bigint, shard int"), "__llm_bin")
    slot = (F.col("__llm_first") + F.col("__llm_seat") - 1).alias("slot")
    return out.select(*(F.col(f"`{c}`") for c in df.columns), "shard", slot)


def _first_over(ends: str, place: Column) -> Column:
    """Index of the first end that is not below the place (from 1)."""
    return F.size(F.filter(ends, lambda end: end < place))
