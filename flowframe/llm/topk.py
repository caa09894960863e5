"""Exact top-k by inner product: Fagin's threshold algorithm over sorted lists.

Candidates are dealt into blocks of a fixed size, and so are the queries; each cell
of the grid is one group. A cell sorts its candidates once per dimension. For each
query it reads those lists from the end that the sign of the query's component asks
for, scores every vector when it first comes up, and stops as soon as the best score
that an unseen vector could have lies below the k-th best score seen. The cells'
answers are then ranked per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.base import pieces

#: Rows of a cell.
CANDIDATES = 8192
QUERIES = 4096
#: Depth of the first step into the lists; each further step doubles it.
FIRST_DEPTH = 64


def quantised(vector: str, scale: int = 256) -> Column:
    """``floor(scale * x)`` of each component; null for a vector that is null or has a null or non-finite component."""
    sound = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return F.when(F.coalesce(sound, F.lit(False)), whole)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; missing components count as 0."""
    out = np.zeros((len(column), width), dtype=np.int64)
    for row, values in zip(out, column.to_pylist(), strict=True):
        row[: len(values)] = values
    return out


def _exact(candidates: np.ndarray, queries: np.ndarray) -> type:
    """The smallest number type that holds every inner product without rounding."""
    most = [max((abs(int(f(x))) for f in (np.min, np.max)), default=0) if x.size else 0 for x in (candidates, queries)]
    bound = most[0] * most[1] * max(1, candidates.shape[1])
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64 if bound < 2**63 else object


class SortedLists:
    """A block of vectors, sorted by each component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, kind: type):
        self.ids, self.vectors = ids, vectors.astype(kind)
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.vectors, self.order, axis=0)

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (ids, scores), ties to the smaller id, without the query's own id."""
        n = len(self.ids)
        down, up = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = np.zeros(n, dtype=bool)
        ids, scores = self.ids[:0], self.vectors[:0, :1].reshape(-1)
        start, depth = 0, FIRST_DEPTH
        while True:
            end = min(n, depth)
            before = seen.copy()
            seen[self.order[n - end : n - start, down].ravel()] = True
            seen[self.order[start:end, up].ravel()] = True
            if end == n:
                seen[:] = True  # also for a query of zeros, which reads no list
            new = np.flatnonzero(seen & ~before)
            new = new[self.ids[new] != own]
            ids = np.concatenate([ids, self.ids[new]])
            scores = np.concatenate([scores, self.vectors[new] @ query])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if end == n:
                return ids, scores
            unseen = self.sorted[n - end, down] @ query[down] + self.sorted[end - 1, up] @ query[up]
            if len(scores) == k and unseen < scores[-1]:
                return ids, scores
            start, depth = end, 2 * depth


def _cell(k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [], [], []
        if left.num_rows and right.num_rows:
            width = max(len(v) for side in (left, right) for v in side["_vector"])
            vectors, queries = _matrix(left["_vector"], width), _matrix(right["_vector"], width)
            kind = _exact(vectors, queries)
            lists = SortedLists(left["_id"].to_numpy(), vectors, kind)
            for own, query in zip(right["_id"].to_pylist(), queries.astype(kind), strict=True):
                ids, scores = lists.top(query, own, k)
                for part, new in zip(found, ([own] * len(ids), ids.tolist(), [int(x) for x in scores]), strict=True):
                    part.extend(new)
        return pa.table([pa.array(x, pa.int64()) for x in found], names=["query_id", "vec_id", "score"])

    return search


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of each query's k best; all, if there are fewer.

    Rows with a null id, and vectors that are null or hold a null or non-finite
    component, take no part. Shorter vectors are filled with 0. Rows that share the
    query's id are its own and never its answers; other repeated rows each count.
    A query id that occurs more than once is searched once, by its greatest vector.
    """
    base = [
        x.select(F.col(vec_id).cast("long").alias("_id"), quantised(vector, scale).alias("_vector")).dropna()
        for x in (vectors, queries)
    ]
    base[1] = base[1].groupBy("_id").agg(F.max("_vector").alias("_vector"))
    n, m = (x.count() for x in base)
    rows, columns = pieces(n, CANDIDATES), pieces(m, QUERIES)
    deal = lambda parts: F.pmod(F.xxhash64("_id"), F.lit(parts))
    every = lambda parts: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    left = base[0].select("_id", "_vector", deal(rows).alias("_row"), every(columns).alias("_column"))
    right = base[1].select("_id", "_vector", every(rows).alias("_row"), deal(columns).alias("_column"))
    found = left.groupBy("_row", "_column").cogroup(right.groupBy("_row", "_column"))
    found = found.applyInArrow(_cell(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
