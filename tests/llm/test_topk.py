import math
import random

import numpy as np
import pytest

from flowframe.llm import topk
from flowframe.llm.topk import SortedLists, top_k

SCHEMA = "vec_id long, embedding array<float>, rank int"


def brute(rows, queries, k):
    sound = [(i, [math.floor(256.0 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, query in [x for x in sound if x[0] in queries]:
        scores = sorted((-sum(a * b for a, b in zip(query, v)), i) for i, v in sound if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(spark, rows, queries, k=5):
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    return sorted(map(tuple, top_k(df, df.filter(df.vec_id.isin(list(queries))), k).collect()))


@pytest.mark.parametrize("cells", [(8192, 4096), (16, 3)])
def test_against_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(topk, "CANDIDATES", cells[0])
    monkeypatch.setattr(topk, "QUERIES", cells[1])
    monkeypatch.setattr(topk, "FIRST_DEPTH", 2)
    rng = random.Random(1)
    # Quarter steps, so that scores tie; float values are exact.
    rows = [(i, [rng.randint(-4, 4) / 4 for _ in range(6)]) for i in range(90)]
    rows += [(90, None), (91, [1.0, None] + [0.0] * 4), (92, [math.nan] + [0.0] * 5), (93, [math.inf] + [0.0] * 5), (None, [1.0] * 6)]
    rows += [(94, [0.0] * 6), (95, [0.0] * 6), (96, rows[0][1])]
    queries = {0, 10, 20, 30, 90, 91, 94, 96}
    assert found(spark, rows, queries) == brute(rows, queries, 5)


def test_few_rows_and_empty_tables(spark):
    assert found(spark, [(1, [1.0]), (2, [2.0])], {1}) == [(1, 1, 2, 512 * 256)]
    assert found(spark, [(1, [1.0])], {1}) == []
    assert found(spark, [], {1}) == []
    assert found(spark, [(1, [1.0])], set()) == []


def test_short_vectors_and_large_components(spark):
    rows = [(1, [1.0, 1.0]), (2, [3.0]), (3, []), (4, [1e9, -1e9])]
    assert found(spark, rows, {1}) == [(1, 1, 2, 768 * 256), (1, 2, 3, 0), (1, 3, 4, 0)]


def test_long_and_repeated_rows(spark):
    rows = [(1, [0.5] * 3000), (2, [0.5] * 3000), (2, [0.5] * 3000), (3, [0.25] * 3000)]
    score = 128 * 128 * 3000
    assert found(spark, rows, {1}) == [(1, 1, 2, score), (1, 2, 2, score), (1, 3, 3, score // 2)]


def test_threshold_stops_early():
    """Where a few vectors stand out, most of the block is never scored."""
    vectors = np.ones((5000, 4), dtype=np.int64)
    vectors[:, 0] = np.arange(5000)
    lists = SortedLists(np.arange(5000), vectors, np.float64)
    scored = []
    lists.vectors = Counting(lists.vectors, scored)
    ids, scores = lists.top(np.array([9.0, 1.0, 0.0, 0.0]), -1, 3)
    assert ids.tolist() == [4999, 4998, 4997] and scores[0] == 9 * 4999 + 1 and sum(scored) < 1000


class Counting:
    def __init__(self, data, log):
        self.data, self.log = data, log

    def __getitem__(self, at):
        out = self.data[at]
        if not isinstance(at, tuple):
            self.log.append(len(out))
        return out
