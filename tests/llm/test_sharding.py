from collections import Counter

import numpy as np

from flowframe.llm import sharding
from flowframe.llm.queries import QUERIES
from flowframe.llm.sharding import draw_matrix, even, hypergeometric, shard


def check_law(rows, shards):
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_exact_sizes_and_gapless_slots(spark, monkeypatch):
    df = spark.range(1003).selectExpr("id", "if(id % 3 = 0, null, 'x') as text", "1 as slot", "map('a', 1) as m")
    for most, each in ((1024, 1000), (64, 20)):
        monkeypatch.setattr(sharding, "MOST", most)
        monkeypatch.setattr(sharding, "ROWS", each)
        out = shard(df, ["id"], shards=7)
        assert out.columns == ["id", "text", "m", "shard", "slot"]
        rows = out.collect()
        check_law(rows, 7)
        assert sorted(r.id for r in rows) == list(range(1003))


def test_same_result_however_rows_are_partitioned(spark):
    df = spark.range(500)
    seen = [sorted(map(tuple, shard(x, ["id"], shards=5).collect())) for x in (df.repartition(3), df.repartition(11, "id"))]
    assert seen[0] == seen[1]
    assert sorted(map(tuple, shard(df, ["id"], shards=5, seed=8).collect())) != seen[0]


def test_null_keys_repeated_rows_fewer_rows_than_shards_and_empty(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, "b"), (1, "b"), (1, None)], "id long, text string")
    check_law(shard(df, ["id"], shards=40).collect(), 40)
    assert shard(df.filter("false"), ["id"]).collect() == []


def test_matrix_margins_and_distribution():
    rng = np.random.default_rng(3)
    sums = np.zeros((3, 4))
    for _ in range(4000):
        matrix = np.array(draw_matrix(rng, [5, 0, 15], [8, 2, 4, 6]))
        assert matrix.sum(axis=1).tolist() == [5, 0, 15] and matrix.sum(axis=0).tolist() == [8, 2, 4, 6]
        sums += matrix
    assert np.allclose(sums / 4000, np.outer([5, 0, 15], [8, 2, 4, 6]) / 20, atol=0.12)
    assert even(10, 4) == [3, 3, 2, 2]


def test_hypergeometric_beyond_numpy():
    rng = np.random.default_rng(4)
    good, bad, draws = 3 * 10**9, 7 * 10**9, 10**6
    x = np.array([hypergeometric(rng, good, bad, draws) for _ in range(2000)])
    variance = draws * 0.3 * 0.7
    assert abs(x.mean() - 3 * 10**5) < 5 * (variance / 2000) ** 0.5
    assert 0.85 < x.var() / variance < 1.15
    assert hypergeometric(rng, 2 * 10**9, 1, 2 * 10**9 + 1) == 2 * 10**9


def test_each_row_may_come_anywhere(spark):
    """Over many seeds, a row's shard and slot are uniform."""
    df = spark.range(20).repartition(1).cache()
    seen = Counter()
    for seed in range(60):
        seen.update((r.shard, r.slot) for r in shard(df, ["id"], shards=4, seed=seed).filter("id < 5").collect())
    assert len(seen) == 20 and max(seen.values()) < 40


def test_whole_table(spark):
    rows = QUERIES["op3_hypergeometric_shards"](spark, "/root/testdata/sf0.001").collect()
    check_law(rows, 40)
    assert all(r.size >= 16 and r.grown_shard is None and r.law == "rows" for r in rows)
