import random

import numpy as np
import pytest

from flowframe.operators.aggregate import aggregate
from flowframe.plans import ordered
from flowframe.plans.ordered import running_totals
from flowframe.plans.running import apply, block_function, compose, running_groups


def fold(amounts, limit):
    """Where each row's group starts, and the open sum and start behind the last row."""
    out, total, start = [], 0, 1
    for position, amount in enumerate(amounts, 1):
        out.append(start)
        total += amount
        if total >= limit:
            total, start = 0, position + 1
    return out, total, start


def state_of(total, start):
    return np.array([total, start], dtype="<i8").tobytes()


@pytest.mark.parametrize("seed", range(40))
def test_blocks_and_spans_against_a_loop(seed):
    rng = random.Random(seed)
    low = rng.choice([0, 0, 1, -6])
    amounts = [rng.randint(low, 9) for _ in range(rng.randint(1, 70))]
    limit = rng.choice([1, 5, 12, 40, 1000])
    cuts = sorted(rng.sample(range(1, len(amounts)), min(len(amounts) - 1, rng.randint(0, 6))))
    blocks = [(a, np.array(amounts[a:b], dtype=np.int64)) for a, b in zip([0, *cuts], [*cuts, len(amounts)])]
    functions = [block_function(rows, limit, first + 1) for first, rows in blocks]
    _, total, start = fold(amounts, limit)
    state = state_of(0, 1)
    for f in functions:
        state = apply(f, state)
    assert state == state_of(total, start)
    # Any way of composing them comes to the same, from any open sum.
    while len(functions) > 1:
        k = rng.randrange(len(functions) - 1)
        functions[k:k + 2] = [compose(functions[k], functions[k + 1])]
    for held in range(-20, limit):
        _, total, start = fold([held, *amounts], limit) if held else fold(amounts, limit)
        want = (total, start) if not held else (total, max(start - 1, 1) if start > 1 else -7)
        got = tuple(np.frombuffer(apply(functions[0], state_of(held, -7 if held else 1)), dtype="<i8").tolist())
        assert got == want


@pytest.fixture
def many_borders():
    before, ordered.BORDER_SAMPLE = ordered.BORDER_SAMPLE, 1
    yield
    ordered.BORDER_SAMPLE = before


@pytest.mark.parametrize("block_rows", [3, 50, 10_000])
def test_groups_against_a_loop(spark, many_borders, block_rows):
    rng = random.Random(block_rows)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), i, rng.choice([None, *range(0, 30)])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, i int, v int")
    out = running_groups(df, ["k"], ["i"], "v", 100, block_rows=block_rows).collect()
    assert len(out) == 400 and out[0].__fields__[:3] == ["k", "i", "v"]
    for key in ("hot", "a", "b", None):
        own = sorted((r for r in out if r["k"] == key), key=lambda r: r["i"])
        starts, _, start = fold([r["v"] or 0 for r in own], 100)
        assert [r["position"] for r in own] == list(range(1, len(own) + 1))
        assert [r["group_start"] for r in own] == starts
        assert [r["closed"] for r in own] == [s < start for s in starts]
        assert [r["group_pos"] for r in own] == [p - s for p, s in enumerate(starts, 2)] or [r["group_pos"] for r in own] == [p - s + 1 for p, s in enumerate(starts, 1)]


def test_release_rule(spark):
    df = spark.createDataFrame([("a", i, 4) for i in range(10)] + [("b", 1, 50), ("c", 1, 1)], "k string, i int, v int")
    rows = aggregate(df, {"k": "k"}, ["i"], payload="i", amount="v", reaches=12).collect()
    assert sorted((r["k"], r["group_start"], r["position"], r["n"]) for r in rows) == [
        *[("a", 1 + 3 * (p // 3), p + 1, 3) for p in range(9)], ("b", 1, 1, 1),
    ]
    every = aggregate(df, {"k": "k"}, ["i"], payload="i", amount="v", reaches=12, partial=True, list_rows=2).collect()
    assert sorted((r["k"], r["group_start"], r["part"], len(r["payloads"])) for r in every if r["k"] != "b") == [
        *[("a", s, p, 2 - p) for s in (1, 4, 7) for p in (0, 1)], ("a", 10, 0, 1), ("c", 1, 0, 1),
    ]
    for wrong in ({"reaches": 3}, {"amount": "v"}, {"amount": "v", "reaches": 3, "count": 2}, {"amount": "v", "reaches": 0}):
        with pytest.raises(ValueError):
            aggregate(df, {"k": "k"}, ["i"], payload="i", **wrong)


def test_running_totals(spark, many_borders):
    rng = random.Random(9)
    rows = [(rng.choice(["hot", "a", None]), i, rng.choice([None, 1, 2, 30])) for i in range(300)]
    for chunks in (1, 7, 60):
        out = running_totals(spark.createDataFrame(rows, "k string, i int, v int"), ["k"], ["i"], {"before": "v", "seen": "1"}, chunks=chunks).collect()
        for r in out:
            earlier = [v or 0 for k, i, v in rows if k == r["k"] and i < r["i"]]
            assert (r["before"], r["seen"]) == (sum(earlier), len(earlier))
    assert running_totals(spark.createDataFrame([], "k string, i int"), [], ["i"], {"seen": "1"}).collect() == []
