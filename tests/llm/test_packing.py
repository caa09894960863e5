import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from flowframe.llm import packing
from flowframe.llm.packing import best_fit, cost, pack, pack_lengths
from flowframe.llm.queries import QUERIES, SEQUENCES


def plain_best_fit(lengths, capacities, opened):
    """Every bin looked at for every item."""
    bins = []
    for item, length in enumerate(lengths):
        fitting = [(room, k) for k, (room, _) in enumerate(bins) if room >= length]
        if fitting:
            room, k = min(fitting)
            bins[k] = (room - length, [*bins[k][1], item])
        else:
            size = opened if opened >= length else min(c for c in capacities if c >= length)
            bins.append((size - length, [item]))
    return [items for _, items in bins]


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_against_plain_search(seed):
    rng = random.Random(seed)
    lengths = sorted((rng.randint(1, 64) for _ in range(200)), reverse=True)
    for opened in (16, 32, 64):
        assert [items for _, items in best_fit(lengths, [16, 32, 64], [opened])] == plain_best_fit(lengths, [16, 32, 64], opened)


def plain_choice(item, waiting, capacities, overhead):
    """The length whose sequence, filled longest first, costs least for each unit."""
    prices = []
    for capacity in capacities:
        if capacity >= item:
            held = item
            for length in sorted(waiting, reverse=True):
                if held + length <= capacity:
                    held += length
            prices.append(((min(c for c in capacities if c >= held) + overhead) / held, capacity))
    return min(prices)[1]


@pytest.mark.parametrize("seed", range(6))
def test_each_opening_is_the_cheapest(seed):
    rng = random.Random(seed)
    capacities = [16, 32, 64, 128]
    lengths = sorted((rng.randint(1, rng.choice([20, 128])) for _ in range(80)), reverse=True)
    for overhead in (0, 5, 40):
        opened = best_fit(lengths, capacities, capacities, overhead)
        for room, items in opened:
            assert room == plain_choice(lengths[items[0]], lengths[items[0] + 1:], capacities, overhead)
            assert sum(lengths[i] for i in items) <= room


def optimum(lengths, capacities, overhead):
    """The least cost over all partitions of few items."""
    if not lengths:
        return 0
    first, rest = lengths[0], lengths[1:]
    costs = []
    for mask in range(1 << len(rest)):
        held = first + sum(x for k, x in enumerate(rest) if mask >> k & 1)
        if held <= capacities[-1]:
            own = min(c for c in capacities if c >= held) + overhead
            costs.append(own + optimum([x for k, x in enumerate(rest) if not mask >> k & 1], capacities, overhead))
    return min(costs)


def test_cost_is_near_the_optimum_of_small_groups():
    rng = random.Random(6)
    spent = ideal = 0
    for _ in range(40):
        lengths = sorted((rng.randint(1, 40) for _ in range(7)), reverse=True)
        packed = pack_lengths(lengths, [16, 32, 64], 2)
        assert sorted(i for _, items in packed for i in items) == list(range(7))
        spent += sum(cost(c, 2) for c, _ in packed)
        ideal += optimum(lengths, [16, 32, 64], 2)
    assert ideal <= spent <= 1.05 * ideal


def test_cost_is_never_above_that_of_one_length_throughout():
    rng = random.Random(9)
    lengths = sorted((rng.randint(1, 60) for _ in range(100)), reverse=True)
    capacities = [16, 32, 64]
    tries = []
    for opened in capacities:
        bins = plain_best_fit(lengths, capacities, opened)
        tries.append(sum(cost(min(c for c in capacities if c >= sum(lengths[i] for i in items)), 2) for items in bins))
    assert sum(cost(c, 2) for c, _ in pack_lengths(lengths, capacities, 2)) <= min(tries)
    assert pack_lengths([], capacities, 2) == []


def check(rows, docs, capacities):
    """Bins hold what they may, pieces cover their documents, and no bin could be shorter."""
    bins, covered = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
        covered[r.doc_id, r.copy].append((r.piece, r.start, r.length))
    for held in bins.values():
        held.sort(key=lambda r: r.offset)
        end = 0
        for r in held:
            assert r.offset == end and r.bin_pieces == len(held) and r.capacity == held[0].capacity
            end += r.length + 1
        assert held[0].capacity == min(c for c in capacities if c >= end)
    want = defaultdict(int)
    lengths = defaultdict(list)
    for doc, text in docs:
        lengths[doc].append(len(text or ""))
        want[doc] += 1
    got = defaultdict(list)
    for (doc, _), parts in covered.items():
        parts.sort()
        assert [p[0] for p in parts] == list(range(len(parts)))
        assert all(a[1] + a[2] == b[1] for a, b in zip(parts, parts[1:], strict=False)) and parts[0][1] == 0
        got[doc].append(parts[-1][1] + parts[-1][2])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in lengths.items()}


def test_nulls_empty_long_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 7)
    monkeypatch.setattr(packing, "COPIES", 3)
    docs = [(i, "x" * (i * 7 % 90)) for i in range(60)] + [(70, None), (71, ""), (72, "y" * 10_001), (73, "z" * 63), (74, "z" * 64), (None, "n")]
    docs += [(80, "same")] * 11
    df = spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, bin_id int")
    rows = pack(df, F.length("text"), capacities=(64, 16, 32)).collect()
    check(rows, docs, [16, 32, 64])
    assert sorted(r.copy for r in rows if r.doc_id == 80) == list(range(11))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pack(df, F.length("text")).collect() == []


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = list(map(tuple, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()))
    rows = QUERIES["op8_variable_best_fit"](spark, sf_dir).collect()
    check(rows, docs, SEQUENCES)
    room = sum(r.capacity / r.bin_pieces for r in rows)
    assert sum(r.length + 1 for r in rows) > 0.9 * room
