import random
import re

import pytest

from flowframe.llm import jaccard_join
from flowframe.llm.jaccard_join import allotment, band_edges, jaccard_groups
from flowframe.llm.queries import QUERIES


def members(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(rows, percent=80):
    """Smallest id that links lead to, pair by pair."""
    sets = [members(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(i)] = min(ids.get(find(i), doc), doc)
    return sorted(((doc, len(sets[i]), ids.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)), key=str)


def grouped(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, class int, component_id int")
    out = jaccard_groups(df, **options).select("doc_id", "n_shingles", "component_id").collect()
    return sorted((tuple(r) for r in out), key=str)


def near(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


def test_against_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", " \t\n", "one", "One", "one two", "a b c d", "a b c d e", "a b c d e f"]
    for size in (6, 9, 14, 30, 60, 200):
        for family in range(3):
            words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            texts += [near(rng, words, rng.randrange(1 + size // 25)) for _ in range(6)]
            texts += [" ".join(words[: size - cut]) for cut in range(1, 5)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    assert grouped(spark, rows) == brute(rows)


def test_common_passage_and_large_group_of_near_copies(spark):
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join([*passage, *(f"u{i}-{k}" for k in range(rng.choice([3, 20, 40])))])) for i in range(60)]
    base = [f"b{i}" for i in range(146)]
    rows += [(100 + i, near(rng, base, 1 + i % 5)) for i in range(90)]
    assert grouped(spark, rows) == brute(rows)


@pytest.mark.parametrize("blocks", [(4, 300), (512, 250_000)])
def test_blocks_and_listing_change_nothing(spark, monkeypatch, blocks):
    rng = random.Random(7)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, near(rng, base, 1 + i % 7)) for i in range(40)]
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", blocks[0])
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", blocks[1])
    assert grouped(spark, rows) == brute(rows)


def test_repeated_rows_null_ids_and_copies(spark):
    text = "to be or not to be that is the question"
    rows = [(3, text), (3, text), (None, text), (2, text.upper()), (None, "something else that nobody else has written"), (9, "x" * 300_000)]
    assert grouped(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert grouped(spark, []) == []


def test_bands_hold_every_pair_and_segments_suffice():
    edges = band_edges(80)
    for small in range(1, 3000):
        large = small * 100 // 80
        low = max(k for k, e in enumerate(edges) if e <= small)
        assert large < edges[low + 2]
        segments, spare, deleting = allotment(low, 80)
        differ = (small + large) * 20 // 180
        assert differ < (2 * segments if deleting else segments - spare + 1) or not differ


def test_whole_table_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op2_partition_jaccard"](spark, "/root/testdata/sf0.001").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("percent", [60, 95, 99])
def test_other_similarities_and_large_sets(spark, percent):
    rng = random.Random(percent)
    base = [f"w{i}" for i in range(9_000)]
    short = [f"s{i}" for i in range(400)]
    rows = [(1, " ".join(base)), (2, near(rng, base, 3)), (3, near(rng, base, 60)), (4, near(rng, base, 500)), (5, " ".join(base[:8_000]))]
    rows += [(10 + k, near(rng, short, k)) for k in range(0, 30, 3)] + [(50, "one two"), (51, "one two"), (52, None)]
    assert grouped(spark, rows, percent=percent) == brute(rows, percent)


def test_similarities_out_of_range():
    for percent in (0, 100):
        with pytest.raises(ValueError):
            band_edges(percent)
