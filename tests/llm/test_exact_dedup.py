import hashlib
import math
from collections import defaultdict

import numpy as np

from flowframe.llm import exact_dedup as module
from flowframe.llm.exact_dedup import exact_dedup, golomb_decode, golomb_encode


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def check(rows, got):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[fold(text)].append(doc)
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(rows, key=str)
    kept = defaultdict(int)
    for r in got:
        ids = groups[fold(r.text)]
        top = max((x for x in ids if x is not None), default=None)
        assert (r.keep_id, r.group_size) == (top, len(ids))
        assert r.text_sha256 == hashlib.sha256(fold(r.text).encode()).hexdigest()
        assert not r.kept or r.doc_id == top
        kept[fold(r.text)] += r.kept
    assert all(kept[text] == 1 for text in groups)


def test_golomb_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 2, 100, 5000):
        for high in (n + 1, 10**6, 2**63):
            numbers = np.unique(rng.integers(0, high, n, dtype=np.uint64))
            rice, unary, rests = golomb_encode(numbers)
            assert (golomb_decode(len(numbers), rice, unary, rests) == numbers).all()
    edge = np.array([0, 2**64 - 1], dtype=np.uint64)
    assert (golomb_decode(2, *golomb_encode(edge)) == edge).all()


def test_coding_saves_space():
    numbers = np.unique(np.random.default_rng(2).integers(0, 2**40, 100_000, dtype=np.uint64))
    _, unary, rests = golomb_encode(numbers)
    # Golomb-Rice codes of random numbers take log2(range / count) + 1.6 bits at most.
    assert 8 * (len(unary) + len(rests)) < len(numbers) * (math.log2(2**40 / len(numbers)) + 1.6)


def test_groups_nulls_repeats_and_clashes(spark, monkeypatch):
    monkeypatch.setattr(module, "OWNED", 40)
    rows = [(i, f"Text {i % 50}") for i in range(120)] + [(500, "lone"), (501, "LONE"), (502, "É"), (503, "é")]
    rows += [(None, None), (None, ""), (7, ""), (7, ""), (None, "nobody"), (None, "NOBODY"), (900, "z" * 400_000), (901, "Z" * 400_000)]
    df = spark.createDataFrame([(*r, True, "x") for r in rows], "doc_id long, text string, kept boolean, _other string").repartition(6)
    out = exact_dedup(df)
    assert out.columns == ["doc_id", "text", "_other", "keep_id", "group_size", "kept", "text_sha256"]
    check(rows, out.collect())


def test_all_rows_equal(spark):
    rows = [(i, "Same") for i in range(400)]
    check(rows, exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect())
    twice = [(1, "a"), (1, "A"), (1, "a")]
    check(twice, exact_dedup(spark.createDataFrame(twice, "doc_id long, text string")).collect())


def test_equal_prints_are_compared_byte_by_byte(spark, monkeypatch):
    """With a print that says nothing, every text is a suspect and the texts decide."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(module.F, "xxhash64", lambda *_: F.lit(5).cast("long"))
    rows = [(i, f"t{i % 7}") for i in range(20)]
    check(rows, exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []
