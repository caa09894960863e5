import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from flowframe.llm import collocations as c
from flowframe.llm.queries import QUERIES


def plain(docs, least=10, cover=50, most=2000):
    """Every phrase of every text in a counter."""
    counts, total = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= cover * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), " ".join(p), f[p[:k]], f[p[k:]]))
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(rows)[:most], 1):
            out.append((lang, rank, phrase, -a, left, right, total[lang], -score))
    return sorted(out)


SCHEMA = "text string, lang string, doc_id long, word string, n int, block string"
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, "clash", 2, "clash") for d in docs], SCHEMA)


def rows_of(found):
    return sorted(tuple(r[x] for x in COLUMNS) for r in found.collect())


def sentence(rng, words, n):
    return "".join(rng.choice(words) + rng.choice([" "] * 8 + [". ", "\t", "  ", ", ", "\n"]) for _ in range(n))


def test_query_on_odd_rows(spark, tmp_path):
    rng = random.Random(1)
    words = ["New", "york", "CITY", "the", "é", "É", "of", "it's", "a b", "x\x1cy", "日本", "-"]
    docs = [(sentence(rng, words, 60), rng.choice(["en", "fr", None, "und", ""])) for _ in range(80)]
    docs += [(None, "en"), ("", "en"), (" .. \t", None), ("only", "de")] + [("hot pair here", "en")] * 40
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r[x] for x in COLUMNS) for r in QUERIES["op11_tiled_collocations"](spark, str(tmp_path)).collect())
    assert got == plain(docs) and len(got) > 50


def test_empty_tables(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op11_tiled_collocations"](spark, str(tmp_path)).collect() == []
    assert c.collocations(frame(spark, [(None, None), ("", "en")])).collect() == []


def test_blocks_cut_long_texts_and_are_merged_in_a_tree(spark, monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(c, "FAN", 3)
    monkeypatch.setattr(c, "SLICE", 200)
    docs = [(sentence(rng, "a b c d e f g".split(), 400_000), "en"), (sentence(rng, "a b c".split(), 300), "fr")]
    found = c.best(c.collocations(frame(spark, docs), block_words=30_000), 2000)
    assert rows_of(found) == plain(docs)


def test_more_words_than_the_dense_head_holds(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(c.HEAD * c.SIDE + 900)]
    pairs = [(rng.choice(words), rng.choice(words), rng.choice(words)) for _ in range(300)]
    texts = [" ".join(w) for w in pairs for _ in range(10)] + [w for w in words for _ in range(12)]
    rng.shuffle(texts)
    docs = [(". ".join(texts[i:i + 50]), "en") for i in range(0, len(texts), 50)]
    found = c.best(c.collocations(frame(spark, docs), block_words=9_000), 2000)
    want = plain(docs)
    assert rows_of(found) == want and len(want) > 200


def test_rank_is_cut_at_the_limit_with_ties_by_name(spark):
    docs = [(f"p{i:03} q{i:03}.", "en") for i in range(60) for _ in range(10)]
    got = rows_of(c.best(c.collocations(frame(spark, docs)), 25))
    assert got == plain(docs, most=25) and [r[2] for r in got][:2] == ["p000 q000", "p001 q001"]


def test_scores_past_64_bits():
    import pyarrow as pa

    big = 4 * 10**12
    cuts = pa.array([[{"l": big, "r": big + 1}, {"l": big, "r": big}]])
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array(["x y"]), pa.array([big - 1]), pa.array([1]), cuts], names=["lang", "phrase", "a", "n", "cuts"])
    out, = c._scored(iter([batch]))
    assert out.column("score").to_pylist() == [10**6 * (big - 1) ** 2 // (big * (big + 1))] and out.column("r").to_pylist() == [big + 1]


@pytest.mark.parametrize("known", [0, 1, 2])
def test_tiles_against_a_counter(known):
    rng = np.random.default_rng(known)
    size = c.HEAD * c.SIDE
    left = rng.choice([-1, 0, 5, 1023, 1024, size - 1, size, size + 70], 5000)
    right = rng.choice([-1, 0, 7, 2047, 4095, size, 3 * size], 5000)
    left[:2], right[:2] = [5, size], [7, 3 * size]
    want = Counter(zip(left[known:].tolist(), right[known:].tolist()))
    got = {}
    for tile, codes, counts in c.tiles(left, right, known, 7):
        i, j = c.whole_codes(tile, codes)
        assert (tile >= 0) == bool((max(i.max(), j.max()) < size)) or tile < 0
        got |= dict(zip(zip(i.tolist(), j.tolist()), counts.tolist()))
    assert {k: n for k, n in got.items() if n} == {k: n for k, n in want.items() if min(k) >= 0}
    assert (5, 7) in got and (size, 3 * size) in got


def test_merged_lists_add_up():
    lists = [(np.array([1, 5, 9]), np.array([2, 3, 4])), (np.array([5, 6]), np.array([10, 0]))]
    for tile in (3, -2):
        codes, counts = c.merged(tile, lists)
        assert dict(zip(codes.tolist(), counts.tolist())) == {1: 2, 5: 13, 6: 0, 9: 4}
