import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import corpus_pipeline  # noqa: E402
from test_jaccard import brute  # noqa: E402
from test_packing import check  # noqa: E402

from flowframe.llm.queries import SEQUENCES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage is held against plain Python on what the one before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "packing":
            check(out.collect(), [(r.doc_id, r.text) for r in before.values()], SEQUENCES)
            break
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        kept = {r.doc_id: r for r in docs.collect()}
        assert all(before[i] == r for i, r in kept.items())
        if name == "language":
            assert len(kept) > 0.97 * len(before) and not any(not any(map(str.isalpha, r.text)) for r in kept.values())
        elif name == "exact_dedup":
            best = {}
            for i, r in before.items():
                best[r.text.lower()] = max(i, best.get(r.text.lower(), i))
            assert set(kept) == set(best.values())
        else:
            groups = brute([(i, r.text) for i, r in before.items()])
            assert set(kept) == {doc for doc, _, first in groups if doc == first}
        before = kept


def test_near_copies_with_null_and_repeated_ids(spark):
    def text(word, end):
        return " ".join(f"{word}{i}" for i in range(60)) + f" {end}"

    rows = [
        (1, text("a", "x")), (2, text("a", "y")),  # near copies: 1 stays
        (2, text("b", "x")),  # its id is that of a dropped row
        (3, text("c", "x")), (3, text("c", "y")),  # near copies that share an id
        (None, text("d", "x")), (None, text("d", "y")),  # and those without one
        (None, text("e", "x")), (9, text("e", "y")),  # null ids come last
        (1, text("f", "x")), (4, text("f", "y")), (4, text("f", "y")),
        (5, text("g", "x")), (5, text("g", "x")),  # equal rows
        (6, None), (6, None), (None, ""),  # no words, no links
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.one_of_near_copies(spark, docs, SF)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    found = sorted((str(i), (t or "-")[0], (t or "-")[-1]) for i, t in got if t)
    assert [f[:2] for f in found] == [("1", "a"), ("1", "f"), ("2", "b"), ("3", "c"), ("5", "g"), ("9", "e"), ("None", "d")]
    assert sorted((r for r in got if not r[1]), key=str) == [(6, None), (6, None), (None, "")]


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {r.capacity for r in rows} <= set(SEQUENCES)


def test_empty_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []
