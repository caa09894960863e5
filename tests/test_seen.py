import pytest

from flowframe.sources import seen
from flowframe.sources.seen import mark_seen_large, possibly_seen, unseen_large


def keys(frame):
    return sorted(r["k"] for r in frame.collect())


def test_nothing_new_is_lost_and_nothing_old_comes_back(spark, tmp_path):
    path = str(tmp_path / "ledger")
    first = spark.range(0, 3000).selectExpr("id AS k", "id * 2 AS v").repartition(7)
    out = mark_seen_large(first, path, ["k"], buckets=4)
    assert keys(out) == list(range(3000)) and out.columns == ["k", "v"]
    asked = possibly_seen(spark.range(3000, 13_000).withColumnRenamed("id", "k"), path, ["k"], 4)
    assert asked.filter("maybe").count() < 500
    again = possibly_seen(first, path, ["k"], 4)
    assert again.filter("maybe").count() == 3000
    second = spark.range(2000, 4000).selectExpr("id AS k", "0 AS v")
    assert keys(mark_seen_large(second, path, ["k"], buckets=4)) == list(range(3000, 4000))
    assert keys(unseen_large(spark.range(0, 4100).withColumnRenamed("id", "k"), path, ["k"], buckets=4)) == list(range(4000, 4100))
    assert keys(mark_seen_large(first, path, ["k"], buckets=4)) == []


def test_nulls_repeats_and_several_key_columns(spark, tmp_path):
    rows = [(None, "x", 1), (None, "x", 1), (1, None, 2), (1, "x", 3)]
    df = spark.createDataFrame(rows, "a int, b string, c int")
    path = str(tmp_path / "ledger")
    assert mark_seen_large(df, path, ["a", "b"], buckets=2).count() == 4
    more = spark.createDataFrame([*rows, (2, "x", 4), (None, None, 5)], "a int, b string, c int")
    assert sorted(r["c"] for r in mark_seen_large(more, path, ["a", "b"], buckets=2).collect()) == [4, 5]
    assert mark_seen_large(more.filter("false"), path, ["a", "b"], buckets=2).count() == 0


def test_a_run_that_fails_gives_its_rows_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ledger")
    df = spark.range(50).withColumnRenamed("id", "k")

    def refuse(rows):
        raise OSError("refused")

    with pytest.raises(OSError):
        mark_seen_large(df, path, ["k"], refuse, buckets=2)
    # Lost after the bits were stored and before the keys.
    seen._bits(df.withColumns(seen._places(["k"], 2))).write.parquet(f"{path}/bits/run=1")
    got = []
    assert keys(mark_seen_large(df, path, ["k"], lambda rows: got.extend(keys(rows)), buckets=2)) == list(range(50)) == got
    assert mark_seen_large(df, path, ["k"], buckets=2).count() == 0
    (tmp_path / "ledger/bits/run=9").mkdir()
    assert mark_seen_large(df, path, ["k"], buckets=2).count() == 0
