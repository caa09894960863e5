import datetime as dt

from flowframe.operators.aggregate import aggregate
from flowframe.sources.feeds import clock_source
from flowframe.streaming import flows
from flowframe.streaming.regroup import keyed_aggregate, whole_groups

START = dt.datetime(2024, 1, 1)
SCHEMA = "k string, i int, ts timestamp, closing boolean, size int"


def rows():
    out, second = [], 0
    for i in range(120):
        second += 30 if i % 17 == 0 else 1
        out.append((["a", "a", "b", None][i % 4], i, START + dt.timedelta(seconds=second), i % 7 == 0, 3))
    return out


def deliver(spark, tmp_path, consume, data, cuts=3):
    source = str(tmp_path / "source")
    step = -(-len(data) // cuts)
    for start in range(0, len(data), step):
        spark.createDataFrame(data[start:start + step], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        consume(flows.file_stream(spark, source, "parquet", schema=SCHEMA), str(tmp_path / "checkpoint"))


def test_state_store_aggregator(spark, tmp_path):
    data = [row for row in rows() if row[0] is not None]

    def consume(stream, place):
        groups = keyed_aggregate(stream, "k", ["ts", "i"], payload="i", count=5, closes="closing")
        flows.run_available(groups, place, path=str(tmp_path / "out"))

    deliver(spark, tmp_path, consume, data)
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    df = spark.createDataFrame(data, SCHEMA)
    wanted = aggregate(df, {"k": "k"}, ["ts", "i"], payload="CAST(i AS STRING)", count=5, closes="closing").collect()
    assert sorted((r["key"], r["payloads"]) for r in out) == sorted((r["k"], r["payloads"]) for r in wanted)
    assert {r["reason"] for r in out} == {"count", "closed"}


def test_state_store_sequences_start_anew(spark, tmp_path):
    told = [2, 2, 3, 3, 3, 1, 2, 2, 2, 3]
    data = [("a", i, START + dt.timedelta(seconds=i), False, size) for i, size in enumerate(told)]

    def consume(stream, place):
        flows.run_available(keyed_aggregate(stream, "k", ["i"], payload="i", size="size"), place, path=str(tmp_path / "out"))

    deliver(spark, tmp_path, consume, data, cuts=4)
    out = sorted(r["payloads"] for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert out == [["0", "1"], ["2", "3", "4"], ["5"], ["6", "7"]]


def test_accepts_every_version_once(spark, tmp_path):
    data = [("f", i, START + dt.timedelta(seconds=i), False, size) for i, size in enumerate([1, 1, 2, 2, 1, 3])]
    data += [("g", 9, START, False, None), ("g", 10, START, False, None)]

    def consume(stream, place):
        flows.run_available(flows.accept_stream(stream, "k", "size", ["i"]), place, path=str(tmp_path / "out"))

    deliver(spark, tmp_path, consume, data, cuts=4)
    assert sorted(r["i"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 2, 4, 5, 9]


def test_first_and_latest_by_key(spark, tmp_path):
    data = [row for row in rows() if row[0] is not None]

    def consume(stream, place):
        for name, pick in (("first", flows.first_by_key), ("latest", flows.latest_by_key)):
            each = flows.changes_each(str(tmp_path / name))
            flows.run_available(pick(stream, ["k"], ["ts", "i"]), f"{place}-{name}", each=each, mode="update")

    deliver(spark, tmp_path, consume, data)
    found = {name: {r["k"]: r["i"] for r in flows.read_changes(spark, str(tmp_path / name), ["k"]).collect()} for name in ("first", "latest")}
    assert found == {pick: {k: end(r[1] for r in data if r[0] == k) for k in "ab"} for pick, end in (("first", min), ("latest", max))}


def test_polling_at_an_interval(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    stream = flows.file_stream(spark, str(tmp_path / "in"), "parquet", schema="id long")
    query = flows.run_polling(stream, str(tmp_path / "c"), interval="1 second", path=str(tmp_path / "out"))
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_state_store_rule_over_the_group_and_parts(spark, tmp_path):
    data = [("a", i, START, False, 1) for i in range(10)]

    def at_least_six(total, payload):
        total = (total or 0) + int(payload)
        return total, total >= 6

    def consume(stream, place):
        groups = keyed_aggregate(stream, "k", ["i"], payload="i", until=at_least_six, list_rows=50)
        flows.run_available(groups, place + "-1", path=str(tmp_path / "sums"))
        parts = keyed_aggregate(stream, "k", ["i"], payload="i", closes="i = 7", list_rows=3)
        flows.run_available(parts, place + "-2", path=str(tmp_path / "parts"))

    deliver(spark, tmp_path, consume, data, cuts=2)
    sums = [r["payloads"] for r in spark.read.parquet(str(tmp_path / "sums")).collect()]
    assert sorted(sums) == [["0", "1", "2", "3"], ["4", "5"], ["6"], ["7"], ["8"], ["9"]]
    parts = [(r["reason"], r["payloads"]) for r in spark.read.parquet(str(tmp_path / "parts")).collect()]
    assert sorted(parts) == [("closed", ["6", "7"]), ("part", ["0", "1", "2"]), ("part", ["3", "4", "5"])]


def test_pieces_carry_start_and_total_and_make_whole_groups(spark, tmp_path):
    data = [("a", i, START, False, 1) for i in range(24)]

    def consume(stream, place):
        parts = keyed_aggregate(stream, "k", ["i"], payload="i", closes="i IN (7, 8, 16)", list_rows=3)
        flows.run_available(parts, place, path=str(tmp_path / "out"))

    deliver(spark, tmp_path, consume, data, cuts=4)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["group_start"], r["n"], r["reason"]) for r in out.collect()) == [
        (1, 3, "part"), (1, 6, "part"), (1, 8, "closed"), (9, 1, "closed"),
        (10, 3, "part"), (10, 6, "part"), (10, 8, "closed"), (18, 3, "part"), (18, 6, "part"),
    ]
    groups = sorted(tuple(r) for r in whole_groups(out).collect())
    assert groups == [
        ("a", first + 1, last - first, "closed", [str(i) for i in range(first, last)]) for first, last in ((0, 8), (8, 9), (9, 17))
    ]


def test_registered_groups_of_any_length_match_their_sql(spark, tmp_path):
    """A hot user: 1,300 messages to a purchase, without an idle gap, and 1,100 that never end."""
    import duckdb

    from __spark_entry__ import oracle_sql, queries

    kinds = ["view"] * 1299 + ["purchase"] + ["view", "error"] * 550
    hot = [(i, 1, START + dt.timedelta(minutes=20 * i), kind) for i, kind in enumerate(kinds)]
    cold = [(5000 + i, 2, START + dt.timedelta(days=i), "purchase" if i % 3 else "view") for i in range(50)]
    path = f"{tmp_path}/events.parquet"
    schema = "event_id long, user_id long, ts timestamp_ntz, event_type string"
    spark.createDataFrame(hot + cold, schema).coalesce(1).write.parquet(path)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW events AS SELECT * FROM '{path}/*.parquet'")
        for name in (
            "aggregate_release_predicate", "aggregate_group_timeout", "aggregate_output",
            "stream_aggregate_predicate", "stream_group_timeout",
        ):
            found = queries()[name](spark, str(tmp_path))
            wanted = db.execute(oracle_sql()[name])
            assert found.columns == [column[0] for column in wanted.description], name
            assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, wanted.fetchall())), name


def test_a_key_costs_few_calls_of_the_state_store():
    from pyspark.sql import Row

    from flowframe.streaming.regroup import _processor

    class State:
        calls = 0

        def __init__(self):
            self.value = None

        def told(self, *value):
            State.calls += 1
            if value:
                self.value = value[0]
            return self.value

        get = put = update = told
        exists = lambda self: self.told() is not None

        def clear(self):
            self.told(None)

    class Handle:
        def getListState(self, *_):
            return State()

        getValueState = getListState

    groups = _processor(None, None, None, 1000)
    groups.init(Handle())
    batch = [Row(order0=at, at=0, size=None, closes=at == 2, payload=str(at)) for at in (3, None, 1, 2)]
    out = list(groups.handleInputRows(("k",), iter(batch), None))
    assert [(r["group_start"], r["n"], r["reason"], r["payloads"]) for r in out] == [(1, 2, "closed", ["1", "2"])]
    out = list(groups.handleInputRows(("k",), iter([Row(order0=9, at=0, size=None, closes=True, payload="9")]), None))
    assert [(r["group_start"], r["n"], r["reason"], r["payloads"]) for r in out] == [(3, 3, "closed", ["3", "None", "9"])]
    assert State.calls == 7


def test_state_store_idle_timeout(spark, tmp_path):
    data = [row for row in rows() if row[0] is not None]

    def consume(stream, place):
        groups = keyed_aggregate(
            stream.withWatermark("ts", "0 seconds"), "k", ["ts", "i"], payload="i", idle_seconds=10, time="ts", list_rows=1000
        )
        flows.run_available(groups, place, path=str(tmp_path / "out"))

    deliver(spark, tmp_path, consume, data)
    out = sorted((r["key"], r["payloads"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    df = spark.createDataFrame(data, SCHEMA)
    whole = aggregate(df, {"k": "k"}, ["ts", "i"], payload="CAST(i AS STRING)", gap="10 seconds", time="ts", list_rows=1000).collect()
    wanted = sorted((r["k"], r["payloads"]) for r in whole)
    # The last group of a key stays open: no later message moves the watermark on.
    assert set(map(repr, out)) <= set(map(repr, wanted))
    assert len(wanted) - len(out) <= 2


def test_dedup_with_watermark(spark, tmp_path):
    data = rows() + rows()

    def consume(stream, place):
        flows.run_available(
            flows.stream_dedup(stream, ["i"], time="ts", delay="1 hour").select("i"), place, path=str(tmp_path / "out")
        )

    deliver(spark, tmp_path, consume, data)
    assert sorted(r["i"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(120))


def test_file_stream_archives_what_it_read(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "done"
    source.mkdir()
    for name in ("a.txt", "b.txt", "c.txt"):
        (source / name).write_text(name + "\n")
        stream = flows.file_stream(spark, str(source), "text", max_files=1, clean="archive", archive_dir=str(archive))
        flows.run_available(stream, str(tmp_path / "checkpoint"), path=str(tmp_path / "out"))
    read = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["value"] for r in read.collect()) == ["a.txt", "b.txt", "c.txt"]


def test_clock(spark):
    stream = clock_source(spark, date_format="yyyy")
    assert stream.isStreaming and "payload" in stream.columns
