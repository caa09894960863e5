import datetime as dt
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowframe.operators.delivery import Backoff, delivery_retry, delivery_stream
from flowframe.operators.http import exchanged, http_enrich
from flowframe.sinks import tables
from flowframe.sources.files import capped_poll
from flowframe.streaming.flows import file_stream

START = dt.datetime(2024, 1, 1)


def test_attempts_due_times_and_dead_letters(spark):
    def receiver():
        return lambda batch: [f"no {a}" if a <= n else None for n, a in zip(batch.column("refusals").to_pylist(), batch.column("attempt").to_pylist())]

    df = spark.createDataFrame([(k, k, START) for k in range(7)], "id int, refusals int, at timestamp")
    out = delivery_retry(df, receiver, "at", backoff=Backoff(attempts=5, first=2, most=9, factor=3)).collect()
    got = sorted((r["id"], r["attempt"], (r["due"] - START).total_seconds(), r["outcome"], r["error"]) for r in out)
    due = [0, 2, 8, 17, 26]
    want = []
    for k in range(7):
        for attempt in range(1, min(k + 1, 5) + 1):
            failed = attempt <= k
            want.append((k, attempt, due[attempt - 1], "delivered" if not failed else "dead" if attempt == 5 else "retry", f"no {attempt}" if failed else None))
    assert got == want
    assert delivery_retry(df.filter("false"), receiver, "at").collect() == []
    for wrong in ({"attempts": 0}, {"first": -1}, {"most": 0.5}, {"factor": 0.5}):
        with pytest.raises(ValueError):
            Backoff(**wrong)


def test_failed_records_wait_on_a_stream(spark, tmp_path):
    folder = tmp_path / "in"
    spark.createDataFrame([("a", "0"), ("a", "1"), ("b", "9")], "k string, p string").write.parquet(str(folder))

    def flaky():
        return lambda payload, attempt: f"no {attempt}" if attempt <= int(payload) else None

    stream = file_stream(spark, str(folder), "parquet", schema="k string, p string")
    done = delivery_stream(stream, "k", "p", flaky, backoff=Backoff(attempts=3, first=0.2, most=1))
    name = f"delivered_{time.time_ns()}"
    run = done.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="300 milliseconds").start()
    try:
        rows, until = [], time.time() + 90
        while len(rows) < 6 and time.time() < until:
            time.sleep(0.5)
            rows = spark.table(name).collect()
    finally:
        run.stop()
    assert sorted((r["key"], r["payload"], r["attempt"], r["outcome"]) for r in rows) == [
        ("a", "0", 1, "delivered"), ("a", "1", 1, "retry"), ("a", "1", 2, "delivered"),
        ("b", "9", 1, "retry"), ("b", "9", 2, "retry"), ("b", "9", 3, "dead"),
    ]


def requests(n, per_batch=50):
    kinds = {"request_method": pa.string(), "request_url": pa.string(), "request_headers": pa.map_(pa.string(), pa.string()), "request_body": pa.string()}
    for low in range(0, n, per_batch):
        rows = range(low, min(low + per_batch, n))
        columns = [pa.array([v(i) for i in rows], kind) for v, kind in zip((lambda i: "GET", lambda i: f"u{i}", lambda i: None, lambda i: None), kinds.values())]
        yield pa.RecordBatch.from_arrays(columns, names=list(kinds))
    yield pa.RecordBatch.from_arrays([pa.array([], kind) for kind in kinds.values()], names=list(kinds))


def test_a_window_of_requests_is_faster_and_keeps_the_order():
    def slow():
        def send(method, url, headers, body, timeout):
            time.sleep(0.02)
            return {"status": 200, "body": url}

        return send

    times, bodies = {}, {}
    for in_flight in (1, 16):
        started = time.perf_counter()
        out = list(exchanged(requests(160), slow, 5.0, in_flight, True))
        times[in_flight] = time.perf_counter() - started
        bodies[in_flight] = [b for batch in out for b in batch.column("reply_body").to_pylist()]
        assert [batch.num_rows for batch in out] == [50, 50, 50, 10, 0]
    assert bodies[1] == bodies[16] == [f"u{i}" for i in range(160)]
    assert times[1] > 8 * times[16]


def test_late_and_failed_requests_are_rows_or_fail_the_task(spark):
    def uneven():
        def send(method, url, headers, body, timeout):
            if url == "u1":
                raise OSError("gone")
            if url == "u2":
                time.sleep(2.5)
            return {"status": 200, "body": url}

        return send

    rows = [row for batch in exchanged(requests(4), uneven, 0.2, 4, False) for row in batch.to_pylist()]
    assert [r["reply_body"] for r in rows] == ["u0", None, None, "u3"]
    assert [r["reply_error"] for r in rows] == [None, "OSError: gone", "no reply within 0.2 s", None]
    with pytest.raises(OSError):
        list(exchanged(requests(4), uneven, 5.0, 4, True))
    with pytest.raises(TimeoutError):
        list(exchanged((b.slice(2) for b in requests(4)), uneven, 0.2, 4, True))
    df = spark.createDataFrame([("u1",), ("u5",)], "payload string")
    out = http_enrich(df, uneven, "payload", in_flight=4, errors="rows").collect()
    assert [(r["payload"], r["reply_error"]) for r in out] == [(None, "OSError: gone"), ("u5", None)]
    for wrong in ({"errors": "maybe"}, {"in_flight": 0}):
        with pytest.raises(ValueError):
            http_enrich(df, uneven, "payload", **wrong)


def plain_polls(counts, sources, cap, fair, polls):
    """Row by row round the sources, as a reader would."""
    left = {name: list(range(counts.get(name, 0))) for name in sources}
    out, at = [], 0
    for _ in range(polls):
        taken = []
        while len(taken) < cap and any(left.values()):
            name = sources[at % len(sources)]
            if left[name]:
                taken.append((name, left[name].pop(0)))
            if fair or not left[name]:
                at += 1
        out.append(sorted(taken))
    return out


@pytest.mark.parametrize("fair", [True, False])
@pytest.mark.parametrize("cap", [1, 4, 7, 100])
def test_capped_polls_take_turns(spark, cap, fair):
    counts, sources = {"a": 9, "b": 1, "c": 4, "x": 50}, ["a", "b", "none", "c"]
    df = spark.createDataFrame([(name, i) for name, n in counts.items() for i in range(n)], "source string, i int")
    start, got = 0, []
    for _ in range(4):
        taken, start = capped_poll(df, sources, cap, ["i"], fair=fair, start=start)
        rows = sorted((r["source"], r["i"]) for r in taken.collect())
        got.append(rows)
        gone = spark.createDataFrame(rows, "source string, i int") if rows else df.limit(0)
        df = spark.createDataFrame(sorted({tuple(r) for r in df.collect()} - {tuple(r) for r in gone.collect()}), "source string, i int")
    assert got == plain_polls(counts, sources, cap, fair, 4)
    with pytest.raises(ValueError):
        capped_poll(df, sources, 0, ["i"])


def test_only_buckets_with_changes_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.create_buckets(spark.range(1000).selectExpr("id", "id * 2 AS v", "1 AS at"), path, ["id"], 16)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("*/*.parquet")}
    assert len({f.parent for f in before}) == 16
    changes = spark.createDataFrame([(7, 70, 1), (7, 71, 3), (7, 72, 2), (2000, 5, 1)], "id long, v long, at int")
    assert tables.upsert_buckets(spark, path, changes, ["id"], ["at"], 16) in (1, 2)
    table = {r["id"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert table == {i: 2 * i for i in range(1000)} | {7: 71, 2000: 5}
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("*/*.parquet")}
    assert len({f.parent for f in before.keys() - after.keys()}) <= 2
    assert all(after[f] == before[f] for f in before.keys() & after.keys()) and len(before.keys() & after.keys()) >= 14
    assert tables.upsert_buckets(spark, path, changes, ["id"], ["at"], 16) in (1, 2)
    assert {r["id"]: r["v"] for r in spark.read.parquet(path).collect()} == table
    assert tables.upsert_buckets(spark, path, changes.filter("false"), ["id"], ["at"], 16) == 0
    only = spark.createDataFrame([(8, 1, 1), (3000, 1, 1)], "id long, v long, at int")
    tables.upsert_buckets(spark, path, only, ["id"], ["at"], 16, update_only=True)
    assert {r["id"]: r["v"] for r in spark.read.parquet(path).collect()} == table | {8: 1}


def test_candidates_of_two_types(spark):
    df = spark.createDataFrame([(None, ("a",)), (5, ("b",)), (None, (None,))], "x int, payload struct<x: string>")
    out = tables.column_map_insert(df, "c: x, d: payload.x")
    assert out.dtypes[0] == ("c", "string") and [(r["c"], r["d"]) for r in out.collect()] == [("a", "a"), ("5", "b"), (None, None)]
    same = tables.column_map_insert(df.withColumn("x", F.lit("k")), "c: x")
    assert [r["c"] for r in same.collect()] == ["k"] * 3
