import random

import pytest

from flowframe.plans import ordered
from flowframe.sources import wire


@pytest.fixture(autouse=True, scope="module")
def many_borders():
    before, ordered.BORDER_SAMPLE = ordered.BORDER_SAMPLE, 1
    yield
    ordered.BORDER_SAMPLE = before


def framed(record, encoding):
    if encoding in wire.LENGTH_BYTES:
        return len(record).to_bytes(wire.LENGTH_BYTES[encoding], "big") + record
    start = b"\x02" if encoding == "STXETX" else b""
    return start + record + wire.DELIMITERS[encoding].encode()


def cut(rng, data, low=1, high=9):
    at, out = 0, []
    while at < len(data):
        size = rng.randint(low, high)
        out.append(data[at:at + size])
        at += size
    return out


def split(spark, connections, encoding, **options):
    rows = [(conn, k, chunk) for conn, chunks in connections.items() for k, chunk in enumerate(chunks)]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "conn string, seq int, payload binary")
    out = wire.frame_split_stream(df, encoding, ["conn"], ["seq"], **options).collect()
    return {conn: [(r["record_at"], bytes(r["payload"]), r["record_error"]) for r in sorted(out, key=lambda r: r["record_at"]) if r["conn"] == conn]
            for conn in connections}


@pytest.mark.parametrize("encoding", ["LF", "CRLF", "NULL", "STXETX", "L1", "L2", "L4"])
def test_records_come_back_whole(spark, encoding):
    rng = random.Random(encoding)
    alphabet = [97, 98, 13, 255, 1] if encoding not in ("CRLF",) else [97, 98, 13, 255]
    connections, want = {}, {}
    for conn, n in (("hot", 150), ("few", 3), (None, 20)):
        records = [bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(n)]
        if encoding == "CRLF":
            records = [r.rstrip(b"\r") for r in records]
        data, places = b"", []
        for record in records:
            places.append(len(data))
            data += framed(record, encoding)
        connections[conn] = [b"", *cut(rng, data, high=rng.choice([2, 9, 40])), None]
        want[conn] = [(at, record, None) for at, record in zip(places, records, strict=True)]
    for block in (64, 300, wire.STREAM_BLOCK):
        assert split(spark, connections, encoding, max_record=40, block=block) == want


@pytest.mark.parametrize("block", [32, 4096])
def test_faulty_ends_and_long_records(spark, block):
    options = {"max_record": 20, "block": block}
    long = b"x" * 90
    got = split(spark, {"a": [b"one\n", long, b"\ntw", b"o\nopen"], "b": [b"\n\n"], "c": [long]}, "LF", **options)
    assert got == {
        "a": [(0, b"one", None), (4, b"x" * 20, "record too long"), (95, b"two", None), (99, b"open", "incomplete record")],
        "b": [(0, b"", None), (1, b"", None)], "c": [(0, b"x" * 20, "record too long")],
    }
    got = split(spark, {"a": [b"\x02one\x03t", b"wo\x03\x02x"]}, "STXETX", **options)
    assert got["a"] == [(0, b"one", None), (5, b"two", "no start of record"), (9, b"x", "incomplete record")]
    got = split(spark, {"a": [b"one\r", b"\ntwo\r"], "b": [b"\r\r", b"\n"]}, "CRLF", **options)
    assert got == {"a": [(0, b"one", None), (5, b"two\r", "incomplete record")], "b": [(0, b"\r", None)]}
    got = split(spark, {"a": [b"\x00", b"\x03one\x00\x63", long, b"\x00\x01x"], "b": [b"\x00\x02h"], "c": [b"\x00\x01a\x00"]}, "L2", **options)
    assert got["a"][0] == (0, b"one", None) and got["a"][1][0] == 5 and got["a"][1][2] == "record too long" and len(got["a"]) == 2
    assert got["b"] == [(0, b"\x00\x02h", "incomplete record")] and got["c"] == [(0, b"a", None), (3, b"\x00", "incomplete record")]


def test_maps_of_length_prefixes_against_a_loop():
    rng = random.Random(4)
    for width, most in ((1, 9), (2, 9), (4, 9)):
        records = [bytes(rng.randint(0, most)) for _ in range(200)]
        data = b"".join(len(r).to_bytes(width, "big") + r for r in records)
        size, state, begins = 50, (0).to_bytes(4, "little"), []
        functions = []
        for low in range(0, len(data), size):
            part = data[low:low + size + width + most + 1]
            functions.append(wire.length_function(part, min(size, len(part)), width, most))
            begins.append(int.from_bytes(state, "little"))
            state = wire._apply_length(functions[-1], state)
        at, want = 0, []
        for low in range(0, len(data), size):
            while at < low:
                at += width + int.from_bytes(data[at:at + width], "big")
            want.append(at - low)
        assert begins == want
        whole = functions[0]
        for f in functions[1:]:
            whole = wire._compose_lengths(whole, f)
        assert wire._apply_length(whole, (0).to_bytes(4, "little")) == state


@pytest.mark.parametrize("encoding", ["LF", "L2"])
def test_records_and_maps_leave_in_small_batches(spark, monkeypatch, encoding):
    """What a task gathers does not grow with the blocks it is given, and only connections of several blocks need maps."""
    import pyarrow as pa

    from flowframe.plans import spans

    sizes, mapped = spark.sparkContext.accumulator(0), []
    monkeypatch.setattr(wire, "GATHERED", 4096)
    whole = spans.entering_states

    def seen(maps, *rest):
        mapped.extend(maps.select("key.conn").distinct().collect())
        return whole(maps, *rest)

    monkeypatch.setattr(wire, "entering_states", seen)
    frame = type(spark.range(0))
    maps_in_arrow = frame.mapInArrow

    def watched(df, function, schema):
        def batches(rows):
            for batch in function(rows):
                assert isinstance(batch, pa.RecordBatch) and batch.num_rows <= 4096 // 200 + 1
                sizes.add(1)
                yield batch

        return maps_in_arrow(df, batches, schema)

    monkeypatch.setattr(frame, "mapInArrow", watched)
    connections = {f"c{k}": [framed(b"%d" % i, encoding) for i in range(30)] for k in range(40)}
    connections["long"] = [framed(b"x" * 20, encoding) * 10] * 5
    got = split(spark, connections, encoding, max_record=40, block=300)
    assert all([r[1] for r in got[f"c{k}"]] == [b"%d" % i for i in range(30)] for k in range(40))
    assert [r[1] for r in got["long"]] == [b"x" * 20] * 50 and sizes.value > 40
    assert [r["conn"] for r in mapped] == (["long"] if encoding == "L2" else [])


def test_empty_frames_and_unknown_framings(spark):
    assert split(spark, {"a": [b"", None]}, "LF") == {"a": []} and split(spark, {"a": [None]}, "L4") == {"a": []}
    df = spark.createDataFrame([], "conn string, seq int, payload binary")
    with pytest.raises(ValueError):
        wire.frame_split_stream(df, "RAW", ["conn"], ["seq"])
    with pytest.raises(ValueError):
        wire.frame_split_stream(df, "LF", ["conn"], ["seq"], max_record=100, block=50)
