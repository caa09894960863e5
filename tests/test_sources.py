import json
import os

import pytest
from pyspark.sql import functions as F

from flowframe.sources import feeds, files, tables, wire


def put(folder, name, data):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return path


def test_whole_files(spark, tmp_path):
    put(tmp_path, "a.txt", b"\x00\xffone")
    put(tmp_path, "b.bin", b"two")
    rows = files.file_contents_scan(spark, str(tmp_path), glob="*.txt").collect()
    assert [bytes(r["payload"]) for r in rows] == [b"\x00\xffone"]
    assert rows[0]["headers"] == {"contentType": "application/octet-stream"}


def test_lines_and_markers(spark, tmp_path):
    put(tmp_path, "one.txt", "dawn\ndusk\n")
    lines = files.file_lines_scan(spark, str(tmp_path), numbered=True)
    assert [r["payload"] for r in lines.orderBy("line_no").collect()] == ["dawn", "dusk"]
    marked = files.with_markers(lines).orderBy("path", "seq").collect()
    path = marked[0]["path"]
    assert [r["payload"] for r in marked] == [
        f'{{"filePath":"{path}","mark":"START","lineCount":0}}', "dawn", "dusk",
        f'{{"filePath":"{path}","mark":"END","lineCount":2}}',
    ]


def test_line_numbers_over_many_splits(spark, tmp_path, monkeypatch):
    wanted = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    put(tmp_path, "big.txt", "\n".join(wanted) + "\n")
    put(tmp_path, "small.txt", "only\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        for few in (100_000, 0):
            monkeypatch.setattr(files, "FEW_SPLITS", few)
            rows = files.file_lines_scan(spark, str(tmp_path), numbered=True)
            big = rows.filter("path LIKE '%big.txt'").orderBy("line_no").collect()
            assert len({r["split_start"] for r in big}) > 5
            assert [r["payload"] for r in big] == wanted
            assert [r["line_no"] for r in big] == list(range(1, 3001))
            marked = [(r["path"].rsplit("/", 1)[1], r["seq"], r["payload"].split('"mark"')[-1]) for r in files.file_lines_with_markers(spark, str(tmp_path)).collect()]
            assert sorted(marked) == sorted([
                *[("big.txt", i, line) for i, line in enumerate(wanted, 1)], ("big.txt", 0, ':"START","lineCount":0}'),
                ("big.txt", 3001, ':"END","lineCount":3000}'), ("small.txt", 0, ':"START","lineCount":0}'),
                ("small.txt", 1, "only"), ("small.txt", 2, ':"END","lineCount":1}'),
            ])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_small_files_are_packed_into_few_tasks(spark, tmp_path):
    for k in range(300):
        put(tmp_path, f"{k}.txt", f"a {k}\nb\n")
    where, before = str(tmp_path), spark.conf.get("spark.sql.files.openCostInBytes")
    wanted = [
        files.file_lines_scan(spark, where), files.file_lines_scan(spark, where, numbered=True),
        files.file_lines_with_markers(spark, where), files.file_contents_scan(spark, where), files.file_ref_listing(spark, where),
    ]
    for rows, n in zip(wanted, (600, 600, 1200, 300, 300), strict=True):
        assert rows.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism and rows.count() == n
        assert rows.sparkSession is spark and "Union" not in rows._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_small_files_are_cut_as_large_ones(spark, tmp_path, monkeypatch):
    """Line ends of all kinds, bytes that are no text, a mark at the beginning, packed and empty files."""
    import gzip

    for name, data in {
        "a.txt": b"one\r\ntwo\rthree\n\nend", "b.txt": b"\xef\xbb\xbfx\n", "c.txt": b"\xff\xfe\n\x0b\x0c\x1c\xc2\x85", "d.txt": b"", "e.txt": b"\n",
        "g.txt.gz": gzip.compress(b"p\nq\n"), "h i.txt": b"\n\r\n\n\rz\r",
    }.items():
        put(tmp_path, name, data)

    def read():
        lines = files.file_lines_scan(spark, str(tmp_path)).select("path", F.hex("payload").alias("payload"))
        numbered = files.file_lines_scan(spark, str(tmp_path), numbered=True).select("path", "line_no", F.hex("payload").alias("payload"))
        marked = files.file_lines_with_markers(spark, str(tmp_path)).select("path", "seq", F.hex("payload").alias("payload"))
        latin = files.file_lines_scan(spark, str(tmp_path), charset="ISO-8859-1", numbered=True).select("path", "line_no", "payload")
        return [sorted(map(tuple, rows.collect())) for rows in (lines, numbered, marked, latin)]

    small = read()
    assert [(r[0].rsplit("/", 1)[1], r[1]) for r in small[1] if r[0].endswith(".gz")] == [("g.txt.gz", 1), ("g.txt.gz", 2)]
    monkeypatch.setattr(files, "OPEN_COST", -1)
    monkeypatch.setattr(files, "_packing", lambda session: session)
    assert read() == small


def test_listing_in_tasks_is_that_of_the_readers(spark, tmp_path, monkeypatch):
    """Hidden, empty, packed and large files, odd names, folders in folders, patterns: all as Spark's own readers have them."""
    root = tmp_path / "r"
    names = ["a.txt", "b c.txt", "ü é.txt", "x%41.txt", "p+q&r.txt", "n;m,o.txt", "#h?.txt", "it's~(1).txt", "_no.txt", "_k=v/in.txt", "_no/in.txt", ".no/in.txt", ".no.txt",
             "d=1/e f/g.txt", "d=1/e f/h.csv", "w._COPYING_", "_metadata/m.txt", "_metadata.txt", "nb sp.txt", "deep/er/and/er/z.txt"]
    for name in names:
        put(root, name, f"{name}\nend")
    put(root, "large.txt", "line\n" * 60_000)
    os.symlink(root / "a.txt", root / "link.txt")
    os.symlink(root / "d=1", root / "linked")
    (root / "none").mkdir()

    def read():
        whole = files.file_contents_scan(spark, str(root))
        listing = files.file_ref_listing(spark, [str(root / "d=1"), str(root / "deep")], glob="{a,b c,[g-n]*,z}.t?t")
        lines = files.file_lines_with_markers(spark, str(root), glob="[a-h]*")
        return [whole.schema.simpleString(), listing.schema.simpleString(), *(sorted(map(repr, rows.collect())) for rows in (whole, listing, lines))]

    here = read()
    assert len(here[2]) > 15
    # Spark passes over files without bytes; here they are files like others.
    put(root, "none/empty.txt", "")
    assert [r["size"] for r in files.file_contents_scan(spark, str(root / "none")).collect()] == [0]
    monkeypatch.setattr(files, "listed_files", lambda *_: None)
    assert here == read()


def test_files_are_not_listed_on_the_driver(spark, tmp_path):
    for k in range(50):
        put(tmp_path, f"d{k % 3}/{k}.txt", f"{k}\n")
    for scan, n in ((files.file_contents_scan, 50), (files.file_lines_scan, 50), (files.file_lines_with_markers, 150), (files.file_ref_listing, 50)):
        rows = scan(spark, str(tmp_path))
        assert rows.count() == n and not any(one.endswith(".txt") for one in rows.inputFiles())
        if scan is not files.file_ref_listing:
            assert "FileScan" not in rows._jdf.queryExecution().executedPlan().toString()


def test_numbering_shuffles_no_lines(spark, tmp_path):
    for k in range(40):
        put(tmp_path, f"f{k}.txt", "".join(f"{k} {i}\n" for i in range(k)))
    for rows in (files.file_lines_scan(spark, str(tmp_path), numbered=True), files.file_lines_with_markers(spark, str(tmp_path))):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan
    rows = files.file_lines_scan(spark, str(tmp_path), numbered=True).collect()
    assert sorted(r["payload"] for r in rows) == sorted(f"{k} {i}" for k in range(40) for i in range(k))
    assert all(r["payload"].endswith(f" {r['line_no'] - 1}") for r in rows)
    ends = [json.loads(r["payload"]) for r in files.file_lines_with_markers(spark, str(tmp_path)).collect() if '"END"' in r["payload"]]
    assert sorted(e["lineCount"] for e in ends) == list(range(1, 40))


@pytest.mark.parametrize("charset", ["ISO-8859-1", "UTF-16LE"])
def test_lines_in_other_charsets(spark, tmp_path, charset):
    put(tmp_path, "x.txt", "é\nü ö\n\nend\n".encode(charset))
    rows = files.file_lines_scan(spark, str(tmp_path), charset=charset, numbered=True).orderBy("line_no").collect()
    assert [r["payload"] for r in rows] == ["é", "ü ö", "", "end"]


def test_listing_sorted_by_name(spark, tmp_path):
    for name in ("b.txt", "a.txt", "sub/c.txt"):
        put(tmp_path, name, name)
    os.symlink(tmp_path / "b.txt", tmp_path / ".hidden-link")
    up = files.file_ref_listing(spark, str(tmp_path), sort_by="filename")
    assert [r["name"] for r in up.collect()] == ["a.txt", "b.txt", "c.txt"]
    down = files.file_ref_listing(spark, str(tmp_path), sort_by="FILENAME", descending=True)
    assert [r["name"] for r in down.collect()] == ["c.txt", "b.txt", "a.txt"]
    assert "content" not in up.columns


def test_name_filters(spark):
    df = spark.createDataFrame([("leaf.csv",), ("root.csv",), ("leaf.csv.old",), ("d/leaf.csv",)], "name string")
    names = lambda out: [r["name"] for r in out.collect()]
    assert names(files.file_name_filter(df, regex="l.*[.]csv")) == ["leaf.csv"]
    assert names(files.file_name_filter(df, pattern="*.csv")) == ["leaf.csv", "root.csv"]
    assert names(files.file_name_filter(df, pattern="**/l?af.csv")) == ["leaf.csv", "d/leaf.csv"]
    assert names(files.file_name_filter(df, pattern="r*", regex="l.*")) == ["root.csv"]
    assert len(names(files.file_name_filter(df))) == 4


def test_accept_once_and_ledger(spark):
    listing = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), ("c", 3)], "path string, modified int")
    ledger = spark.createDataFrame([("a", 1), ("b", 9), ("z", 5)], "path string, modified int")
    accepted = files.accept_once(listing, ledger, key=["path"])
    assert sorted(map(tuple, accepted.collect())) == [("b", 2), ("c", 3)]
    merged = files.merge_ledger(ledger, accepted, key=["path"])
    assert sorted(map(tuple, merged.collect())) == [("a", 1), ("b", 2), ("c", 3), ("z", 5)]


def test_disposition(spark, tmp_path):
    for name in ("a.txt", "b.txt", "c.txt"):
        put(tmp_path, name, name)
    read = files.file_contents_scan(spark, str(tmp_path))
    rename = "IF(path LIKE '%a.txt', 'done/a.old', IF(path LIKE '%b.txt', 'b.old', ''))"
    rename = rename.replace("'done/a.old'", f"'{tmp_path}/done/a.old'")
    plan = files.plan_disposition(read, rename=rename)
    done = {os.path.basename(r["path"]): r["outcome"] for r in files.apply_disposition(plan.checkpoint()).collect()}
    assert done == {"a.txt": "renamed", "b.txt": "renamed", "c.txt": "left"}
    assert sorted(os.listdir(tmp_path)) == ["b.old", "c.txt", "done"]
    assert os.listdir(tmp_path / "done") == ["a.old"]
    gone = files.plan_disposition(files.file_contents_scan(spark, str(tmp_path / "c.txt")), delete=True).checkpoint()
    assert [r["outcome"] for r in files.apply_disposition(gone).collect()] == ["deleted"]
    assert [r["outcome"] for r in files.apply_disposition(gone).collect()] == ["gone"]
    with pytest.raises(ValueError):
        files.plan_disposition(read, delete=True, rename="'x'")


def test_multi_source(spark, tmp_path):
    put(tmp_path, "r1/in/a.txt", "one\n")
    put(tmp_path, "r2/in/b.txt", "two\n")
    rows = files.multi_source_read(
        spark, ["east.in", "west.in"], {"east": str(tmp_path / "r1"), "west": str(tmp_path / "r2")}
    ).collect()
    assert sorted((r["headers"]["sftp_selectedServer"], r["payload"]) for r in rows) == [("east", "one"), ("west", "two")]
    with pytest.raises(ValueError):
        files.multi_source_read(spark, ["no-dot"], {})


def test_query_source_rows_and_list(spark):
    table = spark.createDataFrame([(7, "elm", 3.5), (8, "oak", None), (9, "yew", 1.0)], "id long, tree string, height double")
    rows = tables.sql_query_source(spark, "SELECT id, tree FROM {wood} ORDER BY id", {"wood": table})
    assert [r["tree"] for r in rows.collect()] == ["elm", "oak", "yew"]
    assert tables.sql_query_source(spark, "SELECT * FROM {wood}", {"wood": table}, max_rows=2).count() == 2
    assert tables.rows_or_list(rows, ["id"]).count() == 3
    for chunks in (1, 3):
        parts = tables.rows_or_list(rows, ["id"], list_rows=2, chunks=chunks).orderBy("part").collect()
        assert [[(r["id"], r["tree"]) for r in one["payload"]] for one in parts] == [[(7, "elm"), (8, "oak")], [(9, "yew")]]
    with pytest.raises(ValueError):
        tables.jdbc_query_source(spark, "jdbc:none", "SELECT 1")


def test_mark_seen(spark, tmp_path):
    seen = str(tmp_path / "seen")
    df = spark.sql("SELECT id, IF(id = 4, NULL, id) AS k FROM range(5)")
    assert tables.mark_seen(df.filter("id < 3"), seen, ["k"]).count() == 3
    assert sorted(r["id"] for r in tables.mark_seen(df, seen, ["k"]).collect()) == [3, 4]
    assert tables.mark_seen(df, seen, ["k"]).count() == 0


def test_rows_are_marked_after_their_delivery(spark, tmp_path):
    seen, got = str(tmp_path / "seen"), []

    def refuse(rows):
        raise OSError("down")

    with pytest.raises(OSError):
        tables.mark_seen(spark.range(3), seen, ["id"], deliver=refuse)
    tables.mark_seen(spark.range(3), seen, ["id"], deliver=lambda rows: got.extend(r["id"] for r in rows.collect()))
    assert sorted(got) == [0, 1, 2] and tables.mark_seen(spark.range(3), seen, ["id"]).count() == 0


def test_document_query(spark):
    docs = spark.createDataFrame(
        [('{"bark":"rough","tree":"elm"}',), ('{"bark":"smooth","tree":"beech"}',), ('{"bark":"none"}',), ("{x",)],
        "doc string",
    )
    assert tables.document_query(docs, "doc", exists={"tree": True}).count() == 2
    assert tables.document_query(docs, "doc", exists={"tree": False}).count() == 2
    assert tables.document_query(docs, "doc", equals={"tree": "beech"}).first()["doc"].startswith('{"bark":"smooth"')
    assert tables.document_query(docs, "doc").count() == 4


def test_document_update(spark):
    texts = ['{"a":1,"b":{"c":[1,2]},"s":"x"}', '{"a":2}', "{bad", None, "[1]"]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, doc string")
    out = tables.document_update(docs, "doc", {"a": "z", "seen": None}, "i <> 1").orderBy("i").collect()
    assert json.loads(out[0]["doc"]) == {"b": {"c": [1, 2]}, "s": "x", "a": "z", "seen": None}
    assert [r["doc"] for r in out[1:]] == texts[1:]


def test_record_streams(spark):
    df = spark.createDataFrame(
        [("k", f"leaf {i}", "t" if i % 2 else "tt", 0, i) for i in range(1, 6)],
        "key string, value string, topic string, partition int, offset long",
    )
    assert [r["value"] for r in feeds.record_filter(df.filter("offset < 3"), "value = 'leaf 2'").collect()] == ["leaf 1"]
    assert feeds.record_stream_source(df, topics=["tt"], pattern="t").count() == 3
    assert feeds.record_stream_source(df, topics=["tt"]).count() == 2
    for chunks in (1, 4):
        out = feeds.record_stream_source(df, topics=["t"], batch_rows=2, chunks=chunks).orderBy("batch").collect()
        assert [(r["n"], r["payload"]) for r in out] == [(2, ["leaf 1", "leaf 3"]), (1, ["leaf 5"])]
    with pytest.raises(ValueError):
        feeds.record_stream_source(df)


def test_cdc(spark):
    changes = spark.createDataFrame(
        [("r", None, '{"id":1,"name":"a"}', 1), ("u", '{"id":1,"name":"a"}', '{"id":1,"name":"b"}', 2),
         ("d", '{"id":2,"name":"c"}', None, 3)],
        "op string, before string, after string, seq int",
    )
    flat = feeds.cdc_flatten(changes, "id int, name string", metadata={"__table": "'customers'", "seq": "seq"})
    assert [tuple(r) for r in flat.collect()] == [
        (1, "a", "false", "r", "customers", 1), (1, "b", "false", "u", "customers", 2), (2, "c", "true", "d", "customers", 3),
    ]
    now = feeds.cdc_latest(flat, ["id"], ["seq"], deleted="__deleted = 'true'").collect()
    assert [(r["id"], r["name"]) for r in now] == [(1, "b")]
    keyed = spark.createDataFrame([("k", None), ("k", "v")], "key string, payload string")
    assert feeds.without_tombstones(keyed).count() == 1


def test_header_names(spark):
    df = spark.sql("SELECT map('a1', '1', 'b', '2') AS headers")
    assert feeds.header_names(df, ["a*"]).first()["headers"] == {"a1": "1"}
    assert feeds.header_names(df).first()["headers"] == {"a1": "1", "b": "2"}


def test_read_above_the_mark(spark, tmp_path):
    mark, got = str(tmp_path / "mark"), []
    take = lambda rows: got.append(sorted(r["id"] for r in rows.collect()))
    assert feeds.read_new(spark.range(0), mark, take) is None
    assert feeds.read_new(spark.range(1, 5), mark, take) == 4
    assert feeds.read_new(spark.range(1, 5), mark, take) == 4
    assert feeds.read_new(spark.range(2, 9), mark, take) == 8
    assert got == [[1, 2, 3, 4], [5, 6, 7, 8]]

    def refuse(rows):
        raise OSError("down")

    with pytest.raises(OSError):
        feeds.read_new(spark.range(12), mark, refuse)
    assert feeds.read_new(spark.range(12), mark, take) == 11 and got[-1] == [9, 10, 11]


def test_pages_of_new_rows(spark):
    df = spark.range(1, 11)
    assert feeds.incremental_read(df, 7).count() == 3
    for chunks in (1, 3):
        paged = feeds.incremental_read(df, 2, page_size=3, chunks=chunks).orderBy(F.desc("id")).collect()
        assert [(r["id"], r["page"]) for r in paged] == [(10 - i, i // 3) for i in range(8)]
    assert feeds.high_mark(df).first()["since"] == 10


def test_first_seen(spark):
    df = spark.createDataFrame([(1, 3, "late"), (1, 1, "first"), (2, 2, None)], "id int, at int, v string")
    assert sorted(map(tuple, feeds.first_seen_dedup(df, ["id"], ["at"]).collect())) == [(1, 1, "first"), (2, 2, None)]


def test_stream_filter(spark):
    df = spark.createDataFrame(
        [(1, "Spark rocks", 7, "en", 1.0, 1.0, "none"), (2, "sparkling", 8, "en", 50.0, 50.0, "medium"),
         (3, "on rocks: SPARK!", 9, "fr", 0.0, 0.0, "low")],
        "id int, text string, author_id int, lang string, lat double, lon double, filter_level string",
    )
    ids = lambda **o: [r["id"] for r in feeds.stream_filter(df, **o).collect()]
    assert ids() == [1, 2, 3]
    assert ids(track=["spark"]) == [1, 3]
    assert ids(track=["rocks spark"], languages=["fr"]) == [3]
    assert ids(follow=[8], boxes=[(0.5, 0.5, 2, 2)]) == [1, 2]
    assert ids(boxes=[(40, 40, 60, 60), (-1, -1, 0, 0)]) == [2, 3]
    assert ids(min_level="low") == [2, 3]


def test_syslog(spark):
    lines = ["<37>Feb  3 04:05:06 tower cron[81]: job 9 done", "free text"]
    good, bad = wire.syslog_parse(spark.createDataFrame([(x,) for x in lines], "payload string")).collect()
    assert (good["HOST"], good["FACILITY"], good["SEVERITY"], good["TAG"], good["MESSAGE"]) == ("tower", 4, 5, "cron", "job 9 done")
    assert not good["parse_error"] and bad["parse_error"] and bad["HOST"] is None
    line = '<93>1 2031-02-03T04:05:06.7Z mast - 4711 ID7 [a@1 x="\\]" y="2"][b] wind: 7 bft'
    row = wire.syslog_parse(spark.createDataFrame([(line,)], "payload string"), rfc="5424").first()
    assert (row["syslog_HOST"], row["syslog_FACILITY"], row["syslog_SEVERITY"], row["syslog_PROCID"]) == ("mast", 11, 5, "4711")
    assert row["syslog_SD"] == ['[a@1 x="\\]" y="2"]', "[b]"] and row["syslog_APP_NAME"] is None
    assert row["syslog_MESSAGE"] == "wind: 7 bft" and row["syslog_MSGID"] == "ID7"


ENDS = {"CRLF": b"\r\n", "LF": b"\n", "NULL": b"\x00", "STXETX": b"\x03"}


@pytest.mark.parametrize("encoding", [*ENDS, "L1", "L2", "L4"])
def test_frames(spark, encoding):
    """Records of bytes that are no UTF-8 come out as they went in."""
    records = [b"ab\xff\xfe", b"", b"\x80c"]
    if encoding in ENDS:
        data = b"".join((b"\x02" if encoding == "STXETX" else b"") + x + ENDS[encoding] for x in records)
    else:
        data = b"".join(len(x).to_bytes(int(encoding[1]), "big") + x for x in records)
    out = wire.frame_split(spark.createDataFrame([(data,)], "payload binary"), encoding)
    assert dict(out.dtypes)["payload"] == "binary"
    assert [bytes(r["payload"]) for r in out.collect()] == records
    assert all(r["record_error"] is None for r in out.collect())


def test_frame_errors(spark):
    raw = spark.createDataFrame([(b"\xe9\xe8!",)], "payload binary")
    assert [bytes(r["payload"]) for r in wire.frame_split(raw, "RAW", max_record=3).collect()] == [b"\xe9\xe8!"]
    assert [r["record_error"] for r in wire.frame_split(raw, "RAW", max_record=3).collect()] == [None]
    assert [r["record_error"] for r in wire.frame_split(raw, "RAW", max_record=2).collect()] == ["record too long"]
    cut = spark.createDataFrame([(b"\x02a\x03b\x03\x02\x03\x02c",)], "data binary")
    rows = wire.frame_split(cut, "STXETX", payload="data", correlate="7").collect()
    assert [(bytes(r["payload"]), r["record_error"], r["sequence_number"], r["sequence_size"]) for r in rows] == [
        (b"a", None, 1, 4), (b"b", "no start of record", 2, 4), (b"", None, 3, 4), (b"c", "incomplete record", 4, 4),
    ]
    lines = spark.createDataFrame([("öne\n\ntwo",), ("",), ("x\n",)], "payload string")
    rows = wire.frame_split(lines, "LF", correlate="7").collect()
    assert [(bytes(r["payload"]).decode(), r["record_error"], r["sequence_number"], r["sequence_size"]) for r in rows] == [
        ("öne", None, 1, 3), ("", None, 2, 3), ("two", "incomplete record", 3, 3), ("x", None, 1, 1),
    ]
    short = spark.createDataFrame([(b"\x00\x02ab\x00\x09xy",)], "payload binary")
    assert [r["record_error"] for r in wire.frame_split(short, "L2").collect()] == [None, "incomplete record"]


def test_json_documents(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    assert [r["payload"] for r in tables.document_rows(df).collect()] == ['{"id":1,"name":"a"}', '{"id":2,"name":"b"}']
    one = tables.document_rows(df, group_by=[], order_by=["id"], list_rows=9).collect()
    assert [r["payload"] for r in one] == ['[{"id":1,"name":"a"},{"id":2,"name":"b"}]']
