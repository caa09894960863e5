import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from flowframe.functions.settings import parse_column_map
from flowframe.operators import metrics
from flowframe.sinks.objects import write_objects
from flowframe.sinks import routes, tables


def rows_of(df):
    return [tuple(row) for row in df.collect()]


def test_counter_by_name(spark):
    df = spark.createDataFrame([("maple",)] * 7 + [("elm",)] * 2, "payload string")
    assert sorted(rows_of(metrics.metric_counter(df, "payload"))) == [("elm", 2.0), ("maple", 7.0)]
    assert rows_of(metrics.metric_counter(df, "'n'", amount="length(payload)")) == [("n", 41.0)]


def test_literal_tags_make_one_meter(spark):
    df = spark.createDataFrame([("x",)] * 5, "payload string")
    out = metrics.metric_counter(df, "'m'", fixed={"site": "north", "unit": "cm"})
    assert out.columns == ["name", "tag_site", "tag_unit", "amount"]
    assert rows_of(out) == [("m", "north", "cm", 5.0)]


@pytest.mark.parametrize("seen,value", [(1, 2), (2, 9), (3, 4)])
def test_gauge_keeps_the_last_value(spark, seen, value):
    df = spark.createDataFrame(list(enumerate([2.7, 9.2, 4.9][:seen])), "i int, payload double")
    assert rows_of(metrics.metric_gauge(df, "'g'", ["i"], amount="payload")) == [("g", value)]


def test_tags_missing_null_and_empty(spark):
    df = spark.createDataFrame([(0, '{"tree":"Elm"}'), (1, '{"tree":null}')], "i int, payload string")
    out = metrics.metric_tags(
        df, fixed={"blank": ""},
        tags={"rock": "get_json_object(payload, '$.rock')", "tree": "get_json_object(payload, '$.tree')"},
    ).orderBy("i").collect()
    assert [r["tags"] for r in out] == [{"rock": "NA", "tree": "Elm"}, {"rock": "NA", "tree": "NA"}]


def test_tag_lists_are_padded_and_count_in_full(spark):
    df = spark.createDataFrame([(["a", " ", None, "b"], ["x"], " ")], "l array<string>, m array<string>, s string")
    tagged = metrics.metric_tags(df, fixed={"l": "lost", "f": "v"}, tags={"l": "l", "m": "m", "s": "s"}).collect()
    assert [r["tags"] for r in tagged] == [
        {"f": "v", "l": "a", "m": "x", "s": " "}, {"f": "v", "l": "b", "m": "", "s": ""},
    ]
    total = metrics.metric_counter(df, "'n'", amount="2.5D", tags={"l": "l"}).agg(F.sum("amount")).first()[0]
    assert total == 5.0
    empty = spark.sql("SELECT CAST(array() AS ARRAY<STRING>) AS l")
    assert metrics.metric_tags(empty, tags={"l": "l"}).first()["tags"] == {"l": "NA"}


def test_counters_by_json_tags(spark):
    sales = [("ale", "pub")] * 4 + [("tea", "cafe")] * 2 + [("tea", "pub")]
    df = spark.createDataFrame([(f'{{"of":{{"drink":"{d}","place":"{p}"}}}}',) for d, p in sales], "payload string")
    out = metrics.metric_counter(
        df, "'sales'", tags={"drink": "get_json_object(payload, '$.of.drink')", "place": "get_json_object(payload, '$.of.place')"}
    )
    assert sorted(rows_of(out)) == [("sales", "ale", "pub", 4.0), ("sales", "tea", "cafe", 2.0), ("sales", "tea", "pub", 1.0)]


@pytest.mark.parametrize("name,wanted", [("'a'", "a"), ("' \t'", "empty"), ("''", "empty"), ("NULL", "empty")])
def test_metric_name(spark, name, wanted):
    assert spark.range(1).select(metrics.metric_name(name).alias("n")).first()["n"] == wanted


def line(spark, payload, **options):
    df = spark.createDataFrame([(payload,)], "payload string")
    value = "CAST(get_json_object(payload, '$.value') AS DOUBLE)"
    return metrics.metric_line_format(df, "tide.level", value, "pier-4", **options).first()


def test_metric_line(spark):
    payload = '{"value":2.25,"at":1700000123,"side":"lee ward"}'
    tag = {"side": "get_json_object(payload, '$.side')"}
    stamp = "CAST(get_json_object(payload, '$.at') AS BIGINT)"
    assert line(spark, payload, timestamp=stamp, tags=tag)["line"] == '"tide.level" 2.25 1700000123 source=pier-4 side="lee ward"'
    assert line(spark, payload, tags=tag)["line"] == '"tide.level" 2.25 source=pier-4 side="lee ward"'
    assert line(spark, payload)["line"] == '"tide.level" 2.25 source=pier-4'
    assert line(spark, payload, tags={"none": "get_json_object(payload, '$.none')"})["line"] == '"tide.level" 2.25 source=pier-4'
    assert line(spark, "{}")["error"] is not None
    assert line(spark, payload, timestamp="'soon'")["error"] is not None


@pytest.mark.parametrize("key,valid", [(k, True) for k in ["k", "Q", "7", ".", "_", "-", "z-9.Y_x"]]
                         + [(k, False) for k in [" ", "é", "x y", "$", "=", ";"]])
def test_metric_tag_keys(spark, key, valid):
    row = line(spark, '{"value":1}', tags={key: "'v'"})
    assert (row["error"] is None) == valid
    assert (row["line"] is not None) == valid


@pytest.mark.parametrize("length,warned", [(254, False), (255, True)])
def test_long_tags_only_warn(spark, length, warned):
    row = line(spark, '{"value":1}', tags={"k" * 10: f"repeat('v', {length - 10})"})
    assert row["error"] is None and (row["warning"] is not None) == warned


def test_column_map_setting():
    assert parse_column_map("a,b: c") == {"a": "a", "b": "c"}
    assert parse_column_map("a: f(x\\, 1), , t: 'x\\:y'") == {"a": "f(x, 1)", "t": "'x:y'"}
    with pytest.raises(ValueError):
        parse_column_map("a:b:c")


def test_column_map_insert(spark):
    df = spark.sql("SELECT named_struct('tree', 'cedar', 'rings', 80) AS payload, map('site', 'hill') AS headers")
    assert rows_of(tables.column_map_insert(df, "tree,rings")) == [("cedar", 80)]
    assert rows_of(tables.column_map_insert(df, "t: upper(payload.tree), r: rings / 2")) == [("CEDAR", 40.0)]
    assert rows_of(tables.column_map_insert(df, "s: headers['site']")) == [("hill",)]
    assert rows_of(tables.column_map_insert(df, "s: nowhere")) == [(None,)]
    texts = spark.createDataFrame([('{"tree":"fir","rings":9}',), ('{"tree":"yew","rings":null}',), ('{"tree":"ash"}',)], "payload string")
    out = tables.column_map_insert(texts, "tree,rings", payload_type="tree STRING, rings INT")
    assert rows_of(out) == [("fir", 9), ("yew", None), ("ash", None)]
    assert rows_of(tables.column_map_insert(texts.limit(1))) == [('{"tree":"fir","rings":9}',)]


def test_a_value_that_does_not_fit_is_null(spark):
    df = spark.createDataFrame([("12",), ("abc",), (None,)], "payload string")
    out = tables.column_map_insert(df, "n: CAST(payload AS INT), t: concat('cast(', payload, ')')".replace("', ", "'\\, ").replace("payload, ')", "payload\\, ')"))
    assert rows_of(out) == [(12, "cast(12)"), (None, "cast(abc)"), (None, None)]
    both = spark.sql("SELECT CAST(NULL AS STRING) AS a, named_struct('a', 'inner') AS payload UNION ALL SELECT 'outer', named_struct('a', 'x')")
    assert sorted(rows_of(tables.column_map_insert(both, "a"))) == [("inner",), ("outer",)]


def test_batches(spark):
    start = dt.datetime(2024, 1, 1)
    at = [0, 1, 2, 3, 500, 501]
    df = spark.createDataFrame(
        [(i, start + dt.timedelta(milliseconds=100 * s), f"v{i}") for i, s in enumerate(at)], "i int, ts timestamp, payload string"
    )
    out = tables.batch_flush(df, ["ts", "i"], batch_rows=3, idle="1 second", time="ts").orderBy("group_start")
    assert [r["payloads"] for r in out.collect()] == [["v0", "v1", "v2"], ["v3"], ["v4", "v5"]]
    alone = tables.batch_flush(df, ["i"], batch_rows=4).orderBy("group_start")
    assert [r["n"] for r in alone.collect()] == [4, 2]


def test_table_init_makes_the_table_anew(spark, tmp_path):
    for place in ("one", "two"):
        tables.table_init(spark, "made_table", ["a", "b"], location=str(tmp_path / place))
        tables.table_append(spark.createDataFrame([(42, "hello")], "b int, a string"), "made_table")
    assert rows_of(spark.table("made_table")) == [("hello", "42")]
    tables.table_init(spark, "made_table", {"a": "STRING", "b": "INT"}, location=str(tmp_path / "three"))
    assert dict(spark.table("made_table").dtypes) == {"a": "string", "b": "int"}
    spark.sql("DROP TABLE made_table")


def test_table_script(spark, tmp_path):
    tables.table_script(spark, f"""
        CREATE TABLE scripted (a STRING, b INT) USING parquet LOCATION '{tmp_path / 'scripted'}';
        INSERT INTO scripted VALUES ('x; y', 1), ('z', 2);

        INSERT INTO scripted SELECT a, b + 10 FROM scripted WHERE b = 2""")
    assert sorted(rows_of(spark.table("scripted"))) == [("x; y", 1), ("z", 2), ("z", 12)]
    spark.sql("DROP TABLE scripted")


BOOK = "isbn STRING, title STRING, author STRING, pages INT, saleDate STRING, inStock BOOLEAN"


def test_json_rows(spark):
    uuid = "123e4567-e89b-12d3-a456-42661417400{}"
    books = ",".join(
        f'{{"isbn":"{uuid.format(i)}","title":"t{i}","pages":{i},"saleDate":"2024-01-0{i + 1}","inStock":true}}' for i in range(5)
    )
    df = spark.createDataFrame([(f"[{books}]",)], "payload string")
    out = tables.json_ingest_rows(df, BOOK, dates=["saleDate"], uuids=["isbn"])
    assert out.columns == ["isbn", "title", "author", "pages", "saleDate", "inStock"]
    got = rows_of(out)
    assert len(got) == 5 and got[1] == (uuid.format(1), "t1", None, 1, dt.date(2024, 1, 2), True)
    renamed = spark.createDataFrame([('{"myIsbn":"no","myDate":"never","title":"x"}',)], "payload string")
    out = tables.json_ingest_rows(
        renamed, BOOK, names={"isbn": "myIsbn", "saleDate": "myDate"}, dates=["saleDate"], uuids=["isbn"]
    )
    assert rows_of(out) == [(None, "x", None, None, None, None)]


def test_upsert_and_ttl(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "x", 1), (2, None, 2), (3, "z", 1)], "id int, v string, at int")
    assert sorted(rows_of(tables.table_upsert(old, new, ["id"], ["at"]))) == [(1, "a"), (2, None), (3, "z")]
    assert sorted(rows_of(tables.table_upsert(old, new, ["id"], ["at"], update_only=True))) == [(1, "a"), (2, None)]
    timed = new.withColumn("ts", F.expr("TIMESTAMP'2024-01-01 00:00:00' + make_interval(0, 0, 0, at)"))
    held = tables.table_upsert(old, timed, ["id"], ["at"], ttl="1 day", written_at="ts")
    live = tables.live_rows(held, "TIMESTAMP'2024-01-03 12:00:00'")
    assert sorted(r["id"] for r in live.collect()) == [1, 2]


def test_index_route(spark):
    df = spark.createDataFrame(
        [('{"a":1}', {"INDEX_ID": "2", "INDEX_NAME": "other"}), ('{"a":2}', {})], "payload string, headers map<string,string>"
    )
    out = routes.index_route(df, "main", doc_id="concat('id', 7)").collect()
    assert [(r["index"], r["id"], r["doc"]) for r in out] == [("other", "2", '{"a":1}'), ("main", "id7", '{"a":2}')]
    assert routes.index_route(df, "main").collect()[1]["id"] is None
    as_map = df.withColumn("payload", F.expr("map('k', 'v')"))
    assert routes.index_route(as_map, "main").first()["doc"] == '{"k":"v"}'
    assert routes.index_route(df.withColumn("payload", F.lit(1)), "main").first()["doc"] is None


def test_last_document_wins(spark):
    df = spark.createDataFrame(
        [("i", "1", "old", 1), ("i", "1", "new", 2), ("i", None, "x", 1), ("i", None, "x", 1)],
        "index string, id string, doc string, at int",
    )
    out = routes.last_documents(df, ["at"])
    assert sorted((r["id"] or "", r["doc"]) for r in out.collect()) == [("", "x"), ("", "x"), ("1", "new")]


def test_bulk_errors(spark, tmp_path):
    sent = spark.createDataFrame(
        [(b, i, f"fault {b}-{i}" if i else None) for b in range(30) for i in range(3)] + [(99, 1, None)], "bulk int, i int, error string"
    )
    checked = routes.bulk_result_check(sent, ["bulk"], ["i"])
    assert checked.filter("bulk = 7").drop("bulk").first() == (3, 2, " : fault 7-1 : fault 7-2")
    with pytest.raises(routes.BulkError) as failed:
        routes.raise_bulk_errors(checked, str(tmp_path / "failed"))
    assert (failed.value.requests, failed.value.items) == (30, 60)
    kept = [r["message"] for r in spark.read.parquet(failed.value.table).collect()]
    assert sorted(kept) == sorted(f" : fault {b}-1 : fault {b}-2" for b in range(30))
    routes.raise_bulk_errors(checked.filter("failed = 0"), str(tmp_path / "none"))


def test_file_write(spark, tmp_path):
    df = spark.createDataFrame([("leaf fall",)], "payload string")
    named = routes.file_write(df, directory="d", name="autumn", suffix="csv").first()
    assert (named["dir"], named["file"], named["content"]) == ("d", "autumn.csv", "leaf fall")
    by_text = routes.file_write(df, directory_expr="concat('s', 1)", name_expr="split(payload, ' ')[0]", suffix=".log")
    assert rows_of(by_text) == [("s1", "leaf.log", "leaf fall")]
    routes.write_partitioned(by_text, str(tmp_path / "out"), ["dir", "file"])
    assert rows_of(spark.read.text(str(tmp_path / "out"))) == [("leaf fall", "s1", "leaf.log")]
    with pytest.raises(ValueError):
        routes.file_write(df, directory="a", directory_expr="'b'", name="c")
    with pytest.raises(ValueError):
        routes.file_write(df, directory="a")


def test_line_ends_and_bytes_refused(spark, tmp_path):
    df = spark.createDataFrame([("d", "né")], "dir string, content string")
    routes.write_partitioned(df, str(tmp_path / "l"), ["dir"], line_end="|")
    assert [x.read_bytes() for x in (tmp_path / "l").glob("dir=d/*.txt")] == ["né|".encode()]
    with pytest.raises(ValueError):
        routes.write_partitioned(df.withColumn("content", F.expr("X'00FF01'")), str(tmp_path / "b"), ["dir"])


def test_files_each_keeps_destinations_in_few_files(spark, tmp_path):
    df = spark.range(200).selectExpr("'d' AS dir", "CAST(id AS STRING) AS content", "id").repartition(8)
    routes.write_partitioned(df, str(tmp_path / "o"), ["dir"], files_each=2, share_by="id")
    assert len(list((tmp_path / "o").glob("dir=d/*.txt"))) <= 2
    assert spark.read.text(str(tmp_path / "o")).count() == 200


def test_write_objects(spark, tmp_path):
    df = spark.createDataFrame([("b", "x/1", b"\x00\xff"), ("b", "2", b"two")], "bucket string, key string, content binary")
    out = write_objects(df, str(tmp_path), ["bucket", "key"]).collect()
    assert sorted(r["size"] for r in out) == [2, 3] and all(r["path"].startswith("file:") for r in out)
    assert (tmp_path / "b/x/1").read_bytes() == b"\x00\xff" and (tmp_path / "b/2").read_bytes() == b"two"


def test_objects_that_exist(spark, tmp_path):
    df = spark.createDataFrame([("é 1.txt", "né")], "key string, content string")

    def write(**options):
        return write_objects(df, f"file:{tmp_path}", ["key"], **options).first()["outcome"]

    place = tmp_path / "é 1.txt"
    assert write(charset="ISO-8859-1") == "written" and place.read_bytes() == "né".encode("latin-1")
    assert write(exists="ignore") == "ignored" and place.read_bytes() == "né".encode("latin-1")
    assert write() == "written" and place.read_bytes() == "né".encode()
    assert write(exists="append") == "written" and place.read_bytes() == "néné".encode()
    with pytest.raises(PySparkException):
        write(exists="fail")
    with pytest.raises(ValueError):
        write(exists="maybe")


def test_object_and_collection_write(spark):
    df = spark.createDataFrame([("body", "k")], "payload string, key string")
    out = routes.object_write(df, bucket="b", key_expr="key", acl="private")
    assert rows_of(out) == [("b", "k", "private", "body")]
    with pytest.raises(PySparkException):
        routes.object_write(df, bucket="b", key_expr="key", acl_expr="CAST(NULL AS STRING)").collect()
    with pytest.raises(ValueError):
        routes.object_write(df, bucket="b", bucket_expr="'c'", key_expr="key")
    docs = df.withColumn("payload", F.struct("key"))
    assert rows_of(routes.collection_write(docs, collection="c")) == [("c", '{"key":"k"}')]


def test_record_publish(spark):
    df = spark.createDataFrame([("v", {"a1": "x", "b": "y"})], "payload string, headers map<string,string>")
    row = routes.record_publish(
        df, topic="fixed", topic_expr="concat('t-', payload)", key="k", partition=3, timestamp_expr="17", header_patterns=["a*"]
    ).first()
    assert (row["topic"], row["key"], row["value"], row["partition"]) == ("t-v", "k", "v", 3)
    assert [(h["key"], bytes(h["value"])) for h in row["headers"]] == [("a1", b"x"), ("timestamp", b"17")]


def test_routes(spark):
    df = spark.createDataFrame([("p",)], "payload string")
    assert rows_of(routes.route_project(df, kind="exchange", dest="e", routing_key="r")) == [("exchange", "e", "r", "p")]
    assert rows_of(routes.route_project(df, kind="queue", dest_expr="payload")) == [("queue", "p", None, "p")]
    for wrong in (dict(kind="exchange", dest="e"), dict(kind="queue"), dict(kind="key", dest="a", dest_expr="'b'"), dict(kind="x")):
        with pytest.raises(ValueError):
            routes.route_project(df, **wrong)


def test_log_write(spark):
    df = spark.createDataFrame([("p",)], "payload string")
    assert rows_of(routes.log_write(df)) == [("INFO", "log", "p")]
    routes.write_log(routes.log_write(df, level="fatal"))
    routes.write_log(routes.log_write(df))
    with pytest.raises(ValueError):
        routes.log_write(df, level="loud")
