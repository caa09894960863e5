import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from flowframe.envelope import to_messages
from flowframe.operators import transforms as tr
from flowframe.operators.split import split_delimiters, split_expression, split_file_content, split_items
from flowframe.operators.tasks import kv_list_parse, task_request_build
from flowframe.plans.compose import compose


def messages(spark, *rows):
    """Rows of (payload, headers)."""
    kind = "binary" if isinstance(rows[0][0], bytes) else "string"
    return spark.createDataFrame(list(rows), f"payload {kind}, headers map<string,string>")


def payloads(df):
    return [row["payload"] for row in df.collect()]


def test_filter_keeps_true_rows_and_strict_fails_on_null(spark):
    df = messages(spark, ("oak", {}), ("red maple", {}), (None, {}))
    assert payloads(tr.filter_rows(df, "instr(payload, ' ') > 0")) == ["red maple"]
    assert len(payloads(tr.filter_rows(df))) == 3
    with pytest.raises(PySparkException):
        tr.filter_rows(df, "instr(payload, ' ') > 0", strict=True).collect()


def test_transform_replaces_payload_and_keeps_headers(spark):
    df = messages(spark, ("river; lake", {"depth": "9"}), ("[3, 4]", {}))
    out = tr.transform_payload(df, "reverse(payload)").collect()
    assert [row["payload"] for row in out] == ["ekal ;revir", "]4 ,3["]
    assert out[0]["headers"] == {"depth": "9"}
    assert payloads(tr.transform_payload(df)) == ["river; lake", "[3, 4]"]


def test_header_enrich(spark):
    df = messages(spark, ("oak", {"height": "20", "owner": "ann"}))
    added = {"kind": "'tree'", "height": "'25'", "copy": "upper(payload)", "fixed": F.lit("x"), "owner": "CAST(NULL AS STRING)"}
    fresh = {"kind": "tree", "copy": "OAK", "fixed": "x", "owner": "ann"}
    assert tr.header_enrich(df, added, overwrite=True).first()["headers"] == {"height": "25", **fresh}
    assert tr.header_enrich(df, added).first()["headers"] == {"height": "20", **fresh}


@pytest.mark.parametrize(
    "names,left",
    [
        ("size,colour", {"sizes", "x-size", "x-colour", "xColour"}),
        ("x-*", {"size", "sizes", "colour", "xColour"}),
        ("size*,*olour", {"x-size"}),
        ("*", set()),
    ],
)
def test_header_remove(spark, names, left):
    headers = {name: "1" for name in ("size", "sizes", "colour", "x-size", "x-colour", "xColour")}
    assert set(tr.header_remove(messages(spark, ("p", headers)), names).first()["headers"]) == left


def test_header_names_without_star_are_literal(spark):
    out = tr.header_remove(messages(spark, ("x", {"a.c": "1", "abc": "2"})), "a.c other").first()["headers"]
    assert out == {"abc": "2"}
    df = messages(spark, ("x", {"a": "1", "b": "2"}))
    assert tr.header_remove(df, "a", delete_all=True).first()["headers"] == {}
    assert tr.header_remove(df).first()["headers"] == {"a": "1", "b": "2"}


def test_header_delete_all_leaves_id_and_time(spark):
    df = to_messages(
        spark.sql("SELECT 1 AS id, TIMESTAMP'2024-01-01' AS ts"), "'x'", headers={"hue": "'1'"}, msg_id="id", msg_ts="ts"
    )
    row = tr.header_delete_all(df).first()
    assert row["headers"] == {} and row["msg_id"] == 1 and row["msg_ts"] is not None


@pytest.mark.parametrize(
    "kind,is_text",
    [
        (None, True),
        ("application/geo+json;v=1", True),
        ("text/csv", True),
        ("image/webp", False),
        ("who knows", False),
    ],
)
def test_bytes_to_text(spark, kind, is_text):
    row = tr.bytes_to_text(messages(spark, ("häuser".encode(), {"contentType": kind} if kind else {}))).first()
    assert row["payload_text"] == ("häuser" if is_text else None)
    assert bytes(row["payload"]) == "häuser".encode()


def test_bytes_to_text_replaces_broken_bytes(spark):
    row = tr.bytes_to_text(messages(spark, (b"a\xffb", {}))).first()
    assert row["payload_text"] == "a�b"


def test_json_to_map(spark):
    rows = [(b'{"a":1,"b":"x"}', {}), (b"{nope", {}), (b'{"a":1}', {"contentType": "text/plain"})]
    out = tr.json_to_map(messages(spark, *rows)).collect()
    assert [row["payload_map"] for row in out] == [{"a": "1", "b": "x"}, None, None]
    assert bytes(out[1]["payload"]) == b"{nope"


def test_split_expression_and_sequence(spark):
    df = messages(spark, ("tin|zinc|iron", {"k": "v"}), ("", {}), (None, {}))
    out = split_expression(df.filter("payload <> ''"), "split(payload, '[|]')", correlate="'id'").collect()
    assert [(r["payload"], r["correlation_id"], r["sequence_number"], r["sequence_size"]) for r in out] == [
        ("tin", "id", 1, 3), ("zinc", "id", 2, 3), ("iron", "id", 3, 3),
    ]
    assert out[1]["headers"] == {"k": "v"}


def test_split_of_nothing_gives_no_rows(spark):
    df = spark.sql("SELECT CAST(NULL AS ARRAY<STRING>) AS payload UNION ALL SELECT array()")
    assert split_items(df).count() == 0
    assert split_items(df, correlate="1").count() == 0
    assert split_items(spark.sql("SELECT array('a', NULL) AS payload"), correlate="1").count() == 2


def test_split_delimiters_trims_and_drops_empties(spark):
    df = messages(spark, (" a,b; ;\tc\n,,d-[e]", {}))
    assert payloads(split_delimiters(df, ",;")) == ["a", "b", "c", "d-[e]"]
    assert payloads(split_delimiters(messages(spark, ("a-b]c^d", {})), "-]^")) == ["a", "b", "c", "d"]


def test_split_items(spark):
    assert payloads(split_items(spark.sql("SELECT array(1, 2) AS payload"))) == [1, 2]
    assert payloads(split_items(spark.sql("SELECT 'one' AS payload"))) == ["one"]


def test_split_file_content(spark):
    df = spark.createDataFrame([("f", b"north\r\nsouth\n"), ("e", b"")], "path string, payload binary")
    assert payloads(split_file_content(df)) == ["north", "south"]
    marked = payloads(split_file_content(df, markers=True))
    assert marked == [
        '{"filePath":"f","mark":"START","lineCount":0}', "north", "south",
        '{"filePath":"f","mark":"END","lineCount":2}',
        '{"filePath":"e","mark":"START","lineCount":0}', '{"filePath":"e","mark":"END","lineCount":0}',
    ]
    latin = spark.createDataFrame([("é\nü".encode("latin-1"),)], "payload binary")
    assert payloads(split_file_content(latin, charset="ISO-8859-1")) == ["é", "ü"]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("db.url=host:99", {"db.url": "host:99"}),
        ("db.hosts=n1,n2,n3", {"db.hosts": "n1,n2,n3"}),
        ("lo=min(a,b),eq=a==b,neg=f(x)!=1", {"lo": "min(a,b)", "eq": "a==b", "neg": "f(x)!=1"}),
        ("db.hosts=n1,n2,log.files=x,y", {"db.hosts": "n1,n2", "log.files": "x,y"}),
        ("a=1, a = 2 ,lost", {"a": "2 ,lost"}),
        ("lost,b=1", {"b": "1"}),
        ("  ", {}),
        ("nothing", {}),
    ],
)
def test_kv_list(spark, text, expected):
    from flowframe.functions.settings import parse_kv_list

    row = spark.createDataFrame([(text,)], "t string").select(kv_list_parse("t").alias("m")).first()
    assert row["m"] == expected
    assert parse_kv_list(text) == expected


def parsed(text):
    """The list read from left to right."""
    pairs = []
    for i, segment in enumerate(text.split(",")):
        if i and "=" not in segment:
            pairs[-1] += "," + segment
        else:
            pairs.append(segment)
    return {p.split("=", 1)[0].strip(): p.split("=", 1)[1].strip() for p in pairs if "=" in p}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.text(alphabet="ab=, ", max_size=14), min_size=20, max_size=60))
def test_kv_list_reads_any_text(spark, texts):
    from flowframe.functions.settings import parse_kv_list

    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {row["i"]: row["m"] for row in df.select("i", kv_list_parse("t").alias("m")).collect()}
    assert got == {i: parsed(text) for i, text in enumerate(texts)}
    assert [parse_kv_list(text) for text in texts] == [parsed(text) for text in texts]


def request(df, **options):
    import json

    row = task_request_build(df, **options).first()
    assert row["headers"]["contentType"] == "application/json"
    return json.loads(row["payload"])


def test_task_request(spark):
    df = messages(spark, ("birch", {"zone": "7", "contentType": "text/plain"}))
    made = request(df, name="plant", arg_exprs={"tree": "upper(payload)", "zone": "headers['zone'] + 1"})
    assert made["name"] == "plant" and made["deploymentProps"] == {} and [a.split(".")[0] for a in made["args"]] == ["tree=BIRCH", "zone=8"]
    made = request(df, name="prune", args=["how=hard", "when=may"], deployment="memory=2g,cores=4")
    assert made == {"args": ["how=hard", "when=may"], "deploymentProps": {"memory": "2g", "cores": "4"}, "name": "prune"}
    assert request(df, name_expr="concat('do-', reverse(payload))")["name"] == "do-hcrib"
    number = spark.sql("SELECT 77 AS payload, CAST(map() AS MAP<STRING,STRING>) AS headers")
    assert request(number, name="t", arg_exprs={"count": "payload"})["args"] == ["count=77"]
    with pytest.raises(ValueError):
        task_request_build(df, name="a", name_expr="'b'")
    with pytest.raises(ValueError):
        task_request_build(df)
    with pytest.raises(PySparkException):
        task_request_build(df, name_expr="' '").collect()


def test_compose(spark):
    steps = {
        "keep": lambda df: tr.filter_rows(df, "payload <> 'b'"),
        "loud": lambda df: tr.transform_payload(df, "upper(payload)"),
    }
    df = messages(spark, ("a", {}), ("b", {}))
    assert payloads(compose("keep|loud", steps)(df)) == ["A"]
    assert payloads(compose("loud | keep", steps)(df)) == ["A", "B"]
    with pytest.raises(KeyError):
        compose("keep|missing", steps)


def test_recursive_json_path(spark):
    from flowframe.functions.json_path import json_find

    texts = ['{"leaf":"Oak"}', '{"a":{"leaf":null},"b":[{"leaf":1},{"leaf":{"x":[1]}}]}', "{bad", None, "[]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = {row["i"]: row["f"] for row in df.select("i", json_find(F.col("t"), "leaf").alias("f")).collect()}
    assert found == {0: ["Oak"], 1: [None, "1", '{"x":[1]}'], 2: None, 3: None, 4: []}
