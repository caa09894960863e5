import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from flowframe.operators.archive import archive_expand
from flowframe.operators.http import http_enrich, http_requests
from flowframe.operators.vision import (
    detection_postprocess, image_inference, prediction_from_json, prediction_to_json,
)
from flowframe.sinks.routes import bulk_write


def test_http_enrich(spark):
    def echo():
        def send(method, url, headers, body, timeout):
            text = json.dumps({"m": method, "u": url, "h": sorted(headers.items()), "b": body, "t": timeout})
            return {"status": 201, "headers": {"x": "y"}, "body": text}

        return send

    df = spark.createDataFrame([("p", {"a": "1"})], "payload string, headers map<string,string>")
    out = http_enrich(df, echo, "'http://h/x'").first()
    assert json.loads(out["payload"]) == {"m": "GET", "u": "http://h/x", "h": [], "b": "p", "t": 30.0}
    out = http_enrich(
        df, echo, "concat('http://h/', payload)", method="'post'", body="headers['a']",
        headers={"k": "'v'", "none": "CAST(NULL AS STRING)"}, timeout=2, reply="concat(reply_status, reply_headers['x'], reply_body)",
    ).first()
    assert out["payload"].startswith("201y")
    assert json.loads(out["payload"][4:]) == {"m": "POST", "u": "http://h/p", "h": [["k", "v"]], "b": "1", "t": 2}
    assert out["headers"] == {"a": "1"}
    # Columns that only pass through stay exact, nulls and large numbers alike.
    large = spark.sql(
        "SELECT * FROM VALUES (9007199254740993L, TIMESTAMP_NTZ'2024-01-01 00:00:00.000001'), (NULL, NULL) AS t(n, ts)"
    ).withColumn("payload", F.lit("p"))
    kept = http_enrich(large, echo, "'u'").select("n", "ts")
    assert kept.collect() == large.select("n", "ts").collect()
    assert http_requests(df, "'u'").first()["request_method"] == "GET"


def test_archive_expand(spark):
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as archive:
        archive.writestr("a.txt", "one")
        archive.writestr("dir/", "")
        archive.writestr("dir/b.bin", b"\x00\x01")
    rows = [("x.zip", {"h": "1"}, blob.getvalue()), ("cut.zip", {"h": "2"}, blob.getvalue()[:30]), ("none.zip", None, None)]
    df = spark.createDataFrame(rows, "path string, headers map<string,string>, payload binary")
    whole, broken = archive_expand(df).filter("error IS NULL"), archive_expand(df).filter("error IS NOT NULL")
    assert [(r["path"], r["headers"], r["entry_no"], r["entry"], bytes(r["payload"])) for r in whole.collect()] == [
        ("x.zip", {"h": "1"}, 1, "a.txt", b"one"), ("x.zip", {"h": "1"}, 2, "dir/b.bin", b"\x00\x01"),
    ]
    assert sorted((r["path"], r["entry"], r["payload"]) for r in broken.collect()) == [("cut.zip", None, None), ("none.zip", None, None)]


def test_archives_leave_in_small_batches():
    """What a task gathers does not grow with the batch it is given."""
    import pyarrow as pa

    from wiring import functions

    texts = ["x" * 100_000] * 130
    given = pa.RecordBatch.from_arrays([pa.array(range(130)), pa.array(texts), pa.array(["en"] * 130)], names=["doc_id", "text", "lang"])
    out = list(functions.packed(iter([given])))
    assert len(out) > 2 and all(batch.nbytes < functions.ARCHIVES + 200_000 for batch in out)
    blobs = [blob for batch in out for blob in batch.column("payload").to_pylist()]
    assert len(blobs) == 130 and len(blobs[3]) == 20
    assert zipfile.ZipFile(io.BytesIO(blobs[4])).read("body.txt").decode() == texts[4]


def test_image_inference(spark):
    def load():
        return lambda image: (json.dumps([{"className": "c", "probability": len(image) / 10}]), b"drawn" if len(image) > 2 else None)

    df = spark.createDataFrame([(b"abc", {"cvjson": "old", "k": "v"}), (b"a", {})], "payload binary, headers map<string,string>")
    plain = image_inference(df, load).collect()
    assert plain[0]["headers"] == {"cvjson": '[{"className": "c", "probability": 0.3}]', "k": "v"}
    assert bytes(plain[0]["payload"]) == b"abc"
    drawn = image_inference(df, load, header="h", augment=True).collect()
    assert [bytes(r["payload"]) for r in drawn] == [b"drawn", b"a"] and "h" in drawn[0]["headers"]


def test_prediction_round_trip(spark):
    df = spark.sql(
        "SELECT array(named_struct('className', 'a', 'probability', 0.1D), named_struct('className', 'b', 'probability', 0.2D)) AS p"
    )
    text = df.select(prediction_to_json("p").alias("j"))
    assert text.first()["j"] == '[{"className":"a","probability":0.1},{"className":"b","probability":0.2}]'
    back = text.select(F.explode(prediction_from_json("j", "classification")).alias("x")).select("x.*")
    assert [tuple(r) for r in back.collect()] == [("a", 0.1), ("b", 0.2)]
    mask = spark.sql("SELECT named_struct('classes', array('x'), 'mask', array(array(0, 1))) AS m")
    shape = mask.select(prediction_to_json("m").alias("j")).select(prediction_from_json("j", "mask").alias("m")).first()["m"]
    assert shape["classes"] == ["x"] and shape["mask"] == [[0, 1]]


def test_detections(spark):
    boxes = [("i", rank, 1 if rank % 2 else 0, 0.3 if rank == 3 else 0.9, 0.1, 0.2, 0.5, 0.8) for rank in range(1, 14)]
    df = spark.createDataFrame(
        boxes, "image string, rank int, class_id int, score double, y_min double, x_min double, y_max double, x_max double"
    )
    labels = spark.createDataFrame([(1, "cat")], "class_id int, label string")
    out = detection_postprocess(df, labels).orderBy("rank").collect()
    assert [r["rank"] for r in out] == [1, 5, 7, 9]
    assert out[0]["class_name"] == "cat"
    assert (out[0]["x"], out[0]["y"]) == (0.2, 0.1)
    assert (out[0]["width"], out[0]["height"]) == (pytest.approx(0.6), pytest.approx(0.4))
    assert detection_postprocess(df).first()["class_name"] == "#1"


def test_bulk_write_sends_in_batches(spark):
    def client():
        def send(items):
            routes = items.column("routing").to_pylist()
            return [f"batch of {len(items)} by {r}" if d == "bad" else None for d, r in zip(items.column("doc").to_pylist(), routes, strict=True)]

        return send

    df = spark.createDataFrame(
        [("i", str(n), "bad" if n == 4 else "ok", f"r{n}") for n in range(5)], "index string, id string, doc string, routing string"
    )
    out = bulk_write(df.coalesce(1), client, batch_rows=2).collect()
    assert [(r["id"], r["error"]) for r in out] == [("0", None), ("1", None), ("2", None), ("3", None), ("4", "batch of 1 by r4")]
