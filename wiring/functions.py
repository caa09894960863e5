"""Transforms over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowframe.envelope import to_messages
from flowframe.functions.json_path import json_find
from flowframe.operators import transforms as tr
from flowframe.operators.aggregate import aggregate, aggregate_sequence
from flowframe.operators.archive import archive_expand
from flowframe.operators.http import http_enrich, http_requests
from flowframe.operators.split import split_delimiters, split_expression, split_file_content, split_items
from flowframe.operators.tasks import kv_list_parse, task_request_build
from flowframe.operators.vision import (
    detection_postprocess,
    image_inference,
    prediction_from_json,
    prediction_to_json,
)
from flowframe.plans.compose import compose
from wiring.base import event_messages, flat_map, joined, query, table


@query(
    "filter_rows",
    "SELECT event_id, event_type, value FROM events WHERE event_type <> 'error' AND value > 50",
)
def filter_rows(spark, sf_dir):
    kept = tr.filter_rows(table(spark, sf_dir, "events"), "event_type <> 'error' AND value > 50")
    return kept.select("event_id", "event_type", "value")


@query("transform_payload", "SELECT event_id, upper(props) || '!' AS payload FROM events")
def transform_payload(spark, sf_dir):
    return tr.transform_payload(event_messages(spark, sf_dir), "concat(upper(payload), '!')").select(
        "event_id", "payload"
    )


@query(
    "header_enrich",
    """
    SELECT event_id, 'kept' AS mode, 'contentType=application/json,fixed=yes,kind=' || event_type
           || ',len=' || length(props) || ',user-id=' || user_id AS headers FROM events
    UNION ALL
    SELECT event_id, 'overwritten', 'contentType=application/json,fixed=yes,kind=' || upper(event_type)
           || ',len=' || length(props) || ',user-id=' || user_id FROM events
    """,
)
def header_enrich(spark, sf_dir):
    messages = event_messages(spark, sf_dir)
    # The null adds nothing, and with overwrite it leaves the user's id alone.
    added = {"kind": "upper(event_type)", "len": "length(payload)", "fixed": F.lit("yes"), "user-id": "CAST(NULL AS STRING)"}
    modes = [("kept", False), ("overwritten", True)]
    both = [
        tr.header_enrich(messages, added, overwrite=flag).select(
            "event_id", F.lit(mode).alias("mode"), flat_map("headers").alias("headers")
        )
        for mode, flag in modes
    ]
    return both[0].unionByName(both[1])


@query(
    "header_remove",
    """
    SELECT event_id, 'names' AS mode, 'user-id=' || user_id AS headers FROM events
    UNION ALL
    SELECT event_id, 'patterns', 'contentType=application/json' FROM events
    """,
)
def header_remove(spark, sf_dir):
    messages = event_messages(spark, sf_dir)
    by_name = tr.header_remove(messages, "contentType, kind")
    by_pattern = tr.header_remove(messages, "k*,user-*,absent")
    return by_name.select("event_id", F.lit("names").alias("mode"), flat_map("headers").alias("headers")).unionByName(
        by_pattern.select("event_id", F.lit("patterns").alias("mode"), flat_map("headers").alias("headers"))
    )


@query(
    "header_delete_all",
    "SELECT event_id AS msg_id, ts AS msg_ts, props AS payload, 0 AS n_headers FROM events",
)
def header_delete_all(spark, sf_dir):
    bare = tr.header_delete_all(event_messages(spark, sf_dir))
    return bare.select("msg_id", "msg_ts", "payload", F.size("headers").alias("n_headers"))


@query(
    "bytes_to_text",
    """
    SELECT conv_id, turn, strlen(text)::INT AS n_bytes,
           CASE WHEN role <> 'user' THEN text END AS payload_text
    FROM conversations
    """,
)
def bytes_to_text(spark, sf_dir):
    kind = "CASE role WHEN 'user' THEN 'application/octet-stream' WHEN 'assistant' THEN 'text/plain' END"
    messages = to_messages(
        table(spark, sf_dir, "conversations"), "encode(text, 'UTF-8')",
        headers={"contentType": kind}, keep=["conv_id", "turn"],
    )
    return tr.bytes_to_text(messages).select(
        "conv_id", "turn", F.octet_length("payload").alias("n_bytes"), "payload_text"
    )


@query(
    "json_to_map",
    """
    SELECT event_id, CASE WHEN event_type = 'error' THEN substr(props, 2) ELSE props END AS payload,
           CASE WHEN event_type NOT IN ('error', 'view') THEN json_extract_string(props, '$.k') END AS k
    FROM events
    """,
)
def json_to_map(spark, sf_dir):
    messages = to_messages(
        table(spark, sf_dir, "events"),
        "encode(IF(event_type = 'error', substring(props, 2), props), 'UTF-8')",
        headers={"contentType": "IF(event_type = 'view', 'text/plain', 'application/json')"},
        keep=["event_id"],
    )
    return tr.json_to_map(messages).select(
        "event_id", F.decode("payload", "UTF-8").alias("payload"), F.col("payload_map")["k"].alias("k")
    )


@query(
    "split_expression",
    "SELECT page_id, unnest(string_split(url, '/')) AS payload FROM pages",
)
def split_expr(spark, sf_dir):
    messages = to_messages(table(spark, sf_dir, "pages"), "url", keep=["page_id"])
    return split_expression(messages, "split(payload, '/')").select("page_id", "payload")


@query(
    "split_delimiters",
    """
    SELECT conv_id, turn, token AS payload
    FROM (SELECT conv_id, turn, trim(unnest(regexp_split_to_array(text, '[,.]')), chr(10) || chr(9) || ' ') AS token
          FROM conversations)
    WHERE token <> ''
    """,
)
def split_delims(spark, sf_dir):
    messages = to_messages(table(spark, sf_dir, "conversations"), "text", keep=["conv_id", "turn"])
    return split_delimiters(messages, ",.").select("conv_id", "turn", "payload")


@query(
    "split_items",
    """
    SELECT vec_id, unnest(embedding) AS payload, unnest(range(1, len(embedding) + 1))::INT AS sequence_number
    FROM embeddings
    """,
)
def split_list(spark, sf_dir):
    messages = to_messages(table(spark, sf_dir, "embeddings"), "embedding", keep=["vec_id"])
    return split_items(messages, correlate="vec_id").select("vec_id", "payload", "sequence_number")


LINES_SQL = "regexp_split_to_array(regexp_replace(text, '(\\r\\n|\\r|\\n)\\z', ''), '\\r\\n|\\r|\\n')"


@query(
    "split_file_content",
    f"""
    WITH lined AS (SELECT doc_id, {LINES_SQL} AS lines FROM documents)
    SELECT doc_id, unnest(
             ['{{"filePath":"' || doc_id || '","mark":"START","lineCount":0}}'] || lines
             || ['{{"filePath":"' || doc_id || '","mark":"END","lineCount":' || len(lines) || '}}']) AS payload
    FROM lined
    """,
)
def split_file(spark, sf_dir):
    messages = to_messages(table(spark, sf_dir, "documents"), "encode(text, 'UTF-8')", keep=["doc_id"])
    return split_file_content(messages, charset="UTF-8", markers=True, path="doc_id").select("doc_id", "payload")


@query(
    "apply_sequence",
    f"""
    WITH lined AS (SELECT doc_id, {LINES_SQL} AS lines FROM documents)
    SELECT doc_id AS correlation_id, unnest(range(1, len(lines) + 1))::INT AS sequence_number,
           len(lines)::INT AS sequence_size, unnest(lines) AS payload
    FROM lined
    """,
)
def apply_sequence(spark, sf_dir):
    return _document_lines(spark, sf_dir)


def _document_lines(spark, sf_dir):
    messages = to_messages(table(spark, sf_dir, "documents"), "text", keep=["doc_id"])
    return split_file_content(messages, correlate="doc_id").select(
        "correlation_id", "sequence_number", "sequence_size", "payload"
    )


@query(
    "aggregate_sequence",
    f"""
    SELECT doc_id AS correlation_id, len({LINES_SQL}) AS n, array_to_string({LINES_SQL}, chr(10)) AS text
    FROM documents
    """,
)
def agg_sequence(spark, sf_dir):
    groups = aggregate_sequence(_document_lines(spark, sf_dir), None)
    return groups.select("correlation_id", "n", joined("payloads", "\n").alias("text"))


AGAIN = """
    SELECT user_id, event_id, ts, 2 + (row_number() OVER w - 1) // 12 % 3 AS size, (row_number() OVER w * 7) % 5 AS place
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
"""


@query(
    "aggregate_sequence_again",
    f"""
    WITH told AS ({AGAIN}),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM told),
    marked AS (SELECT *, CASE WHEN size IS DISTINCT FROM lag(size) OVER (PARTITION BY user_id ORDER BY rn) THEN rn END AS start FROM numbered),
    placed AS (SELECT *, max(start) OVER (PARTITION BY user_id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS first FROM marked)
    SELECT user_id AS correlation_id, min(rn) AS group_start, count(*) AS n,
           string_agg(event_id::VARCHAR, ',' ORDER BY place, rn) AS payloads
    FROM placed GROUP BY user_id, first, (rn - first) // size HAVING count(*) = max(size)
    """,
)
def agg_sequence_again(spark, sf_dir):
    """Ids come back with other sizes, and their messages out of sequence."""
    rn = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    told = table(spark, sf_dir, "events").select(
        "user_id", "event_id", "ts", (2 + F.floor((rn - 1) / 12) % 3).alias("size"), (rn * 7 % 5).alias("place")
    )
    groups = aggregate_sequence(
        told, ["ts", "event_id"], correlate="user_id", sequence="place", size="size", payload="event_id"
    )
    return groups.withColumn("payloads", joined("payloads"))


@query(
    "aggregate_one_large_key",
    """
    WITH keyed AS (SELECT *, CASE WHEN event_id % 2 = 0 THEN -1 ELSE user_id END AS k FROM events),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts, event_id) AS rn,
      coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS grp FROM keyed),
    counted AS (SELECT *, min(rn) OVER (PARTITION BY k, grp) AS group_start, count(*) OVER (PARTITION BY k, grp) AS n,
      max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY k, grp) AS ended FROM numbered)
    SELECT k, group_start, rn AS position, n, event_id AS payload FROM counted WHERE ended = 1
    """,
)
def agg_large_key(spark, sf_dir):
    """One key holds half of the rows; a group comes as its messages, of whatever length it is."""
    return aggregate(
        table(spark, sf_dir, "events"), {"k": "IF(event_id % 2 = 0, -1, user_id)"}, ["ts", "event_id"],
        payload="event_id", closes="event_type = 'purchase'",
    )


RUNNING = """
    WITH RECURSIVE n AS (
      SELECT CASE WHEN event_id % 2 = 0 THEN -1 ELSE user_id END AS k, event_id, CAST(value AS DECIMAL(18, 2)) AS v, ts FROM events
    ), o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts, event_id) AS rn FROM n),
    r AS (
      SELECT k, rn, event_id, v AS s, rn AS group_start FROM o WHERE rn = 1
      UNION ALL
      SELECT o.k, o.rn, o.event_id, CASE WHEN r.s >= 500 THEN o.v ELSE CAST(r.s + o.v AS DECIMAL(18, 2)) END,
        CASE WHEN r.s >= 500 THEN o.rn ELSE r.group_start END
      FROM r JOIN o ON o.k = r.k AND o.rn = r.rn + 1
    ), g AS (SELECT *, max(s) OVER (PARTITION BY k, group_start) >= 500 AS ended, count(*) OVER (PARTITION BY k, group_start) AS n FROM r)
"""


@query("aggregate_release_running", RUNNING + "SELECT k, group_start, rn AS position, n, event_id AS payload FROM g WHERE ended")
def agg_running(spark, sf_dir):
    """A sum that begins anew at each release, over one key that holds half of the rows."""
    return aggregate(
        table(spark, sf_dir, "events"), {"k": "IF(event_id % 2 = 0, -1, user_id)"}, ["ts", "event_id"], payload="event_id",
        amount="CAST(CAST(value AS DECIMAL(18, 2)) * 100 AS BIGINT)", reaches=50_000,
    )


@query(
    "aggregate_timeout_told",
    """
    WITH brk AS (SELECT *, row_number() OVER w AS rn, CASE WHEN ts > lag(ts) OVER w +
        CASE WHEN lag(event_type) OVER w = 'view' THEN INTERVAL 2 HOUR ELSE INTERVAL 5 HOUR END THEN 1 ELSE 0 END AS brk
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    segmented AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS seg FROM brk)
    SELECT user_id, min(rn) AS group_start, count(*) AS n, max(value) AS top FROM segmented GROUP BY user_id, seg
    """,
)
def agg_timeout_told(spark, sf_dir):
    """The idle time is an expression over the message that waits."""
    gap = F.expr("IF(event_type = 'view', INTERVAL 2 HOUR, INTERVAL 5 HOUR)")
    return aggregate(
        table(spark, sf_dir, "events"), {"user_id": "user_id"}, ["ts", "event_id"], gap=gap, time="ts",
        output={"top": F.max("value")},
    )


NUMBERED = """
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) AS rn FROM events
"""


@query(
    "aggregate_correlate",
    """
    WITH keyed AS (SELECT *, event_type || '/' || (user_id % 10) AS k FROM events),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts, event_id) - 1 AS rn FROM keyed)
    SELECT k, (rn // 10) * 10 + 1 AS group_start, count(*) AS n,
           string_agg(event_id::VARCHAR, ',' ORDER BY rn) AS payloads
    FROM numbered GROUP BY ALL HAVING count(*) = 10
    """,
)
def agg_correlate(spark, sf_dir):
    groups = aggregate(
        table(spark, sf_dir, "events"), {"k": "concat(event_type, '/', user_id % 10)"}, ["ts", "event_id"],
        payload="event_id", count=10,
    )
    return groups.select("k", "group_start", "n", joined("payloads").alias("payloads"))


@query(
    "aggregate_release_count",
    f"""
    WITH numbered AS ({NUMBERED.format(key="user_id")})
    SELECT user_id, ((rn - 1) // 5) * 5 + 1 AS group_start, count(*) AS n,
           string_agg(event_id::VARCHAR, ',' ORDER BY rn) AS payloads
    FROM numbered GROUP BY ALL HAVING count(*) = 5
    """,
)
def agg_count(spark, sf_dir):
    groups = aggregate(
        table(spark, sf_dir, "events"), {"user_id": "user_id"}, ["ts", "event_id"], payload="event_id", count=5
    )
    return groups.select("user_id", "group_start", "n", joined("payloads").alias("payloads"))


def whole(payload):
    """The payloads of a whole group as text, in order and of whatever length; null ones are left out."""
    one = F.expr(payload)
    every = F.sort_array(F.collect_list(F.when(one.isNotNull(), F.struct("position", one.alias("payload")))))
    return {"payloads": joined(F.transform(every, lambda row: row["payload"]))}


def narrow_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")


TRIGGERED = f"""
    SELECT *, coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (
                PARTITION BY user_id ORDER BY ts, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS grp
    FROM ({NUMBERED.format(key="user_id")})
"""


@query(
    "aggregate_release_predicate",
    f"""
    SELECT user_id, min(rn) AS group_start, count(*) AS n,
           string_agg(event_id::VARCHAR, ',' ORDER BY rn) AS payloads
    FROM ({TRIGGERED}) GROUP BY user_id, grp
    HAVING sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) > 0
    """,
)
def agg_predicate(spark, sf_dir):
    return aggregate(
        narrow_events(spark, sf_dir), {"user_id": "user_id"}, ["ts", "event_id"],
        closes="event_type = 'purchase'", output=whole("event_id"),
    )


@query(
    "aggregate_group_timeout",
    f"""
    WITH numbered AS ({NUMBERED.format(key="user_id")}),
    broken AS (SELECT *, CASE WHEN ts > lag(ts) OVER w + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS brk
               FROM numbered WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    grouped AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM broken)
    SELECT user_id, min(rn) AS group_start, count(*) AS n,
           string_agg(event_id::VARCHAR, ',' ORDER BY rn) AS payloads
    FROM grouped GROUP BY user_id, grp
    """,
)
def agg_timeout(spark, sf_dir):
    return aggregate(
        narrow_events(spark, sf_dir), {"user_id": "user_id"}, ["ts", "event_id"],
        gap="6 hours", time="ts", output=whole("event_id"),
    )


@query(
    "aggregate_output",
    f"""
    SELECT user_id, min(rn) AS group_start, count(*) AS n,
           coalesce(string_agg(CASE WHEN event_type = 'view' THEN upper(event_type) || '#' || event_id END, ','
                      ORDER BY rn), '') AS payloads
    FROM ({TRIGGERED}) GROUP BY user_id, grp
    HAVING sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) > 0
    """,
)
def agg_output(spark, sf_dir):
    return aggregate(
        narrow_events(spark, sf_dir), {"user_id": "user_id"}, ["ts", "event_id"], closes="event_type = 'purchase'",
        output=whole("IF(event_type = 'view', concat(upper(event_type), '#', event_id), NULL)"),
    )


@query(
    "aggregate_output_fold",
    f"""
    SELECT user_id, min(rn) AS group_start, count(*) AS n,
           CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total, max(value) AS top
    FROM ({TRIGGERED}) GROUP BY user_id, grp
    HAVING sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) > 0
    """,
)
def agg_output_fold(spark, sf_dir):
    groups = aggregate(
        table(spark, sf_dir, "events"), {"user_id": "user_id"}, ["ts", "event_id"],
        closes="event_type = 'purchase'",
        output={"total": F.sum(F.expr("CAST(value AS DECIMAL(18, 2))")).cast("double"), "top": F.max("value")},
    )
    return groups


@query(
    "http_request_columns",
    """
    SELECT event_id, 'https://api.example/' || event_type || '/' || user_id AS request_url,
           CASE WHEN value > 100 THEN 'POST' ELSE 'GET' END AS request_method, props AS request_body,
           CASE WHEN event_type = 'error' THEN 'accept=json' ELSE 'accept=json,x-user=' || user_id END
             AS request_headers
    FROM events
    """,
)
def http_request_columns(spark, sf_dir):
    return _requests(event_messages(spark, sf_dir)).select(
        "event_id", "request_url", "request_method", "request_body", flat_map("request_headers").alias("request_headers")
    )


REQUEST = {
    "url": "concat('https://api.example/', event_type, '/', user_id)",
    "method": "IF(value > 100, 'post', 'get')",
    "headers": {"accept": "'json'", "x-user": "IF(event_type = 'error', NULL, user_id)"},
}


def _requests(messages):
    return http_requests(messages, REQUEST["url"], method=REQUEST["method"], headers=REQUEST["headers"])


@query(
    "http_enrich",
    """
    SELECT event_id, CASE WHEN value > 100 THEN 'POST' ELSE 'GET' END || ' https://api.example/' || event_type
           || '/' || user_id || ' ' || props || ' 200' AS payload
    FROM events
    """,
)
def http_call(spark, sf_dir):
    def echo():
        def send(method, url, headers, body, timeout):
            return {"status": 200, "headers": {}, "body": f"{method} {url} {body}"}

        return send

    answered = http_enrich(
        event_messages(spark, sf_dir), echo, REQUEST["url"], method=REQUEST["method"], headers=REQUEST["headers"],
        reply="concat(reply_body, ' ', reply_status)",
    )
    return answered.select("event_id", "payload")


@query(
    "http_enrich_window",
    """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE 'seen ' || props END AS payload,
           CASE WHEN event_type = 'error' THEN 'ConnectionError: gone' END AS reply_error
    FROM events
    """,
)
def http_window(spark, sf_dir):
    """Sixteen requests in flight per task; a failure is a row."""

    def slow():
        def send(method, url, headers, body, timeout):
            if url.endswith("error"):
                raise ConnectionError("gone")
            return {"status": 200, "headers": {}, "body": f"seen {body}"}

        return send

    answered = http_enrich(
        event_messages(spark, sf_dir), slow, "concat('https://api.example/', event_type)", in_flight=16, errors="rows"
    )
    return answered.select("event_id", "payload", "reply_error")


@query(
    "task_request_build",
    """
    SELECT event_id, '{"args":["--fixed","kind=' || upper(event_type) || '","user=' || user_id
           || '"],"deploymentProps":{"count":"3","tags":"a,b"},"name":"' || event_type || '_task"}' AS payload,
           'application/json' AS content_type
    FROM events
    """,
)
def task_request(spark, sf_dir):
    made = task_request_build(
        event_messages(spark, sf_dir), name_expr="concat(event_type, '_task')", args=["--fixed"],
        arg_exprs={"kind": "upper(event_type)", "user": "headers['user-id']"}, deployment="count=3,tags=a,b",
    )
    return made.select("event_id", "payload", F.col("headers")["contentType"].alias("content_type"))


@query(
    "kv_list_parse",
    """
    SELECT event_id, 'k=' || replace(props, '=', '') || ',kind=' || event_type || ',' || user_id || ',x,user=2=2'
             AS entries
    FROM events
    """,
)
def kv_list(spark, sf_dir):
    text = "concat('dropped,user=', user_id, ', kind = ', event_type, ',', user_id, ',x,user=2=2,k=', props)"
    parsed = table(spark, sf_dir, "events").select("event_id", kv_list_parse(text).alias("map"))
    return parsed.select("event_id", flat_map("map").alias("entries"))


@query(
    "image_inference",
    """
    SELECT page_id, '{"className":"page","probability":1.0,"bytes":' || strlen(html) || '}' AS cvjson,
           strlen(html)::INT AS n_bytes
    FROM pages
    """,
)
def infer(spark, sf_dir):
    def load():
        def predict(image):
            return f'{{"className":"page","probability":1.0,"bytes":{len(image)}}}', None

        return predict

    images = to_messages(
        table(spark, sf_dir, "pages"), "encode(html, 'UTF-8')", headers={"contentType": "'image/png'"}, keep=["page_id"]
    )
    return image_inference(images, load).select(
        "page_id", F.col("headers")["cvjson"].alias("cvjson"), F.octet_length("payload").alias("n_bytes")
    )


@query(
    "detection_postprocess",
    """
    WITH boxes AS (
      SELECT l_orderkey AS image, l_linenumber + 5 AS rank, (l_suppkey % 30)::INT AS class_id,
             l_discount * 10 AS score, l_quantity AS y_min, l_quantity * 2 AS x_min,
             l_quantity + l_linenumber AS y_max, l_quantity * 2 + l_suppkey AS x_max
      FROM lineitem)
    SELECT image, rank, class_id, score AS probability, x_min AS x, y_min AS y, x_max - x_min AS width,
           y_max - y_min AS height, coalesce(n_name, '#' || class_id) AS class_name
    FROM boxes LEFT JOIN nation ON n_nationkey = class_id
    WHERE rank <= 10 AND class_id > 0 AND score > 0.3
    """,
)
def detections(spark, sf_dir):
    boxes = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS image", "l_linenumber + 5 AS rank", "CAST(l_suppkey % 30 AS INT) AS class_id",
        "l_discount * 10 AS score", "l_quantity AS y_min", "l_quantity * 2 AS x_min",
        "l_quantity + l_linenumber AS y_max", "l_quantity * 2 + l_suppkey AS x_max",
    )
    labels = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS class_id", "n_name AS label")
    return detection_postprocess(boxes, labels)


@query(
    "prediction_json",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag AS class_name, l_discount AS probability,
           l_quantity AS x
    FROM lineitem
    """,
)
def prediction(spark, sf_dir):
    found = """array(named_struct('className', l_returnflag, 'probability', l_discount, 'boundingBox',
               named_struct('x', l_quantity, 'y', l_tax, 'width', l_tax, 'height', l_quantity)))"""
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    texts = table(spark, sf_dir, "lineitem").select(*keys, prediction_to_json(found).alias("cvjson"))
    back = texts.select(*keys, F.explode(prediction_from_json("cvjson", "detection")).alias("one"))
    return back.select(
        *keys, F.col("one.className").alias("class_name"), F.col("one.probability").alias("probability"),
        F.col("one.boundingBox.x").alias("x"),
    )


#: Bytes of archives that a task gathers before they leave it.
ARCHIVES = 4_000_000


def packed(batches):
    """Each document as a zip file of its text and language, one in ten cut off."""
    import io
    import zipfile

    import pyarrow as pa

    def as_batch(held):
        columns = [pa.array(column, kind) for column, kind in zip(zip(*held, strict=True), (pa.string(), pa.string(), pa.binary()), strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["path", "tag", "payload"])

    for batch in batches:
        held, size = [], 0
        for doc, text, lang in zip(*(batch.column(name) for name in ("doc_id", "text", "lang")), strict=True):
            doc, lang = doc.as_py(), lang.as_py()
            blob = io.BytesIO()
            with zipfile.ZipFile(blob, "w") as archive:
                archive.writestr("body.txt", text.as_py())
                archive.writestr("meta/lang.txt", lang)
            # One in ten is cut off and so no archive any more.
            held.append((f"{doc}.zip", lang, blob.getvalue()[: 20 if doc % 10 == 3 else None]))
            size += len(held[-1][2])
            if size >= ARCHIVES:
                yield as_batch(held)
                held, size = [], 0
        if held:
            yield as_batch(held)


@query(
    "archive_expand",
    """
    SELECT doc_id || '.zip' AS path, lang AS tag, 1 AS entry_no, 'body.txt' AS entry, text AS payload, false AS broken
    FROM documents WHERE doc_id % 10 <> 3
    UNION ALL
    SELECT doc_id || '.zip', lang, 2, 'meta/lang.txt', lang, false FROM documents WHERE doc_id % 10 <> 3
    UNION ALL
    SELECT doc_id || '.zip', lang, NULL, NULL, NULL, true FROM documents WHERE doc_id % 10 = 3
    """,
)
def archives(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    entries = archive_expand(docs.mapInArrow(packed, "path string, tag string, payload binary"))
    return entries.select(
        "path", "tag", "entry_no", "entry", F.decode("payload", "UTF-8").alias("payload"), F.col("error").isNotNull().alias("broken")
    )


COMPOSED = """
    SELECT event_id, upper(props) AS payload, 'contentType=application/json,size=' || length(props) AS headers
    FROM events WHERE event_type <> 'error'
"""


@query("pipeline_compose", COMPOSED)
@query(
    "step_compose",
    """
    SELECT event_id, upper(props) AS payload, 'contentType=application/json,size=' || length(props) AS headers
    FROM events WHERE event_type <> 'error'
    """,
)
def composed(spark, sf_dir):
    steps = {
        "keep": lambda df: tr.filter_rows(df, "event_type <> 'error'"),
        "size": lambda df: tr.header_enrich(df, {"size": "length(payload)"}),
        "loud": lambda df: tr.transform_payload(df, "upper(payload)"),
        "tidy": lambda df: tr.header_remove(df, "kind,user-id"),
    }
    rows = event_messages(spark, sf_dir).transform(compose("keep | size | loud | tidy", steps))
    return rows.select("event_id", "payload", flat_map("headers").alias("headers"))


@query(
    "json_recursive_path",
    """SELECT event_id, (json_extract_string(props, '$.k')) || ',' || event_type AS found FROM events""",
)
def recursive_path(spark, sf_dir):
    nested = "to_json(named_struct('a', named_struct('k', get_json_object(props, '$.k')), 'b', array(named_struct('k', event_type))))"
    rows = table(spark, sf_dir, "events").select("event_id", F.expr(nested).alias("payload"))
    return rows.select("event_id", F.array_join(json_find(F.col("payload"), "k"), ",").alias("found"))


@query(
    "expression_surface",
    """
    SELECT event_id, length(event_type) > 5 AS long_name, upper(event_type) AS loud, substr(event_type, 1, 4) AS head,
           string_split(props, ':')[1] AS first_part, reverse(event_type) AS mirrored,
           event_type || '-' || user_id AS glued, user_id + 624 AS plus, json_extract_string(props, '$.k') AS k,
           len(list_filter([event_type, 'view'], lambda x: x = 'view'))::INT AS views,
           regexp_matches(event_type, '^(cl|si)') AS starts, strftime(ts, '%m/%d/%y %H:%M:%S') AS clock,
           epoch_us(ts) // 1000000 AS seconds
    FROM events
    """,
)
def expressions(spark, sf_dir):
    rows = event_messages(spark, sf_dir)
    return rows.selectExpr(
        "event_id",
        "length(event_type) > 5 AS long_name",
        "upper(event_type) AS loud",
        "substring(event_type, 1, 4) AS head",
        "split(payload, ':')[0] AS first_part",
        "reverse(event_type) AS mirrored",
        "concat(event_type, '-', headers['user-id']) AS glued",
        "user_id + 624 AS plus",
        "get_json_object(payload, '$.k') AS k",
        "size(filter(array(event_type, 'view'), x -> x = 'view')) AS views",
        "event_type RLIKE '^(cl|si)' AS starts",
        "date_format(msg_ts, 'MM/dd/yy HH:mm:ss') AS clock",
        "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', msg_ts) AS seconds",
    )
