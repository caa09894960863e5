"""Sinks over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowframe.envelope import to_messages
from flowframe.operators import metrics
from flowframe.operators.delivery import Backoff, delivery_retry
from flowframe.plans.scratch import scratch_path
from flowframe.sinks import routes, tables
from flowframe.sinks.objects import write_objects
from flowframe.sources import files
from wiring.base import event_messages, flat_map, joined, query, table

AMOUNT = "CAST(value AS DECIMAL(18, 2))"


@query(
    "metric_counter",
    """
    SELECT 'events.' || event_type AS name, 'shop' AS tag_app, user_id::VARCHAR AS tag_user,
           CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS amount
    FROM events GROUP BY ALL
    """,
)
def counter(spark, sf_dir):
    return metrics.metric_counter(
        event_messages(spark, sf_dir), "concat('events.', event_type)", amount=AMOUNT,
        fixed={"app": "shop", "blank": " "}, tags={"user": "headers['user-id']"},
    )


@query(
    "metric_counter_default",
    "SELECT event_type AS name, CAST(count(*) AS DOUBLE) AS amount FROM events GROUP BY event_type",
)
def counter_default(spark, sf_dir):
    return metrics.metric_counter(table(spark, sf_dir, "events"), "event_type")


@query(
    "metric_gauge",
    """
    SELECT event_type AS name, (user_id % 10)::VARCHAR AS tag_cell, CAST(trunc(arg_max(value, (ts, event_id))) AS BIGINT) AS value
    FROM events GROUP BY ALL
    """,
)
def gauge(spark, sf_dir):
    return metrics.metric_gauge(
        table(spark, sf_dir, "events"), "event_type", ["ts", "event_id"], amount="value",
        tags={"cell": "user_id % 10"},
    )


@query(
    "metric_tags",
    """
    WITH lists AS (
      SELECT event_id,
             CASE WHEN event_type = 'error' THEN ['NA'] ELSE [event_type, 'u' || (user_id % 3)] END AS kinds,
             CASE WHEN user_id % 7 = 0 THEN 'NA' ELSE (user_id % 7)::VARCHAR END AS cell
      FROM events)
    SELECT event_id, 'app=shop,cell=' || CASE WHEN i = 1 THEN cell ELSE '' END || ',kinds=' || kinds[i] AS tags
    FROM (SELECT *, unnest(range(1, len(kinds) + 1)) AS i FROM lists)
    """,
)
def tags(spark, sf_dir):
    tagged = metrics.metric_tags(
        table(spark, sf_dir, "events"), fixed={"app": "shop", "cell": "lost", "empty": ""},
        tags={
            "kinds": "IF(event_type = 'error', array(' ', NULL), array(event_type, '', NULL, concat('u', user_id % 3)))",
            "cell": "NULLIF(user_id % 7, 0)",
        },
    )
    return tagged.select("event_id", flat_map("tags").alias("tags"))


@query(
    "metric_name",
    """
    SELECT CASE WHEN event_type IN ('view', 'click') THEN 'empty' ELSE event_type END AS name, count(*) AS n
    FROM events GROUP BY ALL
    """,
)
def name(spark, sf_dir):
    expression = "CASE event_type WHEN 'view' THEN ' \t' WHEN 'click' THEN NULL ELSE event_type END"
    return table(spark, sf_dir, "events").select(metrics.metric_name(expression).alias("name")).groupBy("name").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "metric_line_format",
    """
    SELECT event_id,
           CASE WHEN event_type <> 'error' AND user_id % 11 <> 0 THEN
             '"shop.value" ' || user_id || ' ' || (epoch_us(ts) // 1000000) || ' source=web'
             || CASE WHEN event_type = 'view' THEN '' ELSE ' kind="' || event_type || '"' END
             || ' user="u' || user_id || '"' END AS line,
           CASE WHEN event_type = 'error' THEN 'the metric value is not a number'
                WHEN user_id % 11 = 0 THEN 'the timestamp is not a number' END AS error
    FROM events
    """,
)
def metric_line(spark, sf_dir):
    seconds = "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', date_trunc('SECOND', ts))"
    lines = metrics.metric_line_format(
        table(spark, sf_dir, "events"), "shop.value", "IF(event_type = 'error', 'n/a', CAST(user_id AS STRING))", "web",
        timestamp=f"IF(user_id % 11 = 0, 'never', CAST({seconds} AS STRING))",
        tags={"user": "concat('u', user_id)", "kind": "IF(event_type = 'view', NULL, event_type)"},
    )
    return lines.select("event_id", "line", "error")


@query(
    "column_map_insert",
    """
    SELECT event_id AS id, json_extract_string(props, '$.k')::INT AS k, substr(event_type, 1, 4) AS a,
           json_extract_string(props, '$.k')::INT + 624 AS b, event_type AS kind, NULL::VARCHAR AS gone,
           CASE WHEN json_extract_string(props, '$.k')::INT % 2 <> 0 THEN json_extract_string(props, '$.k')::INT END AS odd
    FROM events
    """,
)
def mapped(spark, sf_dir):
    return tables.column_map_insert(
        event_messages(spark, sf_dir),
        "id: event_id, k, a: substring(event_type\\, 1\\, 4), b: k + 624, kind: headers['kind'], gone: nowhere, "
        "odd: CAST(IF(payload.k % 2 = 0\\, 'x'\\, string(payload.k)) AS INT)",
        payload_type="k INT",
    )


@query(
    "batch_flush",
    """
    WITH numbered AS (SELECT *, row_number() OVER w AS rn,
                             CASE WHEN ts > lag(ts) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS brk
                      FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
    segmented AS (SELECT *, sum(brk) OVER (PARTITION BY event_type ORDER BY ts, event_id
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg FROM numbered),
    placed AS (SELECT *, row_number() OVER (PARTITION BY event_type, seg ORDER BY ts, event_id) - 1 AS pos FROM segmented)
    SELECT event_type AS kind, min(rn) AS group_start, count(*) AS n,
           string_agg(event_id::VARCHAR, ',' ORDER BY rn) AS payloads
    FROM placed GROUP BY event_type, seg, pos // 8
    """,
)
def batches(spark, sf_dir):
    flushed = tables.batch_flush(
        table(spark, sf_dir, "events"), ["ts", "event_id"], batch_rows=8, idle="30 minutes", time="ts",
        kind="event_type", payload="event_id",
    )
    return flushed.select("kind", "group_start", "n", joined("payloads").alias("payloads"))


@query(
    "table_init",
    "SELECT event_id::VARCHAR AS id, event_type AS kind, props AS payload FROM events",
)
def new_table(spark, sf_dir):
    path = scratch_path(spark, "table")
    name = "flowframe_" + path.rsplit("-", 1)[1]
    tables.table_init(spark, name, ["id", "kind", "payload"], location=path)
    rows = tables.column_map_insert(event_messages(spark, sf_dir), "id: event_id, kind: event_type, payload")
    tables.table_append(rows, name)
    return spark.table(name)


@query(
    "json_ingest_rows",
    """
    SELECT o_orderkey, isbn, title, pages, sale_date, in_stock FROM (
      SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN '00000000-0000-4000-8000-' || lpad(o_orderkey::VARCHAR, 12, '0') END AS isbn,
             'Order of ' || o_custkey AS title, o_custkey::INT AS pages, o_orderdate::DATE AS sale_date,
             o_orderstatus = 'O' AS in_stock FROM orders
      UNION ALL
      SELECT o_orderkey, NULL, o_orderpriority, NULL, NULL, NULL FROM orders WHERE o_orderkey % 2 = 0)
    """,
)
def ingest(spark, sf_dir):
    first = """named_struct('myIsbn', IF(o_orderkey % 9 <> 0,
                 concat('00000000-0000-4000-8000-', lpad(CAST(o_orderkey AS STRING), 12, '0')), 'none'),
               'title', concat('Order of ', o_custkey), 'pages', o_custkey,
               'sale_date', date_format(o_orderdate, 'yyyy-MM-dd'), 'in_stock', o_orderstatus = 'O')"""
    second = "named_struct('title', o_orderpriority, 'sale_date', 'soon')"
    body = f"""IF(o_orderkey % 2 = 0, concat('[', to_json({first}), ',', to_json({second}), ']'), to_json({first}))"""
    messages = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(body).alias("payload"))
    return tables.json_ingest_rows(
        messages, "isbn STRING, title STRING, pages INT, sale_date STRING, in_stock BOOLEAN",
        names={"isbn": "myIsbn"}, dates=["sale_date"], uuids=["isbn"], keep=["o_orderkey"],
    )


@query(
    "table_upsert",
    """
    WITH changes AS (SELECT user_id AS c_custkey, 'user ' || event_type AS c_name, value AS c_acctbal, ts,
                            row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    SELECT coalesce(c.c_custkey, n.c_custkey) AS c_custkey, coalesce(n.c_name, c.c_name) AS c_name,
           CASE WHEN n.c_custkey IS NOT NULL THEN n.c_acctbal ELSE c.c_acctbal END AS c_acctbal,
           n.ts + INTERVAL 2 DAY AS expires_at
    FROM (SELECT * FROM customer) c FULL JOIN (SELECT * FROM changes WHERE rn = 1) n ON c.c_custkey = n.c_custkey
    """,
)
def upsert(spark, sf_dir):
    changes = table(spark, sf_dir, "events").selectExpr(
        "user_id AS c_custkey", "concat('user ', event_type) AS c_name", "value AS c_acctbal", "ts", "event_id"
    )
    target = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return tables.table_upsert(target, changes, ["c_custkey"], ["ts", "event_id"], ttl="2 days", written_at="ts")


def _routed(spark, sf_dir):
    messages = to_messages(
        table(spark, sf_dir, "events"), "props",
        headers={
            "INDEX_NAME": "IF(event_type = 'error', 'errors', NULL)",
            "INDEX_ID": "IF(event_type = 'view', concat('v', user_id), NULL)",
        },
        keep=["event_id", "user_id", "event_type", "ts", "value"],
    )
    return routes.index_route(messages, "events", doc_id="IF(event_type = 'click', NULL, user_id)")


ROUTED = """
    SELECT *, CASE WHEN event_type = 'error' THEN 'errors' ELSE 'events' END AS index,
           CASE event_type WHEN 'view' THEN 'v' || user_id WHEN 'click' THEN NULL ELSE user_id::VARCHAR END AS id
    FROM events
"""


@query("index_route", f"SELECT event_id, index, id, props AS doc FROM ({ROUTED})")
def index(spark, sf_dir):
    return _routed(spark, sf_dir).select("event_id", "index", "id", "doc")


@query(
    "index_last_documents",
    f"""
    SELECT index, id, event_id, props AS doc FROM (
      SELECT *, row_number() OVER (PARTITION BY index, id ORDER BY ts DESC, event_id DESC) AS rn FROM ({ROUTED}))
    WHERE rn = 1 OR id IS NULL
    """,
)
def index_last(spark, sf_dir):
    return routes.last_documents(_routed(spark, sf_dir), ["ts", "event_id"]).select("index", "id", "event_id", "doc")


@query(
    "bulk_result_check",
    """
    WITH placed AS (SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 25 AS batch_no,
                           CASE WHEN value > 100 THEN 'rejected ' || event_id END AS error FROM events)
    SELECT event_type, batch_no, count(*) AS items, count(error) AS failed,
           string_agg(coalesce(error, ''), ' : ' ORDER BY ts, event_id) AS message
    FROM placed GROUP BY ALL HAVING count(error) > 0
    """,
)
def bulk(spark, sf_dir):
    sent = tables.flush_numbers(
        table(spark, sf_dir, "events"), ["ts", "event_id"], 25, kind="event_type"
    ).withColumn("error", F.expr("IF(value > 100, concat('rejected ', event_id), NULL)"))
    return routes.bulk_result_check(sent, ["event_type", "batch_no"], ["ts", "event_id"])


@query(
    "bulk_write",
    f"""
    SELECT index, id, CASE WHEN length(props) > 8 THEN 'too long: ' || length(props) END AS error FROM ({ROUTED})
    """,
)
def bulk_send(spark, sf_dir):
    def client():
        def send(items):
            return [f"too long: {len(doc)}" if len(doc) > 8 else None for doc in items.column("doc").to_pylist()]

        return send

    return routes.bulk_write(_routed(spark, sf_dir), client, batch_rows=500)


@query(
    "file_write",
    "SELECT event_id, 'out/' || event_type AS dir, 'user-' || user_id || '.json' AS file, props AS content FROM events",
)
def file_rows(spark, sf_dir):
    return routes.file_write(
        event_messages(spark, sf_dir), directory_expr="concat('out/', event_type)",
        name_expr="concat('user-', user_id)", suffix="json", keep=["event_id"],
    )


@query(
    "file_write_read_back",
    "SELECT event_type AS dir, props AS content, count(*) AS n FROM events GROUP BY ALL",
)
def file_round_trip(spark, sf_dir):
    path = scratch_path(spark, "files")
    rows = routes.file_write(event_messages(spark, sf_dir), directory_expr="event_type", name="events")
    routes.write_partitioned(rows, path, ["dir", "file"])
    back = spark.read.text(path).select("dir", F.col("value").alias("content"))
    return back.groupBy("dir", "content").agg(F.count(F.lit(1)).alias("n"))


@query(
    "object_write",
    """
    SELECT event_id, 'bucket-' || (user_id % 5) AS bucket, event_type || '/' || event_id || '.json' AS key,
           CASE WHEN value > 100 THEN 'private' ELSE 'public-read' END AS acl, props AS content
    FROM events
    """,
)
def objects(spark, sf_dir):
    return routes.object_write(
        event_messages(spark, sf_dir), bucket_expr="concat('bucket-', user_id % 5)",
        key_expr="concat(event_type, '/', event_id, '.json')",
        acl_expr="IF(value > 100, 'private', 'public-read')", keep=["event_id"],
    )


@query(
    "object_write_read_back",
    """SELECT lang, doc_id::VARCHAR || '.txt' AS name, strlen(text)::BIGINT AS size, text AS payload FROM documents""",
)
def object_round_trip(spark, sf_dir):
    root = scratch_path(spark, "objects")
    messages = to_messages(table(spark, sf_dir, "documents"), "text", keep=["doc_id", "lang"])
    rows = routes.object_write(messages, bucket_expr="lang", key_expr="concat(doc_id, '.txt')")
    write_objects(rows, root, ["bucket", "key"])
    found = files.file_contents_scan(spark, root)
    parts = F.split("path", "/")
    return found.select(
        F.element_at(parts, -2).alias("lang"), F.element_at(parts, -1).alias("name"), "size",
        F.col("payload").cast("string").alias("payload"),
    )


@query(
    "collection_write",
    """
    SELECT o_orderkey, 'orders_' || lower(o_orderstatus) AS collection,
           '{"key":' || o_orderkey || ',"customer":' || o_custkey || ',"priority":"' || o_orderpriority || '"}' AS doc
    FROM orders
    """,
)
def collections(spark, sf_dir):
    messages = to_messages(
        table(spark, sf_dir, "orders"),
        "named_struct('key', o_orderkey, 'customer', o_custkey, 'priority', o_orderpriority)",
        keep=["o_orderkey", "o_orderstatus"],
    )
    return routes.collection_write(
        messages, collection_expr="concat('orders_', lower(o_orderstatus))", keep=["o_orderkey"]
    )


@query(
    "record_publish",
    """
    SELECT CASE WHEN event_type = 'view' THEN 'fallback' ELSE 'topic-' || event_type END AS topic,
           user_id::VARCHAR AS key, props AS value, (user_id % 4)::INT AS partition,
           'kind=' || event_type || ',user-id=' || user_id || ',timestamp=' || event_id AS headers
    FROM events
    """,
)
def publish(spark, sf_dir):
    records = routes.record_publish(
        event_messages(spark, sf_dir), topic="fallback",
        topic_expr="IF(event_type = 'view', NULL, concat('topic-', event_type))", key_expr="user_id",
        partition_expr="user_id % 4", timestamp_expr="event_id", header_patterns=["k*", "user-*"],
    )
    texts = F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), h["value"].cast("string")))
    return records.withColumn("headers", F.array_join(texts, ","))


@query(
    "route_project",
    """
    SELECT event_id, 'exchange' AS dest_kind, 'shop' AS dest, event_type || '.' || user_id AS routing_key, props AS content
    FROM events
    UNION ALL
    SELECT event_id, 'queue', 'q-' || event_type, NULL, props FROM events
    UNION ALL
    SELECT event_id, 'topic', 'news', NULL, props FROM events
    """,
)
def routed(spark, sf_dir):
    messages = event_messages(spark, sf_dir)
    exchange = routes.route_project(
        messages, kind="exchange", dest="shop", routing_key_expr="concat(event_type, '.', user_id)", keep=["event_id"]
    )
    queue = routes.route_project(messages, kind="queue", dest_expr="concat('q-', event_type)", keep=["event_id"])
    topic = routes.route_project(messages, kind="topic", dest="news", keep=["event_id"])
    return exchange.unionByName(queue).unionByName(topic)


@query(
    "log_write",
    "SELECT event_id, 'WARN' AS level, 'events' AS logger, event_type || ': ' || props AS text FROM events",
)
def logged(spark, sf_dir):
    return routes.log_write(
        event_messages(spark, sf_dir), "concat(event_type, ': ', payload)", level="warn", name="events", keep=["event_id"]
    )


LOGGED = """
    SELECT event_type || '.log' AS name, row_number() OVER (PARTITION BY event_type ORDER BY event_id % 2, ts, event_id) AS line_no,
           {line} AS payload
    FROM events
"""


@query("file_write_append", LOGGED.format(line="event_id || ' ' || props"))
def appended(spark, sf_dir):
    """Two runs into the same files, in order: the first replaces, the second appends."""
    root = scratch_path(spark, "appended")
    lines = table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "concat(event_type, '.log') AS name", "concat(event_id, ' ', props) AS content"
    )
    for rest, exists in ((0, "replace"), (1, "append")):
        write_objects(lines.filter(f"event_id % 2 = {rest}"), root, ["name"], exists=exists, order_by=["ts", "event_id"], line_end="\n")
    found = files.file_lines_scan(spark, root, numbered=True)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "line_no", "payload")


@query(
    "file_write_shares",
    """
    SELECT event_type || '-' || lpad(((rn - 1) // 500)::VARCHAR, 5, '0') || '.log' AS name, count(*) AS n, min(event_id) AS first, max(event_id) AS last
    FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events) GROUP BY ALL
    """,
)
def shared_files(spark, sf_dir):
    """A name that very many rows have becomes numbered files of 500 rows."""
    root = scratch_path(spark, "shares")
    lines = table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "concat(event_type, '.log') AS name", "CAST(event_id AS STRING) AS content"
    )
    write_objects(lines, root, ["name"], order_by=["ts", "event_id"], line_end="\n", share_rows=500)
    found = files.file_lines_scan(spark, root).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), F.col("payload").cast("bigint").alias("event_id")
    )
    return found.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"), F.max("event_id").alias("last"))


@query(
    "table_upsert_buckets",
    """
    WITH n AS (SELECT l_orderkey AS o_orderkey, l_returnflag AS o_orderpriority, l_extendedprice AS o_totalprice,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem WHERE l_orderkey % 50 = 0)
    SELECT o.o_orderkey, coalesce(n.o_orderpriority, o.o_orderpriority) AS o_orderpriority, coalesce(n.o_totalprice, o.o_totalprice) AS o_totalprice
    FROM orders o LEFT JOIN n ON n.o_orderkey = o.o_orderkey AND n.rn = 1
    """,
)
def upsert_in_buckets(spark, sf_dir):
    """Orders in 64 buckets; the changes of a few keys rewrite only the buckets these lie in."""
    path = scratch_path(spark, "orders-in-buckets")
    columns = ["o_orderkey", "o_orderpriority", "o_totalprice"]
    tables.create_buckets(table(spark, sf_dir, "orders").select(*columns), path, ["o_orderkey"], 64)
    changes = table(spark, sf_dir, "lineitem").filter("l_orderkey % 50 = 0").selectExpr(
        "l_orderkey AS o_orderkey", "l_returnflag AS o_orderpriority", "l_extendedprice AS o_totalprice", "l_linenumber", "l_partkey", "l_suppkey"
    )
    tables.upsert_buckets(
        spark, path, changes, ["o_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], 64, update_only=True
    )
    return spark.read.parquet(path).select(*columns)


@query(
    "delivery_retry",
    """
    WITH tries AS (SELECT *, unnest(range(1, least(user_id % 5, 2) + 2)) AS attempt, user_id % 5 AS failing FROM events)
    SELECT event_id, CAST(attempt AS INT) AS attempt, ts + (CASE attempt WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 3 END) * INTERVAL 1 SECOND AS due,
      CASE WHEN attempt > failing THEN 'delivered' WHEN attempt = 3 THEN 'dead' ELSE 'retry' END AS outcome,
      CASE WHEN attempt > failing THEN NULL ELSE 'refused ' || attempt END AS error
    FROM tries
    """,
)
def retried(spark, sf_dir):
    """A receiver that refuses a record a number of times: at most three attempts, 1 s apart and then 2 s."""

    def receiver():
        def send(batch):
            return [f"refused {k}" if k <= user % 5 else None for user, k in zip(*(batch.column(c).to_pylist() for c in ("user_id", "attempt")), strict=True)]

        return send

    messages = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    tried = delivery_retry(messages, receiver, "ts", backoff=Backoff(attempts=3, first=1, most=30, factor=2))
    return tried.select("event_id", "attempt", "due", "outcome", "error")
