"""Sources over the test tables, and over files Spark writes from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowframe.envelope import to_messages
from flowframe.plans.ordered import running_totals
from flowframe.plans.scratch import cut_lineage, scratch_path
from flowframe.sources import feeds, files, tables, wire
from flowframe.sources.seen import mark_seen_large
from wiring.base import document_files, document_objects, document_of, joined, query, table


@query(
    "file_contents_scan",
    "SELECT doc_id, strlen(text)::BIGINT AS size, sha256(text) AS content, 'application/octet-stream' AS content_type FROM documents",
)
def file_contents(spark, sf_dir):
    whole = files.file_contents_scan(spark, document_objects(spark, sf_dir), glob="*.txt")
    return whole.select(
        document_of().alias("doc_id"), "size", F.sha2("payload", 256).alias("content"),
        F.col("headers")["contentType"].alias("content_type"),
    )


@query(
    "file_lines_scan",
    "SELECT source, unnest(string_split(text, chr(10))) AS payload, 'text/plain' AS content_type FROM documents",
)
def file_lines(spark, sf_dir):
    lines = files.file_lines_scan(spark, document_files(spark, sf_dir, "source"), glob="*.txt")
    return lines.select(
        F.regexp_extract("path", "source=([^/]+)/", 1).alias("source"),
        "payload",
        F.col("headers")["contentType"].alias("content_type"),
    )


#: A file's last line end begins no further line, and an empty file has none.
FILE_LINES = """
    (SELECT doc_id, string_split(regexp_replace(text, chr(10) || '$', ''), chr(10)) AS lines FROM documents WHERE text <> '')
"""


@query(
    "file_lines_numbered",
    f"SELECT doc_id, unnest(range(1, len(lines) + 1)) AS line_no, unnest(lines) AS payload FROM {FILE_LINES}",
)
def file_lines_numbered(spark, sf_dir):
    lines = files.file_lines_scan(spark, document_objects(spark, sf_dir), glob="*.txt", numbered=True)
    return lines.select(document_of().alias("doc_id"), "line_no", "payload")


@query(
    "file_lines_with_markers",
    f"""
    SELECT doc_id, unnest(range(0, len(lines) + 2)) AS seq, unnest(
             ['{{"mark":"START","lineCount":0}}'] || lines || ['{{"mark":"END","lineCount":' || len(lines) || '}}']) AS payload
    FROM {FILE_LINES}
    """,
)
def file_markers(spark, sf_dir):
    marked = files.file_lines_with_markers(spark, document_objects(spark, sf_dir), glob="*.txt")
    # The path is that of a scratch folder; the mark must name the row's own file.
    own = F.concat(F.lit('{"filePath":"'), F.col("path"), F.lit('",'))
    body = F.when(F.startswith("payload", own), F.concat(F.lit("{"), F.substring("payload", F.length(own) + 1, F.length("payload"))))
    return marked.select(document_of().alias("doc_id"), "seq", F.coalesce(body, "payload").alias("payload"))


@query(
    "file_ref_listing",
    """SELECT 'source=' || source AS folder, 'txt' AS kind, sum(strlen(text) + 1)::BIGINT AS size FROM documents GROUP BY source""",
)
def file_listing(spark, sf_dir):
    listed = files.file_ref_listing(spark, document_files(spark, sf_dir, "source"), glob="*.txt", sort_by="FILENAME")
    folder = F.element_at(F.split("path", "/"), -2).alias("folder")
    kind = F.element_at(F.split("name", "[.]"), -1).alias("kind")
    return listed.groupBy(folder, kind).agg(F.sum("size").alias("size"))


@query(
    "file_name_filter",
    """
    SELECT page_id, url, 'pattern' AS way FROM pages WHERE regexp_full_match(url, 'http[^/]*://[^/]*\\.example\\.[^/]*/en/.*')
    UNION ALL
    SELECT page_id, url, 'regex' FROM pages WHERE regexp_full_match(url, 'https?://[a-z]+\\..*[0-9]')
    """,
)
def file_names(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    by_pattern = files.file_name_filter(pages, "url", pattern="http*://*.example.*/en/**")
    by_regex = files.file_name_filter(pages, "url", regex=r"https?://[a-z]+\..*[0-9]")
    return by_pattern.withColumn("way", F.lit("pattern")).unionByName(by_regex.withColumn("way", F.lit("regex")))


#: What is listed, and a ledger that knows some files as they are, some with a later time, and some that are gone.
LISTING = "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 7 <> 0"
LEDGER = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END
            AS o_orderdate FROM orders WHERE o_orderstatus IN ('F', 'O')"""


@query(
    "accept_once",
    f"""
    WITH ledger AS ({LEDGER})
    SELECT o_orderkey, o_orderdate FROM ({LISTING}) o
    WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.o_orderkey = o.o_orderkey AND l.o_orderdate = o.o_orderdate)
    """,
)
def accept(spark, sf_dir):
    listing, ledger = _listing(spark, sf_dir)
    return files.accept_once(listing, ledger, key=["o_orderkey"], modified="o_orderdate")


def _listing(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    listing = orders.filter("o_orderkey % 7 <> 0").select("o_orderkey", "o_orderdate")
    stored = F.expr("IF(o_orderstatus = 'O', o_orderdate + INTERVAL 1 DAY, o_orderdate)")
    ledger = orders.filter("o_orderstatus IN ('F', 'O')").select("o_orderkey", stored.alias("o_orderdate"))
    return listing, ledger


@query(
    "accept_once_ledger",
    f"""
    SELECT coalesce(l.o_orderkey, k.o_orderkey) AS o_orderkey, coalesce(l.o_orderdate, k.o_orderdate) AS o_orderdate
    FROM ({LISTING}) l FULL JOIN ({LEDGER}) k ON l.o_orderkey = k.o_orderkey
    """,
)
def accept_ledger(spark, sf_dir):
    listing, ledger = _listing(spark, sf_dir)
    accepted = files.accept_once(listing, ledger, key=["o_orderkey"], modified="o_orderdate")
    return files.merge_ledger(ledger, accepted, key=["o_orderkey"], modified="o_orderdate")


@query(
    "post_read_disposition",
    """
    SELECT doc_id, CASE WHEN lang = 'en' THEN 'renamed' ELSE 'left' END AS outcome,
           CASE WHEN lang = 'en' THEN 'done-' ELSE '' END || doc_id || '.txt' AS name, strlen(text)::BIGINT AS size
    FROM documents
    """,
)
def disposition(spark, sf_dir):
    root = document_objects(spark, sf_dir)
    read = files.file_contents_scan(spark, root, glob="*.txt")
    name = "IF(path LIKE '%/en/%', concat('done-', element_at(split(path, '/'), -1)), '')"
    plan = cut_lineage(files.plan_disposition(read, rename=name))
    done = cut_lineage(files.apply_disposition(plan)).select(document_of().alias("doc_id"), "outcome")
    now = files.file_ref_listing(spark, root, glob="*.txt").select(document_of().alias("doc_id"), "name", "size")
    return done.join(now, "doc_id")


@query(
    "multi_source_read",
    """
    SELECT CASE WHEN lang IN ('en', 'fr') THEN 'west' ELSE 'east' END AS server,
           unnest(string_split(text, chr(10))) AS payload
    FROM documents
    """,
)
def multi_source(spark, sf_dir):
    root = document_files(spark, sf_dir, "lang")
    languages = sorted(row["lang"] for row in table(spark, sf_dir, "documents").select("lang").distinct().collect())
    sources = [f"{'west' if lang in ('en', 'fr') else 'east'}.lang={lang}" for lang in languages]
    read = files.multi_source_read(spark, sources, {"west": root, "east": root})
    return read.select(F.col("headers")["sftp_selectedServer"].alias("server"), "payload")


SQL_JOIN = """
    SELECT n_name, o_orderpriority, count(DISTINCT o_orderkey) AS n_orders,
           CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity
    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
    JOIN {nation} ON c_nationkey = n_nationkey
    WHERE l_discount > 0.03
    GROUP BY n_name, o_orderpriority
"""


@query("sql_query_source", SQL_JOIN.replace("{", "").replace("}", ""))
def sql_join(spark, sf_dir):
    names = ["lineitem", "orders", "customer", "nation"]
    return tables.sql_query_source(spark, SQL_JOIN, {name: table(spark, sf_dir, name) for name in names})


SQL_TOP = """
    SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey
"""


@query("sql_query_source_capped", SQL_TOP.replace("{", "").replace("}", "") + " LIMIT 100")
def sql_capped(spark, sf_dir):
    return tables.sql_query_source(spark, SQL_TOP, {"orders": table(spark, sf_dir, "orders")}, max_rows=100)


@query(
    "rows_or_list",
    """
    WITH placed AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)
    SELECT (rn - 1) // 1000 AS part, count(*) AS n,
           '[' || string_agg('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey
                             || ',"o_orderstatus":"' || o_orderstatus || '"}', ',' ORDER BY rn) || ']' AS payload
    FROM placed GROUP BY ALL
    """,
)
def row_list(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lists = tables.rows_or_list(orders, ["o_orderkey"], list_rows=1000)
    return lists.withColumn("payload", F.to_json("payload"))


@query("mark_seen", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'")
def seen(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "seen")
    tables.mark_seen(orders.filter("o_orderstatus = 'F'").select("o_orderkey"), path, ["o_orderkey"])
    return tables.mark_seen(orders.select("o_orderkey", "o_totalprice"), path, ["o_orderkey"])


@query("mark_seen_large", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'")
def seen_large(spark, sf_dir):
    """The same with a Bloom filter beside the ledger; what is new is not joined with it."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "seen")
    mark_seen_large(orders.filter("o_orderstatus = 'F'").select("o_orderkey"), path, ["o_orderkey"], buckets=64)
    return mark_seen_large(orders.select("o_orderkey", "o_totalprice"), path, ["o_orderkey"], buckets=64)


@query(
    "document_query",
    """
    SELECT event_id, 'equals' AS way FROM events WHERE event_type = 'purchase' AND json_extract_string(props, '$.k') = '42'
    UNION ALL
    SELECT event_id, 'exists' FROM events WHERE value > 100 AND event_type <> 'view'
    UNION ALL
    SELECT event_id, 'all' FROM events
    """,
)
def documents_found(spark, sf_dir):
    body = """to_json(named_struct('event', named_struct('kind', event_type, 'k', CAST(get_json_object(props, '$.k') AS INT)),
              'big', IF(value > 100, value, NULL), 'seen', IF(event_type = 'view', true, NULL)))"""
    docs = table(spark, sf_dir, "events").select("event_id", F.expr(body).alias("doc"))
    found = {
        "equals": tables.document_query(docs, "doc", equals={"event.kind": "purchase", "event.k": 42}),
        "exists": tables.document_query(docs, "doc", exists={"big": True, "seen": False}),
        "all": tables.document_query(docs, "doc"),
    }
    frames = [frame.select("event_id", F.lit(way).alias("way")) for way, frame in found.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "document_update",
    """
    SELECT event_id, CASE WHEN event_type = 'purchase' THEN '{"k":' || json_extract_string(props, '$.k') || ',"seen":true}' ELSE props END AS doc
    FROM (SELECT event_id, event_type, '{"k":' || json_extract_string(props, '$.k') || '}' AS props FROM events)
    """,
)
def documents_marked(spark, sf_dir):
    docs = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.expr("concat('{\"k\":', get_json_object(props, '$.k'), '}')").alias("doc")
    )
    return tables.document_update(docs, "doc", {"seen": True}, "event_type = 'purchase'").select("event_id", "doc")


def _records(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS STRING) AS key", "props AS value", "event_type AS topic",
        "CAST(user_id % 4 AS INT) AS `partition`", "event_id AS `offset`",
    )


@query(
    "record_stream_source",
    """
    SELECT event_id AS "offset", event_type AS topic, props AS value FROM events WHERE event_type IN ('click', 'view')
    """,
)
def record_stream(spark, sf_dir):
    return feeds.record_stream_source(_records(spark, sf_dir), topics=["error"], pattern="(c|v)i?.*(k|w)").select(
        "offset", "topic", "value"
    )


@query(
    "record_stream_batches",
    """
    WITH placed AS (
      SELECT *, user_id % 4 AS part,
             row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY event_id) - 1 AS rn
      FROM events WHERE event_type IN ('click', 'purchase'))
    SELECT event_type AS topic, part::INT AS "partition", rn // 50 AS batch, count(*) AS n, min(event_id) AS first_offset,
           string_agg(props, ',' ORDER BY rn) AS payload
    FROM placed GROUP BY ALL
    """,
)
def record_batches(spark, sf_dir):
    batches = feeds.record_stream_source(_records(spark, sf_dir), topics=["click", "purchase"], batch_rows=50)
    return batches.withColumn("payload", joined("payload"))


@query(
    "record_filter",
    "SELECT event_id, value FROM events WHERE event_type = 'view' OR value <= 100",
)
def discard(spark, sf_dir):
    return feeds.record_filter(
        table(spark, sf_dir, "events"), "IF(event_type = 'view', NULL, value > 100)"
    ).select("event_id", "value")


@query("clock_source", "SELECT event_id, strftime(ts, '%m/%d/%y %H:%M:%S') AS payload FROM events")
def clock(spark, sf_dir):
    return feeds.format_time(table(spark, sf_dir, "events"), "ts").select("event_id", "payload")


ROW = "id BIGINT, customer BIGINT, status STRING, price DOUBLE"


@query(
    "cdc_flatten",
    """
    SELECT o_orderkey AS id, o_custkey AS customer, CASE WHEN o_orderkey % 5 = 0 THEN 'old' ELSE o_orderstatus END AS status,
           o_totalprice AS price, CASE WHEN o_orderkey % 5 = 0 THEN 'true' ELSE 'false' END AS __deleted,
           CASE o_orderkey % 5 WHEN 0 THEN 'd' WHEN 1 THEN 'c' WHEN 2 THEN 'r' ELSE 'u' END AS __op,
           'shop.orders' AS __name, 'shop' AS __db, 'orders' AS __table
    FROM orders
    """,
)
def change_rows(spark, sf_dir):
    image = "to_json(named_struct('id', o_orderkey, 'customer', o_custkey, 'status', {status}, 'price', o_totalprice))"
    changes = table(spark, sf_dir, "orders").selectExpr(
        "CASE o_orderkey % 5 WHEN 0 THEN 'd' WHEN 1 THEN 'c' WHEN 2 THEN 'r' ELSE 'u' END AS op",
        f"IF(o_orderkey % 5 IN (0, 3, 4), {image.format(status=chr(39) + 'old' + chr(39))}, NULL) AS before",
        f"IF(o_orderkey % 5 = 0, NULL, {image.format(status='o_orderstatus')}) AS after",
    )
    return feeds.cdc_flatten(
        changes, ROW, metadata={"__name": "'shop.orders'", "__db": "'shop'", "__table": "'orders'"}
    )


@query(
    "cdc_latest",
    """
    SELECT user_id, event_id, ts, event_type, value, props
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1 AND event_type <> 'error'
    """,
)
def latest(spark, sf_dir):
    return feeds.cdc_latest(
        table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], deleted="event_type = 'error'"
    )


@query(
    "incremental_read",
    """
    SELECT event_id, value, (row_number() OVER (ORDER BY event_id DESC) - 1) // 100 AS page FROM events
    """,
)
def paged(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return feeds.incremental_read(events, -1, id_column="event_id", page_size=100)


@query(
    "first_seen_dedup",
    """
    SELECT user_id, event_type, event_id, ts, value, props
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)
    WHERE rn = 1
    """,
)
def first_seen(spark, sf_dir):
    return feeds.first_seen_dedup(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "stream_filter",
    """
    WITH posts AS (
      SELECT doc_id, lang, substr(source, 4)::BIGINT AS author_id, (n_chars % 180) - 90 AS lat,
             (n_chars % 360) - 180 AS lon, CASE doc_id % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'low' ELSE 'medium' END AS lev,
             regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+') AS words
      FROM documents)
    SELECT doc_id FROM posts
    WHERE (author_id IN (1, 2) OR list_contains(words, 'avec') OR (list_contains(words, 'hand') AND list_contains(words, 'was'))
           OR (lat BETWEEN 10 AND 30 AND lon BETWEEN 5 AND 20) OR (lat BETWEEN -40 AND -20 AND lon BETWEEN -100 AND 60))
      AND lang IN ('en', 'fr') AND lev IN ('low', 'medium')
    """,
)
def posts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "lang", "text", "CAST(substring(source, 4) AS BIGINT) AS author_id",
        "(n_chars % 180) - 90 AS lat", "(n_chars % 360) - 180 AS lon",
        "CASE doc_id % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'low' ELSE 'medium' END AS filter_level",
    )
    kept = feeds.stream_filter(
        rows, follow=[1, 2], track=["Avec", "was hand"], boxes=[(10, 5, 30, 20), (-40, -100, -20, 60)],
        languages=["en", "fr"], min_level="low",
    )
    return kept.select("doc_id")


@query(
    "syslog_parse",
    """
    SELECT event_id, (user_id % 24)::INT AS FACILITY, (event_id % 8)::INT AS SEVERITY,
           upper(strftime(ts, '%b')) || ' ' || strftime(ts, '%d %H:%M:%S') AS TIMESTAMP, 'host' || user_id AS HOST,
           event_type AS TAG, 'props ' || props AS MESSAGE, false AS parse_error
    FROM events WHERE event_type <> 'error'
    UNION ALL
    SELECT event_id, NULL, NULL, NULL, NULL, NULL, NULL, true FROM events WHERE event_type = 'error'
    """,
)
def syslog_3164(spark, sf_dir):
    line = """concat(IF(event_type = 'error', '', concat('<', (user_id % 24) * 8 + event_id % 8, '>')),
              upper(date_format(ts, 'MMM')), ' ', date_format(ts, 'dd HH:mm:ss'), ' host', user_id, ' ',
              event_type, '[', event_id, ']: props ', props)"""
    lines = table(spark, sf_dir, "events").select("event_id", F.expr(line).alias("payload"))
    return wire.syslog_parse(lines, rfc="3164").drop("payload")


@query(
    "syslog_parse_5424",
    """
    SELECT event_id, (user_id % 24)::INT AS syslog_FACILITY, (event_id % 8)::INT AS syslog_SEVERITY,
           1 AS syslog_VERSION, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS syslog_TIMESTAMP,
           'host' || user_id AS syslog_HOST, event_type AS syslog_APP_NAME, event_id::VARCHAR AS syslog_PROCID,
           NULL::VARCHAR AS syslog_MSGID,
           CASE WHEN event_type = 'view' THEN '' ELSE '[a k="' || user_id || '"][b]' END AS syslog_SD,
           props AS syslog_MESSAGE, false AS parse_error
    FROM events WHERE event_type <> 'error'
    UNION ALL
    SELECT event_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true
    FROM events WHERE event_type = 'error'
    """,
)
def syslog_5424(spark, sf_dir):
    line = """concat(IF(event_type = 'error', '<>', concat('<', (user_id % 24) * 8 + event_id % 8, '>')), '1 ',
              date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '+00:00 host', user_id, ' ', event_type, ' ', event_id, ' - ',
              IF(event_type = 'view', '-', concat('[a k="', user_id, '"][b]')), ' ', props)"""
    lines = table(spark, sf_dir, "events").select("event_id", F.expr(line).alias("payload"))
    parsed = wire.syslog_parse(lines, rfc="5424").drop("payload")
    return parsed.withColumn("syslog_SD", F.array_join("syslog_SD", ""))


@query(
    "frame_split",
    """
    WITH cut AS (
      SELECT doc_id, 'LF' AS encoding, unnest(string_split(text, chr(10))) AS payload FROM documents
      UNION ALL
      SELECT doc_id, 'CRLF', unnest(string_split(text, chr(10))) FROM documents
      UNION ALL
      SELECT doc_id, 'NULL', text FROM documents
      UNION ALL
      SELECT doc_id, 'STXETX', unnest(string_split(text, chr(10))) FROM documents
      UNION ALL
      SELECT doc_id, 'RAW', text FROM documents)
    SELECT *, CASE WHEN strlen(payload) > 2048 THEN 'record too long' END AS record_error FROM cut
    """,
)
def frames(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    framed = {
        "LF": "concat(text, '\n')",
        "CRLF": "concat(replace(text, '\n', '\r\n'), '\r\n')",
        "NULL": "concat(text, '\\0')",
        "STXETX": "concat('\\u0002', replace(text, '\n', '\\u0003\\u0002'), '\\u0003')",
        "RAW": "text",
    }
    cut = None
    for encoding, blob in framed.items():
        captured = docs.select("doc_id", F.expr(f"encode({blob}, 'UTF-8')").alias("payload"))
        part = wire.frame_split(captured, encoding).withColumn("encoding", F.lit(encoding))
        cut = part if cut is None else cut.unionByName(part)
    return cut.withColumn("payload", F.col("payload").cast("string"))


@query(
    "frame_split_bytes",
    """
    SELECT event_id, hex(payload) AS payload_hex FROM (
      SELECT event_id, unnest([unhex('FFFE' || lpad(to_hex(event_id % 200 + 32), 2, '0')), encode(props), unhex('80')]) AS payload
      FROM events)
    """,
)
def byte_frames(spark, sf_dir):
    blob = "concat(unhex('FFFE'), unhex(lpad(hex(event_id % 200 + 32), 2, '0')), X'0A', encode(props, 'UTF-8'), X'0A800A')"
    captured = table(spark, sf_dir, "events").select("event_id", F.expr(blob).alias("payload"))
    return wire.frame_split(captured, "LF").select("event_id", F.hex("payload").alias("payload_hex"))


@query(
    "frame_split_lengths",
    """
    SELECT event_id, width, unnest([1, 2, 3]) AS frame_no, unnest([event_type, '', props]) AS payload
    FROM events, (SELECT unnest(['L1', 'L2', 'L4']) AS width)
    """,
)
def length_frames(spark, sf_dir):
    cut = None
    for width, digits in (("L1", 2), ("L2", 4), ("L4", 8)):
        def framed(text):
            return f"unhex(lpad(hex(octet_length({text})), {digits}, '0')), encode({text}, 'UTF-8')"

        blob = f"concat({framed('event_type')}, {framed(chr(39) * 2)}, {framed('props')})"
        captured = table(spark, sf_dir, "events").select("event_id", F.expr(blob).alias("payload"))
        part = wire.frame_split(captured, width).select(
            "event_id", F.lit(width).alias("width"), "frame_no", F.col("payload").cast("string").alias("payload")
        )
        cut = part if cut is None else cut.unionByName(part)
    return cut


@query(
    "json_document_rows",
    """
    SELECT c_custkey::VARCHAR AS key, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' AS payload,
           'application/json' AS content_type
    FROM customer
    UNION ALL
    SELECT 'nation ' || c_nationkey || ' page ' || page, '[' || string_agg('{"c_custkey":' || c_custkey || ',"c_name":"'
             || c_name || '"}', ',' ORDER BY c_custkey) || ']', 'application/json'
    FROM (SELECT *, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 20 AS page FROM customer)
    GROUP BY c_nationkey, page
    """,
)
def json_rows(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    kind = F.col("headers")["contentType"].alias("content_type")
    single = tables.document_rows(customers, ["c_custkey", "c_name"]).select(
        F.get_json_object("payload", "$.c_custkey").alias("key"), "payload", kind
    )
    lists = tables.document_rows(
        customers, ["c_custkey", "c_name"], group_by=["c_nationkey"], order_by=["c_custkey"], list_rows=20
    ).select(F.concat(F.lit("nation "), "c_nationkey", F.lit(" page "), "part").alias("key"), "payload", kind)
    return single.unionByName(lists)



#: Sizes of captured chunks, over and over, and where they begin.
CHUNKS = (7, 50, 23, 11, 38, 9)


def captured_chunks(spark, sf_dir, before: str, after: str):
    """The events of each user as one byte stream of records, cut anywhere: ``user_id``, ``chunk_no``, ``payload``."""
    record = F.concat(F.expr(before), F.encode("props", "UTF-8"), F.expr(after))
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", record.alias("record"))
    rows = rows.withColumn("size", F.octet_length("record"))
    placed = running_totals(rows, ["user_id"], ["ts", "event_id"], {"at": "size"})
    borders = [sum(CHUNKS[:k]) for k in range(len(CHUNKS) + 1)]
    whole = borders[-1]

    def chunk_of(place):
        inner = place % whole
        index = F.lit(0)
        for k, border in enumerate(borders[:-1]):
            index = F.when(inner >= border, k).otherwise(index)
        return (F.floor(place / whole) * len(CHUNKS) + index).cast("bigint")

    begins = F.floor(F.col("chunk_no") / len(CHUNKS)) * whole + F.element_at(F.array(*map(F.lit, borders)), (F.col("chunk_no") % len(CHUNKS) + 1).cast("int"))
    ends = begins + F.element_at(F.array(*map(F.lit, CHUNKS)), (F.col("chunk_no") % len(CHUNKS) + 1).cast("int"))
    parts = placed.withColumn("chunk_no", F.explode(F.sequence(chunk_of(F.col("at")), chunk_of(F.col("at") + F.col("size") - 1))))
    low, high = F.greatest(F.col("at"), begins), F.least(F.col("at") + F.col("size"), ends)
    piece = F.substring("record", (low - F.col("at") + 1).cast("int"), (high - low).cast("int"))
    parts = parts.select("user_id", "chunk_no", low.alias("low"), F.hex(piece).alias("piece"))
    pieces = F.sort_array(F.collect_list(F.struct("low", "piece")))
    text = F.array_join(F.transform(pieces, lambda one: one["piece"]), "")
    return parts.groupBy("user_id", "chunk_no").agg(F.unhex(text).alias("payload"))


@query(
    "frame_split_stream",
    """
    SELECT user_id, encoding, CAST(coalesce(sum(strlen(props) + extra) OVER (PARTITION BY user_id, encoding ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS record_at, props AS payload, NULL::VARCHAR AS record_error
    FROM events, (VALUES ('LF', 1), ('STXETX', 2), ('L2', 2)) AS encodings(encoding, extra)
    """,
)
def frames_over_chunks(spark, sf_dir):
    """Records that run over captured chunks of 7 to 50 bytes, several connections, three framings."""
    length = "substring(unhex(lpad(hex(octet_length(props)), 4, '0')), 1, 2)"
    framings = {"LF": ("X''", "X'0A'"), "STXETX": ("X'02'", "X'03'"), "L2": (length, "X''")}
    parts = [
        wire.frame_split_stream(captured_chunks(spark, sf_dir, *marks), encoding, ["user_id"], ["chunk_no"]).withColumn("encoding", F.lit(encoding))
        for encoding, marks in framings.items()
    ]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.select("user_id", "encoding", "record_at", F.col("payload").cast("string").alias("payload"), "record_error")


CAPPED = """
    WITH listed AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS r FROM events
                    WHERE event_type IN ('click', 'purchase', 'signup', 'view')),
    placed AS (
      SELECT 'fair' AS reading, event_type, event_id, row_number() OVER (ORDER BY r, event_type) AS place FROM listed
      UNION ALL
      SELECT 'one by one', event_type, event_id, row_number() OVER (ORDER BY event_type, r) FROM listed
    )
    SELECT reading, (place - 1) // {cap} AS poll, event_type, event_id FROM placed WHERE place <= 2 * {cap}
"""


@query("multi_source_capped", CAPPED.format(cap=250))
def capped_sources(spark, sf_dir):
    """Two polls of 250 rows over four sources, in turn and one by one; the second goes on where the first stopped."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "ts")
    polls = []
    for reading, fair in (("fair", True), ("one by one", False)):
        left, start = events, 0
        for poll in (0, 1):
            taken, start = files.capped_poll(
                left, ["click", "purchase", "signup", "view"], 250, ["ts", "event_id"], source="event_type", fair=fair, start=start
            )
            left = left.join(taken.select("event_id"), "event_id", "left_anti")
            polls.append(taken.select(F.lit(reading).alias("reading"), F.lit(poll).cast("bigint").alias("poll"), "event_type", "event_id"))
    every = polls[0]
    for one in polls[1:]:
        every = every.unionByName(one)
    return every


TRACKED = """
    WITH words AS (
      SELECT word FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS word FROM documents)
      GROUP BY word ORDER BY count(*), word LIMIT 10000
    ), posts AS (SELECT doc_id, lower(text) AS low, (doc_id * 37 % 180) - 90 AS lat, (doc_id * 101 % 360) - 180 AS lon FROM documents),
    boxes AS (SELECT (k * 7 % 170) - 85 AS south, (k * 11 % 340) - 170 AS west, k % 4 AS tall, k % 9 AS wide FROM range(300) t(k))
    SELECT doc_id FROM posts
    WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT unnest(regexp_extract_all(low, '[\\p{L}\\p{N}_]+')) AS w) JOIN words ON word = w)
       OR EXISTS (SELECT 1 FROM boxes WHERE lat BETWEEN south AND south + tall AND lon BETWEEN west AND west + wide)
"""


@query("stream_filter_many", TRACKED)
def posts_by_many(spark, sf_dir):
    """The 10,000 rarest words of six letters or more as keywords, and 300 boxes."""
    docs = table(spark, sf_dir, "documents")
    found = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), F.lit(0))).alias("word"))
    rare = found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "word").limit(10_000)
    track = [row["word"] for row in rare.collect()]
    boxes = [((k * 7 % 170) - 85, (k * 11 % 340) - 170, (k * 7 % 170) - 85 + k % 4, (k * 11 % 340) - 170 + k % 9) for k in range(300)]
    posts = docs.selectExpr("doc_id", "text", "doc_id * 37 % 180 - 90 AS lat", "doc_id * 101 % 360 - 180 AS lon")
    return feeds.stream_filter_many(posts, track=track, boxes=boxes).select("doc_id")
