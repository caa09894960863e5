"""Streams over files that Spark writes from the test tables, part by part."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowframe.operators import metrics
from flowframe.plans.scratch import scratch_path
from flowframe.sources.feeds import read_new, record_filter
from flowframe.streaming import flows
from flowframe.streaming.hot import read_regrouped, regroup_each
from flowframe.streaming.regroup import keyed_aggregate, whole_groups
from wiring.base import joined, query, table
from wiring.functions import AGAIN, TRIGGERED

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks_db(spark):
    """The state store that stateful processors need, for the time of a run."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS_DB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)


def deliver(spark, rows, consume):
    """Write the rows half a month at a time into one folder and let ``consume`` run after each.

    ``consume`` takes the folder's stream and a checkpoint; being started anew
    each time, it also shows that a stream goes on where it stopped.
    """
    path, checkpoint = scratch_path(spark, "event-stream"), scratch_path(spark, "checkpoint")
    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in rows.schema)
    half = F.concat(F.date_format("ts", "yyyy-MM"), F.when(F.dayofmonth("ts") <= 15, "-a").otherwise("-b"))
    for one in sorted(row["half"] for row in rows.select(half.alias("half")).distinct().collect()):
        rows.filter(half == one).write.mode("append").parquet(path)
        consume(flows.file_stream(spark, path, "parquet", schema=schema), checkpoint)
    return path


def events_of(spark, sf_dir):
    return table(spark, sf_dir, "events")


@query(
    "stream_metric_counter",
    """
    SELECT event_type AS name, user_id::VARCHAR AS tag_user, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS amount
    FROM events WHERE value <= 300 GROUP BY ALL
    """,
)
def stream_counter(spark, sf_dir):
    out = scratch_path(spark, "counters")

    def consume(stream, checkpoint):
        kept = record_filter(stream, "value > 300")
        counts = metrics.metric_counter(
            kept, "event_type", amount="CAST(value AS DECIMAL(18, 2))", tags={"user": "user_id"}
        )
        flows.run_available(counts, checkpoint, each=flows.changes_each(out), mode="update")

    deliver(spark, events_of(spark, sf_dir), consume)
    return flows.read_changes(spark, out, ["name", "tag_user"])


@query(
    "stream_first_seen",
    """
    SELECT user_id, event_type, event_id, ts, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1
    """,
)
def stream_first(spark, sf_dir):
    out, key = scratch_path(spark, "first-seen"), ["user_id", "event_type"]

    def consume(stream, checkpoint):
        rows = stream.select(*key, "event_id", "ts", "value")
        first = flows.first_by_key(rows, key, ["ts", "event_id"])
        flows.run_available(first, checkpoint, each=flows.changes_each(out), mode="update")

    deliver(spark, events_of(spark, sf_dir), consume)
    return flows.read_changes(spark, out, key)


@query(
    "stream_cdc_latest",
    """
    SELECT user_id, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1 AND event_type <> 'error'
    """,
)
def stream_latest(spark, sf_dir):
    out = scratch_path(spark, "latest")

    def consume(stream, checkpoint):
        latest = flows.latest_by_key(stream, ["user_id"], ["ts", "event_id"])
        flows.run_available(latest, checkpoint, each=flows.changes_each(out), mode="update")

    deliver(spark, events_of(spark, sf_dir), consume)
    latest = flows.read_changes(spark, out, ["user_id"])
    return latest.filter("event_type <> 'error'").select("user_id", "event_id", "event_type", "value")


@query(
    "stream_accept_once",
    """
    SELECT user_id, event_type, event_id FROM (
      SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS rn FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE rn = 1 OR event_type <> before
    """,
)
def stream_accept(spark, sf_dir):
    """A user's kind of event stands for a file's time: each change is a new version to accept."""
    out = scratch_path(spark, "accepted")

    def consume(stream, checkpoint):
        listing = stream.select("user_id", "event_type", "ts", "event_id")
        accepted = flows.accept_stream(listing, "user_id", "event_type", ["ts", "event_id"])
        flows.run_available(accepted.select("user_id", "event_type", "event_id"), checkpoint, path=out)

    with rocks_db(spark):
        deliver(spark, events_of(spark, sf_dir), consume)
    return spark.read.parquet(out)


GROUPS = "key STRING, group_start BIGINT, n BIGINT, reason STRING, payloads ARRAY<STRING>"


def regrouped(spark, rows, name, groups_of):
    """Run a stream of groups to its end and read what it released, the pieces of a group put together."""
    out = scratch_path(spark, name)
    with rocks_db(spark):
        deliver(spark, rows, lambda stream, checkpoint: flows.run_available(groups_of(stream), checkpoint, path=out))
    groups = whole_groups(spark.read.schema(GROUPS).parquet(out))
    return groups.select("key", "n", "reason", joined("payloads").alias("payloads"))


@query(
    "stream_aggregate_predicate",
    f"""
    SELECT user_id::VARCHAR AS "key", count(*) AS n, 'closed' AS reason, string_agg(event_id::VARCHAR, ',' ORDER BY rn) AS payloads
    FROM ({TRIGGERED}) GROUP BY user_id, grp
    HAVING sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) > 0
    """,
)
def stream_predicate(spark, sf_dir):
    return regrouped(spark, events_of(spark, sf_dir), "closed", lambda stream: keyed_aggregate(
        stream, "user_id", ["ts", "event_id"], payload="event_id", closes="event_type = 'purchase'", list_rows=1000
    ))


@query(
    "stream_aggregate_count",
    """
    WITH numbered AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS rn FROM events)
    SELECT event_type AS "key", count(*) AS n, 'count' AS reason, string_agg(event_id::VARCHAR, ',' ORDER BY rn) AS payloads
    FROM numbered GROUP BY event_type, rn // 20 HAVING count(*) = 20
    """,
)
def stream_count(spark, sf_dir):
    return regrouped(spark, events_of(spark, sf_dir), "counted", lambda stream: keyed_aggregate(
        stream, "event_type", ["ts", "event_id"], payload="event_id", count=20
    ))


@query(
    "stream_aggregate_sequence",
    f"""
    WITH told AS ({AGAIN}),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM told),
    marked AS (SELECT *, CASE WHEN size IS DISTINCT FROM lag(size) OVER (PARTITION BY user_id ORDER BY rn) THEN rn END AS start FROM numbered),
    placed AS (SELECT *, max(start) OVER (PARTITION BY user_id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS first FROM marked)
    SELECT user_id::VARCHAR AS "key", count(*) AS n, 'count' AS reason, string_agg(event_id::VARCHAR, ',' ORDER BY rn) AS payloads
    FROM placed GROUP BY user_id, first, (rn - first) // size HAVING count(*) = max(size)
    """,
)
def stream_sequence(spark, sf_dir):
    rn = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    told = events_of(spark, sf_dir).select("user_id", "event_id", "ts", (2 + F.floor((rn - 1) / 12) % 3).alias("size"))
    return regrouped(spark, told, "sequences", lambda stream: keyed_aggregate(
        stream, "user_id", ["ts", "event_id"], payload="event_id", size="size"
    ))


@query(
    "stream_group_timeout",
    """
    WITH brk AS (SELECT *, CASE WHEN ts > lag(ts) OVER w + INTERVAL 2 HOUR THEN 1 ELSE 0 END AS brk
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    segmented AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS seg FROM brk)
    SELECT user_id::VARCHAR AS "key", count(*) AS n, 'timeout' AS reason, string_agg(event_id::VARCHAR, ',' ORDER BY ts, event_id) AS payloads
    FROM segmented GROUP BY user_id, seg HAVING max(ts) + INTERVAL 2 HOUR < (SELECT max(ts) FROM events)
    """,
)
def stream_timeout(spark, sf_dir):
    """What idles at the end of the stream is released by its watermark; what may still go on is not."""
    return regrouped(spark, events_of(spark, sf_dir), "idle", lambda stream: keyed_aggregate(
        stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "0 seconds"), "user_id", ["ts", "event_id"], payload="event_id",
        idle_seconds=7200, time="ts", list_rows=1000,
    ))


@query("stream_incremental_read", "SELECT event_id, user_id, value FROM events")
def stream_read_new(spark, sf_dir):
    """A table that grows is polled after each part; the stored mark keeps a row from being read twice."""
    out, mark = scratch_path(spark, "read"), scratch_path(spark, "mark")
    place = F.row_number().over(Window.partitionBy("half").orderBy("ts", "event_id"))
    half = F.when(F.dayofmonth("ts") <= 15, 0).otherwise(1)
    rows = events_of(spark, sf_dir).withColumn("half", half)
    # Ids that rise with time, as a feed's do.
    rows = rows.withColumn("id", half.cast("bigint") * 1_000_000_000 + place).select("id", "event_id", "user_id", "value", "ts")
    grown = scratch_path(spark, "grown")
    for low in (0, 1_000_000_000):
        rows.filter((F.col("id") > low) & (F.col("id") <= low + 1_000_000_000)).write.mode("append").parquet(grown)
        for _ in range(2):
            read_new(spark.read.parquet(grown), mark, lambda new: new.write.mode("append").parquet(out))
    return spark.read.parquet(out).select("event_id", "user_id", "value")


@query(
    "stream_aggregate_hot",
    """
    WITH numbered AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn,
      coalesce(sum(CASE WHEN value > 400 THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS grp FROM events),
    counted AS (SELECT *, min(rn) OVER w AS group_start, count(*) OVER w AS n, max(CASE WHEN value > 400 THEN 1 ELSE 0 END) OVER w AS ended
      FROM numbered WINDOW w AS (PARTITION BY event_type, grp))
    SELECT event_type, group_start, rn AS position, n, event_id::VARCHAR AS payload FROM counted WHERE ended = 1
    """,
)
def stream_hot_keys(spark, sf_dir):
    """Five keys hold all messages; each batch of a key is spread over tasks."""
    out = scratch_path(spark, "hot")
    each = regroup_each(out, {"event_type": "event_type"}, ["ts", "event_id"], payload="CAST(event_id AS STRING)", closes="value > 400")

    def consume(stream, checkpoint):
        flows.run_available(stream, checkpoint, each=each)

    deliver(spark, events_of(spark, sf_dir), consume)
    return read_regrouped(spark, out, ["event_type"])
