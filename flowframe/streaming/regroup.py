"""The aggregator on a stream, in Spark's state store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowframe.functions.columns import as_col


def keyed_aggregate(
    df: DataFrame,
    key: str | Column,
    order_by: list[str],
    *,
    payload: str | Column = "payload",
    size: str | Column | None = None,
    count: int | None = None,
    closes: str | Column | None = None,
    idle_seconds: float | None = None,
    time: str | None = None,
    until: Callable[[object, str], tuple[object, bool]] | None = None,
    list_rows: int | None = None,
) -> DataFrame:
    """Groups of a streaming frame as (key, group_start, n, reason, payloads), held in the state store.

    Rows of a key are taken in ``order_by`` within a micro-batch, which a task holds
    for one key at a time: cap the batch at the source. ``size`` is the number of
    messages that each message announces for its group; one that announces another
    number than the message before begins a new group. ``until`` is a
    rule over the whole open group, carried from message to message: it gets what
    it gave before (None for a new group) and the payload, and gives a small value
    to carry on and whether to release. With ``idle_seconds`` the frame needs a watermark on ``time``: an event-time timer
    releases a group that got no further message, as reason ``timeout``. Where
    no ``count`` bounds a group, ``list_rows`` is required: groups come out in pieces
    of that many messages, all but the last as reason ``part``, so neither state nor
    memory grows with a group. ``group_start`` is the place of a group's first message
    among its key's, and ``n`` the messages of the group up to a piece's end: on the last
    piece it is the whole group's. A group that has no other piece than parts is still
    open; ``whole_groups`` leaves it out and puts the others together. Rows that arrive behind
    the watermark are dropped by Spark: choose its delay by the latest ones to come.
    """
    if size is None and count is None and closes is None and idle_seconds is None and until is None:
        raise ValueError("give a release rule: size, count, closes, until or idle_seconds")
    if idle_seconds is not None and time is None:
        raise ValueError("an idle time needs the time column it is measured on")
    if size is None and count is None and list_rows is None:
        raise ValueError("say how many messages a piece of a group may hold")
    at = F.unix_micros(F.col(time).cast("timestamp")) if time is not None else F.lit(0).cast("bigint")
    # Spark allows one watermarked column, so the time is ordered by as a number.
    order = [at if name == time else F.col(name) for name in order_by]
    rows = df.select(
        as_col(key).cast("string").alias("key"),
        *[column.alias(f"order{i}") for i, column in enumerate(order)],
        F.coalesce(as_col(closes), F.lit(False)).alias("closes") if closes is not None else F.lit(False).alias("closes"),
        *([F.col(time).alias("event_time")] if idle_seconds is not None else []),
        at.alias("at"),
        (F.lit(None) if size is None else as_col(size)).cast("bigint").alias("size"),
        as_col(payload).cast("string").alias("payload"),
    )
    processor = _processor(count, None if idle_seconds is None else int(idle_seconds * 1_000_000), until, list_rows)
    out = T.StructType(
        [
            T.StructField("key", T.StringType()),
            T.StructField("group_start", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("reason", T.StringType()),
            T.StructField("payloads", T.ArrayType(T.StringType())),
        ]
    )
    return rows.groupBy("key").transformWithState(
        statefulProcessor=processor,
        outputStructType=out,
        outputMode="append",
        timeMode="none" if idle_seconds is None else "eventTime",
    )


def whole_groups(pieces: DataFrame) -> DataFrame:
    """Stored pieces of ``keyed_aggregate`` as one row for each group that was released, of any length."""
    every = F.sort_array(F.collect_list(F.struct("n", "payloads")))
    groups = pieces.groupBy("key", "group_start").agg(
        F.max("n").alias("n"),
        F.max_by("reason", "n").alias("reason"),
        F.flatten(F.transform(every, lambda one: one["payloads"])).alias("payloads"),
    )
    return groups.filter("reason <> 'part'")


def _processor(count: int | None, idle: int | None, until, list_rows: int | None):
    import pickle

    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor

    def in_order(row):
        """By the order columns, what has no value last."""
        values = [value for name, value in row.asDict().items() if name.startswith("order")]
        return [(True, None) if value is None or value != value else (False, value) for value in values]

    class Groups(StatefulProcessor):
        """Open payloads per key, and one value beside them: each call of the state store costs more than a message."""

        def init(self, handle):
            self.handle = handle
            self.open = handle.getListState("open", "payload string")
            # Where the open group starts, how long it is, how many of its payloads are held, the time of the
            # last message, what the rule carries on, and the announced size.
            self.rest = handle.getValueState("rest", "start bigint, total bigint, held bigint, at bigint, carried binary, size bigint")

        def handleInputRows(self, key, rows, timerValues):
            start, total, before, last, carried, announced = self.rest.get() or (1, 0, 0, None, None, None)
            held = [row[0] for row in self.open.get()] if before else []
            carried = None if carried is None else pickle.loads(carried)
            done = []
            messages = sorted((in_order(row), place, row["at"], row["size"], row["closes"], row["payload"]) for place, row in enumerate(rows))
            for _, _, at, size, closing, payload in messages:
                if size != announced:
                    # What is left of a group that never was complete stays behind, as in a batch.
                    held, announced = [], size
                    start, total = start + total, 0
                if idle is not None and held and last is not None and at is not None and at - last > idle:
                    done.append((start, total, "timeout", held))
                    held, carried, start, total = [], None, start + total, 0
                if list_rows is not None and len(held) >= list_rows:
                    done.append((start, total, "part", held))
                    held = []
                held.append(payload)
                total += 1
                last, full = at, False
                if until is not None:
                    carried, full = until(carried, payload)
                if closing or full:
                    done.append((start, total, "closed", held))
                    held, carried, start, total = [], None, start + total, 0
                elif total == (size if size is not None else count):
                    done.append((start, total, "count", held))
                    held, carried, start, total = [], None, start + total, 0
            if held:
                self.open.put([(one,) for one in held])
            elif before:
                self.open.clear()
            self.rest.update((start, total, len(held), last, None if carried is None else pickle.dumps(carried), announced))
            if idle is not None:
                for due in self.handle.listTimers():
                    self.handle.deleteTimer(due)
                if held:
                    # Timers are in whole milliseconds; fire after the idle time, not at it.
                    self.handle.registerTimer((last + idle) // 1000 + 1)
            yield from self._rows(key, done)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            start, total, before, last, _, announced = self.rest.get()
            held = [row[0] for row in self.open.get()] if before else []
            self.open.clear()
            if held:
                self.rest.update((start + total, 0, 0, last, None, announced))
                yield from self._rows(key, [(start, total, "timeout", held)])

        def _rows(self, key, done):
            return [Row(key=key[0], group_start=start, n=total, reason=reason, payloads=held) for start, total, reason, held in done]

        def close(self):
            pass

    return Groups()
