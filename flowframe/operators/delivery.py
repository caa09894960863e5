"""Deliver records again after a failure, later each time, and give up in the end."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowframe.functions.columns import as_col
from flowframe.plans.spans import kept

Deliver = Callable[[], Callable[[pa.RecordBatch], list[str | None]]]


@dataclass(frozen=True)
class Backoff:
    """How often a record is tried, and how long it waits: ``first`` seconds, ``factor`` times as long each time, ``most`` at most."""

    attempts: int = 3
    first: float = 1.0
    most: float = 30.0
    factor: float = 2.0

    def __post_init__(self):
        if self.attempts < 1 or self.first < 0 or self.most < self.first or self.factor < 1:
            raise ValueError("give at least one attempt, and waits that do not shrink")

    def wait(self, attempt: int) -> float:
        """Seconds between the failure of an attempt (from 1) and the next one."""
        return min(self.first * self.factor ** (attempt - 1), self.most)


OUTCOMES = "attempt int, due timestamp, outcome string, error string"


def _tried(deliver: Deliver, names: list[str]):
    def attempt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        send = deliver()
        for batch in batches:
            errors = pa.array(send(batch), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, errors], names=[*names, "error"])

    return attempt


def delivery_retry(df: DataFrame, deliver: Deliver, at: str | Column, *, backoff: Backoff | None = None) -> DataFrame:
    """Every attempt at every record: the record, ``attempt`` from 1, ``due``, ``outcome`` and ``error``.

    ``deliver`` is called once per task and returns a function from a record batch (the
    record's columns, ``attempt`` and ``due``) to a list of error texts, None where a record
    went through. ``at`` is when a record is due first. One that failed is due again after
    its wait (``retry``), until its last attempt (``dead``: its row is the dead letter).
    Each round takes the failed records of the round before, and its result is stored, so no
    record is sent again because something later fails; a task that is tried again sends
    its batches again (at least once). Waits are told, not slept: a batch is a replay.
    """
    backoff = backoff or Backoff()
    columns = df.columns
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL("attempt int, due timestamp").fields])
    names = [field.name for field in schema]
    pending = df.withColumns({"attempt": F.lit(1), "due": as_col(at).cast("timestamp")})
    rounds = []
    for attempt in range(1, backoff.attempts + 1):
        done = pending.select(*names).mapInArrow(_tried(deliver, names), T.StructType([*schema.fields, T.StructField("error", T.StringType())]))
        last = attempt == backoff.attempts
        outcome = F.when(F.col("error").isNull(), "delivered").otherwise("dead" if last else "retry")
        done = kept(done.withColumn("outcome", outcome), f"attempt-{attempt}")
        rounds.append(done)
        failed = done.filter("outcome = 'retry'")
        if last or failed.isEmpty():
            break
        wait = F.make_dt_interval(secs=F.lit(backoff.wait(attempt)))
        pending = failed.select(*columns, F.lit(attempt + 1).alias("attempt"), (F.col("due") + wait).alias("due"))
    every = rounds[0]
    for one in rounds[1:]:
        every = every.unionByName(one)
    return every.select(*columns, "attempt", "due", "outcome", "error")


def delivery_stream(
    df: DataFrame, key: str | Column, payload: str | Column, deliver: Callable[[], Callable[[str, int], str | None]], *, backoff: Backoff | None = None
) -> DataFrame:
    """The same on a stream: failed records wait in Spark's state store for a timer in processing time.

    ``deliver`` returns a function of (payload, attempt) giving an error text or None. Gives
    ``key``, ``payload``, ``attempt``, ``outcome`` and ``error`` for every attempt; the rows
    with ``dead`` are the dead letters. Several records of one key wait each for itself.
    """
    from pyspark.sql.streaming import StatefulProcessor

    backoff = backoff or Backoff()
    rows = df.select(as_col(key).cast("string").alias("key"), as_col(payload).cast("string").alias("payload"))
    result = T.StructType.fromDDL("key string, payload string, attempt int, outcome string, error string")

    class Waiting(StatefulProcessor):
        """Records that failed, with the attempt and the time that come next."""

        def init(self, handle):
            self.handle = handle
            self.send = deliver()
            self.waiting = handle.getListState("waiting", "payload string, attempt int, due bigint")

        def _attempts(self, key, records, now):
            import pandas as pd

            out, failed = [], []
            for payload, attempt in records:
                error = self.send(payload, attempt)
                outcome = "delivered" if error is None else "dead" if attempt == backoff.attempts else "retry"
                out.append((key[0], payload, attempt, outcome, error))
                if outcome == "retry":
                    failed.append((payload, attempt + 1, now + int(backoff.wait(attempt) * 1000)))
            for due in {one[2] for one in failed}:
                self.handle.registerTimer(due)
            return pd.DataFrame(out, columns=[f.name for f in result]), failed

        def handleInputRows(self, key, rows, timerValues):
            now = timerValues.getCurrentProcessingTimeInMs()
            for part in rows:
                done, failed = self._attempts(key, [(text, 1) for text in part["payload"].tolist()], now)
                if failed:
                    self.waiting.appendList(failed)
                yield done

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            now = expiredTimerInfo.getExpiryTimeInMs()
            held = list(self.waiting.get())
            due = [(text, attempt) for text, attempt, at in held if at <= now]
            done, failed = self._attempts(key, due, timerValues.getCurrentProcessingTimeInMs())
            self.waiting.clear()
            left = [tuple(one) for one in held if one[2] > now] + failed
            if left:
                self.waiting.put(left)
            if len(done):
                yield done

        def close(self):
            pass

    return rows.groupBy("key").transformWithStateInPandas(
        statefulProcessor=Waiting(), outputStructType=result, outputMode="append", timeMode="processingTime"
    )
