"""Enrich messages by one HTTP exchange each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowframe.functions.columns import as_col, headers_of


def http_requests(
    df: DataFrame,
    url: str | Column,
    *,
    method: str | Column = "'GET'",
    body: str | Column = "payload",
    headers: dict[str, str | Column] | None = None,
) -> DataFrame:
    """Add the request columns; headers with a null value are left out."""
    sent = F.map_filter(headers_of(headers or {}), lambda _, value: value.isNotNull())
    return (
        df.withColumn("request_url", as_col(url))
        .withColumn("request_method", F.upper(as_col(method)))
        .withColumn("request_headers", sent)
        .withColumn("request_body", as_col(body).cast("string"))
    )


def http_enrich(
    df: DataFrame,
    transport: Callable[[], Callable[[str, str, dict, str | None, float], dict]],
    url: str | Column,
    *,
    method: str | Column = "'GET'",
    body: str | Column = "payload",
    headers: dict[str, str | Column] | None = None,
    timeout: float = 30.0,
    reply: str | Column = "reply_body",
    in_flight: int = 1,
    errors: str = "fail",
) -> DataFrame:
    """Send each message and make ``reply`` the new payload.

    ``transport`` is called once per task and connection and returns the client, a function
    of (method, url, headers, body, timeout) giving ``status``, ``headers`` and ``body``.
    The reply expression may use ``reply_status``, ``reply_headers`` and ``reply_body``.
    Up to ``in_flight`` requests of a task wait for their replies at the same time; rows
    keep their order. A call that fails, or takes longer than ``timeout`` seconds, fails
    the task, or with ``errors="rows"`` gives a row with no reply and the reason in
    ``reply_error``. A retried task sends its requests again.
    """
    if errors not in ("fail", "rows"):
        raise ValueError(f"'{errors}' is neither fail nor rows")
    if in_flight < 1:
        raise ValueError("at least one request is in flight")
    asked = http_requests(df, url, method=method, body=body, headers=headers)
    answered = T.StructType(
        asked.schema.fields
        + [
            T.StructField("reply_status", T.IntegerType()),
            T.StructField("reply_headers", T.MapType(T.StringType(), T.StringType())),
            T.StructField("reply_body", T.StringType()),
            T.StructField("reply_error", T.StringType()),
        ]
    )

    def exchange(batches):
        return exchanged(batches, transport, timeout, in_flight, errors == "fail")

    sent = asked.mapInArrow(exchange, answered).withColumn("payload", as_col(reply))
    return sent.select(*df.columns, *(["reply_error"] if errors == "rows" else []))


def exchanged(batches, transport, timeout: float, in_flight: int, fail: bool):
    """The batches with their replies; a window of calls slides over the rows of all batches."""
    import threading
    import time
    from collections import deque
    from concurrent.futures import ThreadPoolExecutor
    from concurrent.futures import TimeoutError as Late

    import pyarrow as pa

    own = threading.local()
    added = {
        "reply_status": pa.int32(), "reply_headers": pa.map_(pa.string(), pa.string()), "reply_body": pa.string(), "reply_error": pa.string(),
    }

    def call(verb, to, named, text):
        if not hasattr(own, "send"):
            own.send = transport()
        return own.send(verb, to, dict(named or {}), text, timeout)

    waiting = deque()  # (answers of its batch, call, latest time of its reply)
    begun = deque()  # (batch, its answers so far)

    def settle():
        answers, one, due = waiting.popleft()
        try:
            answer = one.result(None if due is None else max(due - time.monotonic(), 0))
        except Exception as error:  # noqa: BLE001 - the reason becomes a value
            late = isinstance(error, Late) and not one.done()
            if fail:
                raise TimeoutError(f"no reply within {timeout} s") if late else error
            answer = {"error": f"no reply within {timeout} s" if late else f"{type(error).__name__}: {error}"}
        answers.append(answer)

    def finished(batch, answers):
        replies = [
            [answer.get("status") for answer in answers],
            [list((answer.get("headers") or {}).items()) for answer in answers],
            [answer.get("body") for answer in answers],
            [answer.get("error") for answer in answers],
        ]
        columns = [pa.array(values, kind) for values, kind in zip(replies, added.values(), strict=True)]
        return pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *added])

    pool = ThreadPoolExecutor(in_flight)
    try:
        for batch in batches:
            answers = []
            begun.append((batch, answers))
            for request in zip(*[batch.column(name).to_pylist() for name in ("request_method", "request_url", "request_headers", "request_body")], strict=True):
                if len(waiting) == in_flight:
                    settle()
                # A client that keeps to its timeout answers or fails before this one ends.
                waiting.append((answers, pool.submit(call, *request), time.monotonic() + timeout + 1))
            while begun and len(begun[0][1]) == begun[0][0].num_rows:
                yield finished(*begun.popleft())
        while waiting:
            settle()
        while begun:
            yield finished(*begun.popleft())
    finally:
        pool.shutdown(wait=False, cancel_futures=True)


def urllib_transport():
    """A plain client on the standard library, for ``http_enrich``."""
    import urllib.request

    def send(method, url, headers, body, timeout):
        data = body.encode() if body is not None and method not in ("GET", "HEAD") else None
        request = urllib.request.Request(url, data=data, headers=headers, method=method)
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return {
                "status": answer.status,
                "headers": dict(answer.headers.items()),
                "body": answer.read().decode(),
            }

    return send
