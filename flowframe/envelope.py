"""The message shape: a payload, a header map, and the dataset's own columns.

The read-only message id and time are columns, not headers, so removing headers
never touches them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.functions.columns import as_col, headers_of


def to_messages(
    df: DataFrame,
    payload: str | Column,
    *,
    headers: dict[str, str | Column] | None = None,
    msg_id: str | Column | None = None,
    msg_ts: str | Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Project any frame to messages; ``keep`` names columns to carry along."""
    columns = [F.col(name) for name in keep or []]
    if msg_id is not None:
        columns.append(as_col(msg_id).alias("msg_id"))
    if msg_ts is not None:
        columns.append(as_col(msg_ts).alias("msg_ts"))
    columns.append(as_col(payload).alias("payload"))
    columns.append(headers_of(headers or {}).alias("headers"))
    return df.select(*columns)
