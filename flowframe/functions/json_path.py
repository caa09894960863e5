"""Recursive JSON search, the one path form Spark's JSON functions lack."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def json_find(payload: Column, field: str) -> Column:
    """Every value stored under ``field`` at any depth (``$..field``), as text.

    Null values keep their place as nulls; unreadable JSON gives a null array.
    Runs as an Arrow batch function, so only the payload column is shipped.
    """
    @F.pandas_udf("array<string>")
    def search(texts: pd.Series) -> pd.Series:
        import json

        def as_text(value):
            if value is None or isinstance(value, str):
                return value
            return json.dumps(value, separators=(",", ":"), ensure_ascii=False)

        def values(text):
            if text is None:
                return None
            try:
                pending = [json.loads(text)]
            except ValueError:
                return None
            found = []
            while pending:
                node = pending.pop()
                if isinstance(node, dict):
                    if field in node:
                        found.append(as_text(node[field]))
                    pending.extend(reversed(list(node.values())))
                elif isinstance(node, list):
                    pending.extend(reversed(node))
            return found

        return texts.map(values)

    return search(payload)
