"""Task launch requests, and the ``key=value`` list they are written in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.functions.columns import HEADERS_TYPE, as_col, headers_of, strip, text_or_null
from flowframe.functions.settings import parse_kv_list


def kv_list_parse(text: str | Column) -> Column:
    """``a=v1,v2,b=o1`` as a map.

    A comma only ends a pair when the segment after it holds a ``=``; the first
    ``=`` splits; both sides are trimmed; the last of equal keys wins.
    """
    pairs = F.filter(F.split(as_col(text), ",(?=[^,]*=)"), lambda pair: pair.contains("="))

    def entry(pair):
        key = F.substring_index(pair, "=", 1)
        return F.struct(
            strip(key).alias("key"), strip(F.substring(pair, F.length(key) + 2, F.length(pair))).alias("value")
        )

    def last_of_each(entries):
        def is_last(one, i):
            return ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda other: other["key"] == one["key"])

        names = F.transform(entries, lambda one: one["key"])
        all_differ = F.size(F.array_distinct(names)) == F.size(entries)
        return F.when(all_differ, entries).otherwise(F.filter(entries, is_last))

    # Taking the entries through a one-element array computes them once per row.
    found = F.transform(F.array(F.transform(pairs, entry)), last_of_each)[0]
    empty = F.create_map().cast(HEADERS_TYPE)
    return F.when(F.coalesce(strip(as_col(text)), F.lit("")) == "", empty).otherwise(F.map_from_entries(found))


def task_request_build(
    df: DataFrame,
    *,
    name: str | None = None,
    name_expr: str | Column | None = None,
    args: list[str] | None = None,
    arg_exprs: dict[str, str | Column] | None = None,
    deployment: str | None = None,
) -> DataFrame:
    """Replace the payload by a JSON request ``{args, deploymentProps, name}``.

    Fixed arguments come first, then one ``key=value`` per expression in the
    order given. The name is fixed or computed and must not be blank.
    ``deployment`` is a ``key=value`` list, the same for all requests.
    """
    if name is not None and name_expr is not None:
        raise ValueError("give a fixed task name or a name expression, not both")
    if name is None and name_expr is None:
        raise ValueError("a task name is required")
    task_name = text_or_null(F.lit(name) if name is not None else as_col(name_expr).cast("string"))
    required = F.coalesce(task_name, F.raise_error(F.lit("a task name is required")).cast("string"))
    computed = [
        F.concat(F.lit(f"{key}="), F.coalesce(as_col(value).cast("string"), F.lit("null")))
        for key, value in (arg_exprs or {}).items()
    ]
    all_args = [F.lit(value) for value in args or []] + computed
    request = F.struct(
        (F.array(*all_args) if all_args else F.array().cast("array<string>")).alias("args"),
        headers_of({k: F.lit(v) for k, v in parse_kv_list(deployment or "").items()}).alias("deploymentProps"),
        required.alias("name"),
    )
    kept = F.map_filter("headers", lambda key, _: key != "contentType")
    json_type = F.create_map(F.lit("contentType"), F.lit("application/json"))
    return df.select(
        *[c for c in df.columns if c not in ("payload", "headers")],
        F.to_json(request).alias("payload"),
        F.map_concat(kept, json_type).alias("headers"),
    )
