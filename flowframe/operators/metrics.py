"""Counters and gauges by name and tags, and the metric line format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.functions.columns import as_col, strip, text_or_null

# The name of a blank metric, the value of a missing tag, and the
# longest key and value together that a metric backend takes without complaint.
EMPTY_NAME = "empty"
MISSING_TAG = "NA"
TAG_LENGTH = 254
TAG_KEY = "^[a-zA-Z0-9._-]+$"


def metric_name(name: str | Column) -> Column:
    """The metric's name; ``empty`` where it is blank or null."""
    return F.coalesce(text_or_null(as_col(name).cast("string")), F.lit(EMPTY_NAME))


def _is_list(df: DataFrame, expression: str | Column) -> bool:
    return df.select(as_col(expression).alias("v")).dtypes[0][1].startswith("array")


def _tag_value(expression: str | Column) -> Column:
    """A single tag value: ``NA`` for null; a blank one stays."""
    return F.coalesce(as_col(expression).cast("string"), F.lit(MISSING_TAG))


def _tag_values(expression: str | Column) -> Column:
    """A list of tag values without nulls and blanks; ``NA`` if none is left."""
    texts = F.filter(
        as_col(expression).cast("array<string>"), lambda one: F.coalesce(strip(one) != "", F.lit(False))
    )
    return F.when(F.size(texts) > 0, texts).otherwise(F.array(F.lit(MISSING_TAG)))


def metric_tags(
    df: DataFrame,
    *,
    fixed: dict[str, str] | None = None,
    tags: dict[str, str | Column] | None = None,
) -> DataFrame:
    """One row per metric update, with the map column ``tags``.

    The i-th update takes the i-th value of every tag expression; a list that
    has run out gives an empty text. Fixed tags go with every update unless
    blank; an expression tag wins over a fixed one of the same name.
    """
    tags = tags or {}
    steady = {
        key: value for key, value in (fixed or {}).items()
        if key.strip() and value and value.strip() and key not in tags
    }
    pairs = [F.lit(text) for item in steady.items() for text in item]
    lists = {key: _is_list(df, expression) for key, expression in tags.items()}
    if not any(lists.values()):
        # Single values make one update per message.
        for key, expression in tags.items():
            pairs += [F.lit(key), _tag_value(expression)]
        return df.withColumn("tags", (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,string>"))
    columns = {
        f"__tag{i}": _tag_values(expression) if lists[key] else F.array(_tag_value(expression))
        for i, (key, expression) in enumerate(tags.items())
    }
    rows = df.withColumns(columns).withColumn("__update", F.explode(F.arrays_zip(*columns)))
    for key, name in zip(tags, columns):
        pairs += [F.lit(key), F.coalesce(F.col("__update")[name], F.lit(""))]
    return rows.withColumn("tags", F.create_map(*pairs)).drop("__update", *columns)


def _updates(df, name, amount, fixed, tags, keep):
    """Metric updates as (name, one column per tag, amount): flat columns group well."""
    tagged = metric_tags(df, fixed=fixed, tags=tags)
    keys = sorted(
        {k for k, v in (fixed or {}).items() if k.strip() and v and v.strip()} | set(tags or {})
    )
    return keys, tagged.select(
        metric_name(name).alias("name"),
        *[F.col("tags")[key].alias(f"tag_{key}") for key in keys],
        as_col(amount).alias("amount"),
        *keep,
    )


def metric_counter(
    df: DataFrame,
    name: str | Column,
    *,
    amount: str | Column = "1.0D",
    fixed: dict[str, str] | None = None,
    tags: dict[str, str | Column] | None = None,
) -> DataFrame:
    """The sum of the amounts per name and tags, as ``name, tag_*, amount``.

    Every update of a message adds its full amount. Sums are combined before the
    shuffle, so a frequent metric costs one row per task.
    """
    keys, updates = _updates(df, name, amount, fixed, tags, [])
    return updates.groupBy("name", *[f"tag_{key}" for key in keys]).agg(
        F.sum("amount").cast("double").alias("amount")
    )


def metric_gauge(
    df: DataFrame,
    name: str | Column,
    order_by: list[str],
    *,
    amount: str | Column = "1.0D",
    fixed: dict[str, str] | None = None,
    tags: dict[str, str | Column] | None = None,
) -> DataFrame:
    """The last amount per name and tags, cut to a whole number, as ``value``."""
    latest = F.struct(*order_by).alias("__order")
    keys, updates = _updates(df, name, amount, fixed, tags, [latest])
    return updates.groupBy("name", *[f"tag_{key}" for key in keys]).agg(
        F.max_by("amount", "__order").cast("bigint").alias("value")
    )


def metric_line_format(
    df: DataFrame,
    name: str,
    value: str | Column,
    source: str,
    *,
    timestamp: str | Column | None = None,
    tags: dict[str, str | Column] | None = None,
) -> DataFrame:
    """Add ``line`` (``"name" value [timestamp] source=src k="v" ...``) and ``error``.

    Tags come in key order; a null tag is skipped. A null value or timestamp, or
    a tag key with other characters than letters, digits, ``.``, ``_`` and ``-``,
    gives an error and no line. ``warning`` names tags too long for a backend.
    """
    import re

    tags = dict(sorted((tags or {}).items()))
    bad_keys = [key for key in tags if not re.match(TAG_KEY, key)]
    number = as_col(value)
    is_number = df.select(number.alias("v")).dtypes[0][1] != "string"
    number = number.cast("string") if is_number else F.when(
        number.try_cast("double").isNotNull(), number
    )
    stamp = None if timestamp is None else as_col(timestamp).try_cast("bigint").cast("string")
    points = {key: as_col(tag).cast("string") for key, tag in tags.items()}
    line = F.concat_ws(
        " ",
        F.lit(f'"{name}"'),
        number,
        *([] if stamp is None else [stamp]),
        F.lit(f"source={source}"),
        *[F.concat(F.lit(f'{key}="'), tag, F.lit('"')) for key, tag in points.items()],
    )
    error = F.when(number.isNull(), F.lit("the metric value is not a number"))
    if stamp is not None:
        error = error.when(stamp.isNull(), F.lit("the timestamp is not a number"))
    if bad_keys:
        error = F.lit(f"invalid tag key: {', '.join(bad_keys)}")
    long_tags = [
        F.when(F.length(tag) + len(key) > TAG_LENGTH, F.lit(key)) for key, tag in points.items()
    ]
    warning = text_or_null(F.concat_ws(",", *long_tags)) if long_tags else F.lit(None).cast("string")
    return (
        df.withColumn("error", error)
        .withColumn("line", F.when(F.col("error").isNull(), F.trim(line)))
        .withColumn("warning", warning)
    )
