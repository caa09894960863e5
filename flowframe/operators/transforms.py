"""Per-row transforms of payload and headers; none of them shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.functions.columns import HEADERS_TYPE, as_col, content_type_of, headers_of, is_text_like, text_of
from flowframe.functions.patterns import names_of, simple_pattern


def filter_rows(df: DataFrame, predicate: str | Column = "true", *, strict: bool = False) -> DataFrame:
    """Keep the rows for which the predicate is true.

    A null result drops the row; with ``strict`` it fails the job instead.
    """
    test = as_col(predicate)
    if strict:
        test = F.when(test.isNull(), F.raise_error(F.lit("predicate is null")).cast("boolean")).otherwise(test)
    return df.filter(test)


def transform_payload(df: DataFrame, expression: str | Column = "payload") -> DataFrame:
    """Replace the payload by the value of an expression; headers stay."""
    return df.withColumn("payload", as_col(expression))


def header_enrich(df: DataFrame, headers: dict[str, str | Column], *, overwrite: bool = False) -> DataFrame:
    """Add headers; one that exists already stays unless ``overwrite``. A null value adds nothing."""
    added = F.map_filter(headers_of(headers), lambda _, value: value.isNotNull())
    old = F.coalesce(F.col("headers"), F.create_map().cast(HEADERS_TYPE))
    if overwrite:
        fresh = F.map_keys(added)
        old = F.map_filter(old, lambda name, _: ~F.array_contains(fresh, name))
    else:
        present = F.map_keys(old)
        added = F.map_filter(added, lambda name, _: ~F.array_contains(present, name))
    return df.withColumn("headers", F.map_concat(old, added))


def header_remove(df: DataFrame, names: str | list[str] = "", *, delete_all: bool = False) -> DataFrame:
    """Remove named headers; a ``*`` in any name turns all of them into patterns.

    ``delete_all`` goes before the names.
    """
    if delete_all:
        return header_delete_all(df)
    wanted = names_of(names)
    if not wanted:
        return df
    if any("*" in name for name in wanted):
        pattern = "|".join(simple_pattern(name) for name in wanted)
        kept = F.map_filter("headers", lambda name, _: ~name.rlike(pattern))
    else:
        kept = F.map_filter("headers", lambda name, _: ~name.isin(*wanted))
    return df.withColumn("headers", kept)


def header_delete_all(df: DataFrame) -> DataFrame:
    """Empty the header map; id and time are columns and stay."""
    return df.withColumn("headers", F.create_map().cast(HEADERS_TYPE))


def bytes_to_text(
    df: DataFrame, *, charset: str = "UTF-8", markers: tuple[str, ...] = ("text", "json")
) -> DataFrame:
    """Add ``payload_text`` where the content type is text-like; the bytes stay.

    ``markers`` are the content-type parts that count as text.
    """
    text = text_of(F.col("payload"), charset)
    return df.withColumn("payload_text", F.when(is_text_like(markers=markers), text))


def json_to_map(df: DataFrame) -> DataFrame:
    """Add ``payload_map`` where the content type is JSON and the payload parses.

    Unreadable payloads keep a null map next to the untouched payload.
    """
    text = F.col("payload")
    if dict(df.dtypes)["payload"] == "binary":
        text = text_of(text)
    # In its permissive mode the parser gives null for what is no JSON object.
    return df.withColumn("payload_map", F.when(content_type_of().contains("json"), F.from_json(text, HEADERS_TYPE)))
