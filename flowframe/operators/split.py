"""One message in, one message per part out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.functions.columns import as_col, strip, text_of


def split_expression(
    df: DataFrame, parts: str | Column, *, correlate: str | Column | None = None
) -> DataFrame:
    """One row per element of an array expression, as the new payload.

    With ``correlate`` each row also says where it belongs: ``correlation_id``,
    the 1-based ``sequence_number`` and the ``sequence_size``, so the parts can
    be put together again.
    """
    kept = [name for name in df.columns if name != "payload"]
    rows = df.select(*kept, as_col(parts).alias("__parts"))
    place = []
    if correlate is not None:
        # The size is taken before the array is spread, so that rows do not carry it along.
        rows = df.select(*kept, as_col(correlate).alias("correlation_id"), as_col(parts).alias("__parts"))
        rows = rows.withColumn("sequence_size", F.size("__parts"))
        place = ["correlation_id", (F.col("__pos") + 1).alias("sequence_number"), "sequence_size"]
    # The outer form keeps Spark from testing the array beforehand, which would
    # make it twice; rows of empty arrays go afterwards.
    named = [*kept, *(["correlation_id", "sequence_size"] if place else [])]
    spread = rows.select(*named, F.posexplode_outer("__parts").alias("__pos", "payload"))
    return spread.filter(F.col("__pos").isNotNull()).select(*kept, "payload", *place)


def split_delimiters(df: DataFrame, delimiters: str, *, correlate: str | Column | None = None) -> DataFrame:
    """Cut a text payload at any of the delimiter characters; trim, drop empties."""
    any_of = "[" + "".join("\\" + c if c in "\\]^-&[" else c for c in delimiters) + "]"
    tokens = F.transform(F.split("payload", any_of), strip)
    return split_expression(df, F.filter(tokens, lambda token: token != ""), correlate=correlate)


def split_items(df: DataFrame, *, correlate: str | Column | None = None) -> DataFrame:
    """One row per element of an array payload; any other payload passes as it is."""
    is_list = dict(df.dtypes)["payload"].startswith("array")
    return split_expression(df, F.col("payload") if is_list else F.array("payload"), correlate=correlate)


def lines_of(text: Column) -> Column:
    """The lines of a text; a final line break opens no further line.

    Plain replacing and cutting at one character take a fraction of the time of
    an expression for the three kinds of line break.
    """
    even = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    ended = F.when(even.endswith("\n"), F.substring(even, F.lit(1), F.length(even) - 1)).otherwise(even)
    return F.split(ended, "\n")


def split_file_content(
    df: DataFrame,
    *,
    charset: str | None = None,
    markers: bool = False,
    path: str | Column = "path",
    correlate: str | Column | None = None,
) -> DataFrame:
    """The lines of a file payload, optionally between START and END markers.

    Markers are JSON text with the path, and for END the number of lines.
    """
    rows = df
    if dict(df.dtypes)["payload"] == "binary":
        rows = rows.withColumn("payload", text_of(F.col("payload"), charset or "UTF-8"))
    content = F.col("payload")
    lines = F.when(content == "", F.array().cast("array<string>")).otherwise(lines_of(content))
    if not markers:
        return split_expression(rows, lines, correlate=correlate)
    lines_and_marks = F.concat(
        F.array(marker_json(path, "START", F.lit(0))),
        F.col("__lines"),
        F.array(marker_json(path, "END", F.size("__lines"))),
    )
    return split_expression(rows.withColumn("__lines", lines), lines_and_marks, correlate=correlate).drop("__lines")


def marker_json(path: str | Column, mark: str, line_count: Column) -> Column:
    """A file marker as JSON text."""
    return F.to_json(
        F.struct(
            as_col(path).cast("string").alias("filePath"),
            F.lit(mark).alias("mark"),
            line_count.cast("bigint").alias("lineCount"),
        )
    )

