"""Record streams, change feeds, paged reads and content filters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.functions.columns import as_col
from flowframe.functions.patterns import full_match, quote, simple_pattern
from flowframe.plans.ordered import lists_of, number_groups
from flowframe.plans.scratch import path_exists


def kafka_stream(
    spark: SparkSession, servers: str, *, topics: list[str] | None = None, pattern: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Subscribe to topics, or to a topic pattern, which wins. Needs Spark's connector jar."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.options(**(options or {}))
    if pattern is not None:
        return reader.option("subscribePattern", pattern).load()
    return reader.option("subscribe", ",".join(topics or [])).load()


def record_stream_source(
    records: DataFrame,
    *,
    topics: list[str] | None = None,
    pattern: str | None = None,
    batch_rows: int | None = None,
    chunks: int | None = None,
) -> DataFrame:
    """Records of the chosen topics, one per row, or in batches per topic partition.

    Takes rows shaped like Spark's record source: key, value, topic, partition,
    offset. A pattern wins over a list. ``batch_rows`` is the size of a batch.
    """
    if pattern is None and not topics:
        raise ValueError("give topics or a topic pattern")
    chosen = F.col("topic").rlike(full_match(pattern)) if pattern is not None else F.col("topic").isin(*topics)
    rows = records.filter(chosen)
    if batch_rows is None:
        return rows
    home = ["topic", "partition"]
    lists = lists_of(
        rows.select(*home, "offset", "value"), home, ["offset"], F.col("value"), batch_rows,
        facts=[F.min("offset").alias("first_offset")], chunks=chunks,
    )
    return lists.withColumnsRenamed({"part": "batch", "items": "payload"})


def record_filter(df: DataFrame, discard: str | Column) -> DataFrame:
    """Drop the records for which the expression is true; null keeps them."""
    return df.filter(~F.coalesce(as_col(discard), F.lit(False)))


def clock_source(
    spark: SparkSession, *, date_format: str = "MM/dd/yy HH:mm:ss", rows_per_second: int = 1
) -> DataFrame:
    """A stream of the current time as text."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return format_time(ticks, "timestamp", date_format=date_format)


def format_time(df: DataFrame, time: str | Column, *, date_format: str = "MM/dd/yy HH:mm:ss") -> DataFrame:
    """Add the payload: a time as text."""
    return df.withColumn("payload", F.date_format(as_col(time), date_format))


def cdc_flatten(
    df: DataFrame,
    row_type: str,
    *,
    op: str = "op",
    before: str = "before",
    after: str = "after",
    metadata: dict[str, str | Column] | None = None,
) -> DataFrame:
    """Change events (JSON images before and after) as flat rows.

    A delete shows the image before. ``__deleted`` is the text true or false,
    ``__op`` the operation; ``metadata`` adds further columns such as ``__name``,
    ``__db`` and ``__table``.
    """
    image = F.when(F.col(op) == "d", F.col(before)).otherwise(F.col(after))
    rows = df.withColumn("__row", F.from_json(image, row_type))
    extra = [as_col(value).alias(name) for name, value in (metadata or {}).items()]
    return rows.select(
        "__row.*",
        F.when(F.col(op) == "d", "true").otherwise("false").alias("__deleted"),
        F.col(op).alias("__op"),
        *extra,
    )


def header_names(df: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    """Keep the headers whose name matches one of the patterns, by default all."""
    any_of = "|".join(simple_pattern(pattern) for pattern in patterns or ["*"])
    return df.withColumn("headers", F.map_filter("headers", lambda name, _: name.rlike(any_of)))


def cdc_latest(df: DataFrame, key: list[str], order_by: list[str], *, deleted: str | Column) -> DataFrame:
    """The current rows of a change feed: the last event per key, deletes left out.

    Each task keeps one event per key before the shuffle, so a key with very
    many changes costs no more than any other.
    """
    events = df.withColumn("__gone", as_col(deleted))
    rest = [name for name in df.columns if name not in key]
    last = events.groupBy(*key).agg(
        F.max_by(F.struct(*rest, "__gone"), F.struct(*order_by)).alias("__last")
    )
    kept = last.filter(~F.coalesce(F.col("__last.__gone"), F.lit(False)))
    return kept.select(*[F.col(name) if name in key else F.col(f"__last.{name}") for name in df.columns])


def without_tombstones(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Leave out delete events with an empty payload."""
    return df.filter(F.col(payload).isNotNull())


def incremental_read(
    df: DataFrame, since: int | None, *, id_column: str = "id", page_size: int | None = None, chunks: int | None = None
) -> DataFrame:
    """Everything above the stored mark; the filter reaches the scan.

    With ``page_size`` each row gets the ``page`` (newest first) that it falls on.
    The highest id read (``high_mark``) is the next run's mark.
    """
    rows = df if since is None else df.filter(F.col(id_column) > since)
    if page_size is None:
        return rows
    rows = rows.withColumn("__newest", -F.col(id_column))
    placed = number_groups(rows, [], ["__newest"], count=page_size, chunks=chunks)
    page = F.floor((F.col("position") - 1) / page_size).cast("bigint")
    return placed.withColumn("page", page).drop("__newest", "position", "group_start", "group_pos")


def read_new(
    df: DataFrame, mark_path: str, deliver: Callable[[DataFrame], None], *, id_column: str = "id"
) -> int | None:
    """One polling run: what lies above the mark kept at ``mark_path`` goes to ``deliver``, then the mark moves on.

    If ``deliver`` fails the mark stays, and the next run reads the same rows again.
    Gives the new mark; None while nothing was ever read.
    """
    spark = df.sparkSession
    marks = spark.read.parquet(mark_path) if path_exists(spark, mark_path) else None
    since = None if marks is None else high_mark(marks, "since").first()["since"]
    rows = incremental_read(df, since, id_column=id_column)
    top = high_mark(rows, id_column).first()["since"]
    if top is None:
        return since
    # Rows that come in meanwhile lie above the mark and wait for the next run.
    deliver(rows.filter(F.col(id_column) <= top))
    spark.range(1).select(F.lit(top).alias("since")).write.mode("append").parquet(mark_path)
    return top


def high_mark(df: DataFrame, id_column: str = "id") -> DataFrame:
    """The highest id, to be kept as the next run's ``since``."""
    return df.agg(F.max(id_column).alias("since"))


def first_seen_dedup(df: DataFrame, key: list[str], order_by: list[str]) -> DataFrame:
    """The first row per key in arrival order; combined per task before the shuffle."""
    rest = [name for name in df.columns if name not in key]
    first = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order_by)).alias("__first"))
    return first.select(*[F.col(name) if name in key else F.col(f"__first.{name}") for name in df.columns])


# The filter levels of a post stream, from least to most strict.
FILTER_LEVELS = ("none", "low", "medium")


def stream_filter(
    df: DataFrame,
    *,
    text: str | Column = "text",
    author: str | Column = "author_id",
    language: str | Column = "lang",
    position: tuple[str, str] = ("lat", "lon"),
    level: str | Column = "filter_level",
    follow: list[int] | None = None,
    track: list[str] | None = None,
    boxes: list[tuple[float, float, float, float]] | None = None,
    languages: list[str] | None = None,
    min_level: str | None = None,
) -> DataFrame:
    """Keep posts by author, keyword or place, and by language and filter level.

    A post passes if any of follow, track and boxes fits, or none is given. A
    track entry fits if all its words occur as whole words in any case. A box is
    (south-west lat, lon, north-east lat, lon). Language and level must fit too.
    """
    choices: list[Column] = []
    if follow:
        choices.append(as_col(author).isin(*follow))
    if track:
        low = F.lower(as_col(text))
        for phrase in track:
            fits = F.lit(True)
            for word in phrase.lower().split():
                # The plain search is quick and leaves few texts to the expression.
                whole = rf"(?<![\p{{L}}\p{{N}}_]){quote(word)}(?![\p{{L}}\p{{N}}_])"
                fits = fits & low.contains(word) & low.rlike(whole)
            choices.append(fits)
    if boxes:
        lat, lon = (as_col(axis) for axis in position)
        for south, west, north, east in boxes:
            choices.append(lat.between(south, north) & lon.between(west, east))
    return df.filter(_combined(choices, language, level, languages, min_level))


def _combined(choices: list[Column], language, level, languages: list[str] | None, min_level: str | None) -> Column:
    """Any of the choices if there are some, and language and filter level."""
    test = F.lit(True)
    if choices:
        test = choices[0]
        for choice in choices[1:]:
            test = test | choice
    if languages:
        test = test & as_col(language).isin(*languages)
    if min_level is not None:
        test = test & as_col(level).isin(*FILTER_LEVELS[FILTER_LEVELS.index(min_level):])
    return test


def stream_filter_many(
    df: DataFrame,
    *,
    text: str | Column = "text",
    author: str | Column = "author_id",
    language: str | Column = "lang",
    position: tuple[str, str] = ("lat", "lon"),
    level: str | Column = "filter_level",
    follow: list[int] | None = None,
    track: list[str] | None = None,
    boxes: list[tuple[float, float, float, float]] | None = None,
    languages: list[str] | None = None,
    min_level: str | None = None,
) -> DataFrame:
    """``stream_filter`` for very many authors, keywords and boxes: the same posts pass.

    The time per post does not follow the number of entries: one automaton over the words
    of all keywords reads a text once, and points are looked up in a grid of the boxes.
    Only the texts and the positions pass through Python, in Arrow batches; every task
    builds its index of the entries, which are part of the plan.
    """
    choices: list[Column] = []
    if follow:
        choices.append(as_col(author).isin(*follow))
    if track:

        @F.pandas_udf("boolean")
        def tracked(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            from flowframe.sources.matching import Phrases

            phrases = Phrases(track)
            for part in texts:
                yield part.map(phrases.fits).astype(bool)

        choices.append(tracked(F.lower(as_col(text))))
    if boxes:

        @F.pandas_udf("boolean")
        def placed(axes: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            from flowframe.sources.matching import Boxes

            grid = Boxes(boxes)
            for lat, lon in axes:
                yield pd.Series(grid.fit(lat.to_numpy(dtype=float, na_value=float("nan")), lon.to_numpy(dtype=float, na_value=float("nan"))))

        choices.append(placed(*(as_col(axis).cast("double") for axis in position)))
    return df.filter(_combined(choices, language, level, languages, min_level))
