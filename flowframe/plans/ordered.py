"""Number rows, and the groups they fall into, in a per-key order.

A key, or a frame without keys, may hold any share of the rows, so the rows are
cut into chunks by ranges of (key, order). The borders between the chunks are
rows picked by a hash, so they come out the same whenever Spark computes them,
and everything stays one lazy plan. Within a chunk the rows of a key are
numbered by a window. What crosses a border (the number of rows before, the last
time, the last group start) is carried over from one small row per chunk; only a
border row's own key can lie in two chunks, so there are at most twice as many
such rows as borders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.functions.columns import as_col

#: One row in so many may become a border.
BORDER_SAMPLE = 64


def _borders(df: DataFrame, place: Column, chunks: int, keys: list[str]) -> DataFrame:
    """At most ``chunks`` places, picked by a hash of the place, as one list in order for each key (named ``__k0``, ...)."""
    code = F.xxhash64(place)
    picked = (
        df.select(place.alias("place"), code.alias("code"))
        .filter(F.pmod(F.xxhash64("code"), F.lit(BORDER_SAMPLE)) == 0)
        .groupBy(F.pmod("code", F.lit(chunks)).alias("bucket"))
        .agg(F.min_by("place", "code").alias("place"))
    )
    names = [name for name in picked.schema["place"].dataType.names if name not in keys]
    listed = picked.select(*[F.col(f"place.{k}").alias(f"__{k}") for k in keys], F.struct(*[F.col(f"place.{n}").alias(n) for n in names]).alias("own"))
    return listed.groupBy(*[f"__{k}" for k in keys] or [F.lit(0).alias("one")]).agg(F.array_sort(F.collect_list("own")).alias("__borders")).select(
        *[f"__{k}" for k in keys], "__borders"
    )


def _borders_before(chunks: int) -> Column:
    """How many of its key's borders lie at or before a row: halving, so as many steps as the number has bits."""
    count = F.size("__borders")

    def further(at: Column, step: Column) -> Column:
        reached = at + step
        return F.when((reached <= count) & (F.get("__borders", reached - 1) <= F.col("__place")), reached).otherwise(at)

    steps = F.array(*[F.lit(1 << bit) for bit in range(chunks.bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), further)


def _all(tests: list[Column]) -> Column:
    out = F.lit(True)
    for test in tests:
        out = out & test
    return out


def _placed(rows: DataFrame, df: DataFrame, keys: list[str], order_by: list[str], chunks: int) -> DataFrame:
    """The rows with their ``__chunk`` among those of their key, and whether their key is that of a border (``__edge``)."""
    place = F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), *(F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)))
    own = F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)))
    rows = rows.withColumn("__place", own)
    if not keys:
        # All rows are of one key. Its borders are a bounded list: Spark computes it once and takes it as a constant.
        rows = rows.withColumn("__borders", _borders(df, place, chunks, []).scalar())
    else:
        # At most as many rows as chunks; most rows are of a key without a border, and done with the look-up.
        borders = F.broadcast(_borders(df, place, chunks, [f"k{i}" for i in range(len(keys))]))
        same = _all([F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
        rows = rows.join(borders, same, "left").drop(*(f"__k{i}" for i in range(len(keys))))
    chunk = F.when(F.col("__borders").isNull(), 0).otherwise(_borders_before(chunks))
    return rows.withColumns({"__chunk": chunk, "__edge": F.col("__borders").isNotNull()}).drop("__place", "__borders")


def running_totals(
    df: DataFrame, keys: list[str], order_by: list[str], totals: dict[str, str | Column], *, chunks: int | None = None
) -> DataFrame:
    """Add per key the sum over the rows before each row, by name; a key may have any number of rows.

    ``order_by`` must be a total order within a key. Works as ``number_groups`` does:
    windows within chunks, and what lies before a chunk from one small row per chunk.
    """
    chunks = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumns({f"__add_{name}": as_col(value).cast("bigint") for name, value in totals.items()})
    rows = _placed(rows, df, keys, order_by, chunks)
    part = ["__chunk", *keys]
    before = Window.partitionBy(*part).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.filter("__edge").groupBy(*part).agg(*[F.sum(f"__add_{name}").alias(f"__sum_{name}") for name in totals])
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = carry.select(
        *[F.col(name).alias(f"__at_{name}") for name in part], *[F.sum(f"__sum_{name}").over(earlier).alias(f"__sum_{name}") for name in totals]
    )
    same = _all([F.col(name).eqNullSafe(F.col(f"__at_{name}")) for name in part])
    inner = rows.withColumns({f"__in_{name}": F.sum(f"__add_{name}").over(before) for name in totals})
    # At most twice as many rows as chunks, as in number_groups.
    joined = inner.join(F.broadcast(carry), same, "left")
    zero = F.lit(0).cast("bigint")
    made = {name: F.coalesce(f"__sum_{name}", zero) + F.coalesce(f"__in_{name}", zero) for name in totals}
    return joined.withColumns(made).select(*df.columns, *totals)


def number_groups(
    df: DataFrame,
    keys: list[str],
    order_by: list[str],
    *,
    count: int | str | Column | None = None,
    closes: str | Column | None = None,
    gap: str | Column | None = None,
    time: str | None = None,
    runs: str | Column | None = None,
    chunks: int | None = None,
    tell_closed: bool = True,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add ``position``, ``group_start``, ``group_pos`` (and ``closed``) per key.

    A group ends after ``count`` rows, after a row for which ``closes`` is true,
    before a row whose ``time`` lies more than ``gap`` after the row before (an
    interval as text, or one computed from the row before), and where the value of
    ``runs`` changes. ``group_start`` is the position of a group's first row and
    names the group; ``closed`` tells whether a closing row ends the group, unless
    ``tell_closed`` is false, as where groups are summed up and it can be seen there.
    ``order_by`` must be a total order within a key, ``keys`` may be empty. There are
    as many chunks as the session has shuffle partitions, unless ``chunks`` says
    otherwise. The frame is read once for the borders, once for what crosses them,
    and once for the rows: write one first that is costly to make. ``then`` is
    applied to the numbered rows.
    """
    if gap is not None and time is None:
        raise ValueError("a gap needs the time column it is measured on")
    chunks = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df
    watched: dict[str, Column] = {}
    if closes is not None:
        watched["closes"] = F.coalesce(as_col(closes), F.lit(False))
    if gap is not None:
        watched["time"] = F.col(time)
        watched["due"] = F.col(time) + (F.expr(f"interval {gap}") if isinstance(gap, str) else gap)
    if runs is not None:
        watched["run"] = as_col(runs)
    rows = rows.withColumns({f"__{name}": column for name, column in watched.items()})
    rows = _placed(rows, df, keys, order_by, chunks)

    part = ["__chunk", *keys]
    order = Window.partitionBy(*part).orderBy(*order_by)
    row = F.row_number().over(order).cast("bigint")

    def begins(previous: Callable[[str], Column], now: Callable[[str], Column]) -> Column:
        """Whether a row starts a group, by what the row before it and the row itself say."""
        start = F.lit(False)
        if closes is not None:
            start = start | F.coalesce(previous("closes"), F.lit(False))
        if gap is not None:
            start = start | F.coalesce(now("time") > previous("due"), F.lit(False))
        if runs is not None:
            start = start | ~previous("run").eqNullSafe(now("run"))
        return start

    def numbered_in_chunk(frame: DataFrame) -> DataFrame:
        """The row's place in its chunk and key, and whether it starts a group after a row of the same chunk."""
        inner = (row > 1) & begins(lambda name: F.lag(f"__{name}").over(order), lambda name: F.col(f"__{name}"))
        return frame.withColumns({"__row": row} | ({"__inner": inner} if watched else {}))

    # One row per chunk and border key says what the rows after it need to know.
    facts = [F.count(F.lit(1)).alias("__n")]
    if watched:
        first = [F.min_by(f"__{name}", "__row").alias(f"__first_{name}") for name in watched]
        last = [F.max_by(f"__{name}", "__row").alias(f"__last_{name}") for name in watched]
        facts += [*first, *last, F.max(F.when(F.col("__inner"), F.col("__row"))).alias("__inner")]
    if closes is not None and tell_closed:
        facts.append(F.max(F.when(F.col("__closes"), F.col("__row"))).alias("__closing"))
    edges = rows.filter("__edge")
    carry = (numbered_in_chunk(edges) if watched else edges).groupBy(*part).agg(*facts)
    of_key = Window.partitionBy(*(keys or [F.lit(0)]))
    across = of_key.orderBy("__chunk")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    carry = carry.withColumn("__offset", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    kept = ["__offset"]
    if watched:
        begun = begins(lambda name: F.lag(f"__last_{name}").over(across), lambda name: F.col(f"__first_{name}"))
        carry = carry.withColumn("__begun", (F.col("__offset") == 0) | begun)
        own = F.coalesce(F.col("__offset") + F.col("__inner"), F.when(F.col("__begun"), F.col("__offset") + 1))
        carry = carry.withColumn("__own", own).withColumn("__before", F.max("__own").over(earlier))
        kept += ["__begun", "__before"]
    if closes is not None and tell_closed:
        carry = carry.withColumn("__closing", F.max(F.col("__offset") + F.col("__closing")).over(of_key))
        kept.append("__closing")
    carry = carry.select(*[F.col(name).alias(f"__at_{name}") for name in part], *kept)
    same = _all([F.col(name).eqNullSafe(F.col(f"__at_{name}")) for name in part])

    placed = numbered_in_chunk(rows).join(F.broadcast(carry), same, "left").drop(*(f"__at_{name}" for name in part))
    numbered = placed.withColumn("position", F.coalesce("__offset", F.lit(0)) + F.col("__row"))
    if not watched:
        numbered = numbered.withColumn("__segment", F.lit(1).cast("bigint"))
    else:
        start = F.when(F.col("__row") == 1, F.coalesce("__begun", F.lit(True))).otherwise(F.col("__inner"))
        latest = F.max(F.when(start, F.col("position"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
        numbered = numbered.withColumn("__segment", F.coalesce(latest, F.col("__before")))
    if closes is not None and tell_closed:
        ending = F.max(F.when(F.col("__closes"), F.col("position"))).over(Window.partitionBy(*part))
        ends = F.when(F.col("__edge"), F.col("__closing")).otherwise(ending)
        numbered = numbered.withColumn("closed", F.coalesce(F.col("__segment") <= ends, F.lit(False)))
    since = F.col("position") - F.col("__segment")
    if count is not None:
        since = since % (F.lit(count) if isinstance(count, int) else as_col(count))
    done = (
        numbered.withColumn("group_pos", (since + 1).cast("bigint"))
        .withColumn("group_start", F.col("position") - F.col("group_pos") + 1)
        .drop("__segment", "__row", "__inner", "__chunk", "__edge", *kept, *(f"__{name}" for name in watched))
    )
    return done if then is None else then(done)


def lists_of(
    df: DataFrame,
    keys: list[str],
    order_by: list[str],
    item: Column,
    rows: int,
    *,
    facts: list[Column] | None = None,
    chunks: int | None = None,
) -> DataFrame:
    """Per key the items in order, in pages of ``rows``: ``part`` 0, 1, ... and ``items``."""
    part = F.floor((F.col("position") - 1) / rows).cast("bigint")

    def listed(placed: DataFrame) -> DataFrame:
        gathered = F.sort_array(F.collect_list(F.struct("position", item.alias("item"))))
        return placed.groupBy(*keys, part.alias("part")).agg(
            F.count(F.lit(1)).alias("n"), *(facts or []), F.transform(gathered, lambda one: one["item"]).alias("items")
        )

    return number_groups(df, keys, order_by, chunks=chunks, then=listed)
