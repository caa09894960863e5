"""Regroup messages: correlation, release rules and output.

Each rule works on an explicit per-key order. After a release the key starts a
fresh group. Keys may be of any size (see ``flowframe.plans.ordered``). Groups that
a count or size bounds come as one row each; others as one row per message, or as
pages of the length the caller asks for. The shape never depends on the data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.functions.columns import as_col
from flowframe.plans.ordered import number_groups
from flowframe.plans.running import running_groups


@dataclass(frozen=True)
class Release:
    """When a group is complete.

    ``size`` is the number of messages expected, told by each message: a message
    that tells another number than the one before begins a group of its own;
    ``count`` a fixed number; ``closes`` is true for a message that ends its group;
    ``gap`` is the idle time after which the open group is released as it is, as
    text or, as a column, told by each message for the time after it. With ``reaches``
    a group is complete at the message at which its sum of ``amount`` (an integer
    expression) is that much or more; the sum then begins anew.
    """

    size: str | Column | None = None
    count: int | None = None
    closes: str | Column | None = None
    gap: str | Column | None = None
    time: str | None = None
    amount: str | Column | None = None
    reaches: int | None = None

    def __post_init__(self):
        others = [self.size, self.count, self.closes, self.gap]
        if all(rule is None for rule in (*others, self.reaches)):
            raise ValueError("give a release rule: size, count, closes, gap or reaches")
        if (self.amount is None) != (self.reaches is None):
            raise ValueError("a sum that is reached needs an amount and a limit")
        if self.reaches is not None and any(rule is not None for rule in others):
            raise ValueError("a sum that is reached excludes the other rules")
        if self.size is not None and self.count is not None:
            raise ValueError("size and count exclude each other")
        if self.gap is not None and self.time is None:
            raise ValueError("a gap needs the time column it is measured on")

    @property
    def bounded(self) -> bool:
        """Whether a group has a known largest number of messages."""
        return self.size is not None or self.count is not None

    def expected(self) -> Column:
        return F.lit(self.count) if self.size is None else F.col("__size")


def prepare(
    df: DataFrame,
    correlate: dict[str, str | Column],
    order_by: list[str],
    rule: Release,
    *,
    payload: str | Column = "payload",
    where: str | Column | None = None,
    output: dict[str, Column] | None = None,
    sort_by: list[str] | None = None,
) -> DataFrame:
    """The messages with the columns the rule and the output need, and no others.

    With ``output`` all columns stay, as its aggregates may use any of them.
    """
    made = {name: as_col(expression) for name, expression in correlate.items()}
    if rule.size is not None:
        made["__size"] = as_col(rule.size)
    if rule.amount is not None:
        made["__adds"] = as_col(rule.amount)
    if rule.closes is not None:
        made["__ends"] = F.coalesce(as_col(rule.closes), F.lit(False))
    if isinstance(rule.gap, Column):
        made["__gap"] = rule.gap
    if output is not None:
        return df.withColumns(made)
    made["__payload"] = as_col(payload)
    if where is not None:
        made["__chosen"] = F.coalesce(as_col(where), F.lit(False))
    plain = [*order_by, *(sort_by or []), *([rule.time] if rule.time is not None else [])]
    kept = [name for name in dict.fromkeys(plain) if name not in made]
    return df.select(*kept, *[column.alias(name) for name, column in made.items()])


def number(
    rows: DataFrame,
    keys: list[str],
    order_by: list[str],
    rule: Release,
    chunks: int | None = None,
    tell_closed: bool = True,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Prepared rows with their positions and groups."""
    if rule.reaches is not None:
        grouped = running_groups(rows, keys, order_by, F.col("__adds"), rule.reaches, chunks=chunks)
        return grouped if then is None else then(grouped)
    told = rule.size is not None
    return number_groups(
        rows, keys, order_by, count="__size" if told else rule.count, runs="__size" if told else None,
        closes="__ends" if rule.closes is not None else None,
        gap=F.col("__gap") if isinstance(rule.gap, Column) else rule.gap, time=rule.time, chunks=chunks, tell_closed=tell_closed, then=then,
    )


def emit(
    numbered: DataFrame,
    keys: list[str],
    rule: Release,
    *,
    output: dict[str, Column] | None = None,
    partial: bool = False,
    list_rows: int | None = None,
    sort_by: list[str] | None = None,
) -> DataFrame:
    """One row per group, per message or per page; open groups only with ``partial``."""
    names = [*keys, "group_start"]
    open_too = rule.bounded or partial or (rule.closes is None and rule.reaches is None)
    if not open_too and "closed" in numbered.columns:
        numbered = numbered.filter("closed")
    picked = "__chosen" in numbered.columns
    fields = [*(sort_by or []), "position", "__payload", *(["__chosen"] if picked else [])]
    every = F.sort_array(F.collect_list(F.struct(*fields))).alias("__every")
    wanted = F.filter("__every", lambda one: one["__chosen"]) if picked else F.col("__every")
    payloads = F.transform(wanted, lambda one: one["__payload"]).alias("payloads")
    if rule.bounded or output is not None:
        facts = [F.count(F.lit(1)).alias("n")]
        if rule.size is not None:
            facts.append(F.max("__size").alias("__size"))
        by_row = rule.closes is not None
        if by_row:
            facts.append(F.max("__ends").alias("__by_row"))
        made = [every] if output is None else [column.alias(name) for name, column in output.items()]
        groups = numbered.groupBy(*names).agg(*facts, *made)
        if rule.bounded and not partial:
            full = F.col("n") == rule.expected()
            groups = groups.filter(full | F.col("__by_row") if by_row else full)
        elif by_row and not open_too:
            groups = groups.filter("__by_row")
        return groups.select(*names, "n", *(output or [payloads]))
    # The totals come from the same rows, or pages, in full, so that Spark numbers them once for both.
    if list_rows is None:
        rows = numbered.select(*names, F.struct(*[name for name in fields if name not in (sort_by or [])]).alias("__one"))
        counted, n = rows, F.count("__one")
    else:
        part = F.floor((F.col("group_pos") - 1) / list_rows).cast("bigint").alias("part")
        rows = numbered.groupBy(*names, part).agg(every)
        counted, n = rows, F.sum(F.size("__every")).cast("bigint")
    totals = counted.groupBy(*(F.col(name).alias(f"__{name}") for name in names)).agg(n.alias("n"))
    same = F.lit(True)
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"__{name}"))
    rows = rows.join(totals, same)
    if list_rows is not None:
        return rows.select(*names, "part", "n", payloads)
    if picked:
        rows = rows.filter("__one.__chosen")
    return rows.select(*names, F.col("__one.position"), "n", F.col("__one.__payload").alias("payload"))


def aggregate(
    df: DataFrame,
    correlate: dict[str, str | Column],
    order_by: list[str],
    *,
    payload: str | Column = "payload",
    size: str | Column | None = None,
    count: int | None = None,
    closes: str | Column | None = None,
    gap: str | Column | None = None,
    time: str | None = None,
    amount: str | Column | None = None,
    reaches: int | None = None,
    where: str | Column | None = None,
    output: dict[str, Column] | None = None,
    partial: bool = False,
    list_rows: int | None = None,
    sort_by: list[str] | None = None,
    chunks: int | None = None,
) -> DataFrame:
    """The released groups.

    ``correlate`` names the key expressions; the release rule is that of
    ``Release``. Unreleased groups come out only with ``partial`` or with a
    ``gap``, as a timeout releases what is there. With a ``count`` or ``size`` a
    group is one row: key, ``group_start``, ``n`` and the list ``payloads`` (of the
    messages for which ``where`` is true, in ``sort_by`` or else arrival order).
    ``output`` gives aggregate columns instead. Any other group may be of any
    length, so it comes as one row per message with ``position``, the whole
    group's ``n`` and ``payload``; or, with ``list_rows``, as pages of so many
    messages: ``part`` 0, 1, ..., the whole group's ``n``, and ``payloads``.
    """
    rule = Release(size=size, count=count, closes=closes, gap=gap, time=time, amount=amount, reaches=reaches)
    keys = list(correlate)
    rows = prepare(df, correlate, order_by, rule, payload=payload, where=where, output=output, sort_by=sort_by)

    def released(numbered: DataFrame) -> DataFrame:
        return emit(
            numbered, keys, rule, output=output, partial=partial or gap is not None, list_rows=list_rows, sort_by=sort_by
        )

    # Groups that become one row tell themselves whether a closing message is among theirs.
    one_row = output is not None or rule.bounded
    return number(rows, keys, order_by, rule, chunks, tell_closed=not one_row, then=released)


def aggregate_sequence(
    df: DataFrame,
    order_by: list[str] | None,
    *,
    correlate: str | Column = "correlation_id",
    sequence: str = "sequence_number",
    size: str | Column = "sequence_size",
    payload: str | Column = "payload",
    chunks: int | None = None,
) -> DataFrame:
    """The default aggregator: release when as many messages came as announced.

    ``order_by`` is the order of arrival. After a release an id starts a new group,
    which may announce another size. A group's payloads are in the order of their
    sequence numbers. With ``None`` for the order every id is taken to be used
    once: its messages are one group, gathered in a single shuffle.
    """
    if order_by is not None:
        return aggregate(
            df, {"correlation_id": correlate}, order_by, payload=payload, size=size, sort_by=[sequence], chunks=chunks
        )
    item = F.struct(F.col(sequence).alias("at"), as_col(payload).alias("payload"))
    groups = df.groupBy(as_col(correlate).alias("correlation_id")).agg(
        F.count(F.lit(1)).alias("n"), F.max(as_col(size)).alias("__size"), F.sort_array(F.collect_list(item)).alias("__items")
    )
    payloads = F.transform("__items", lambda one: one["payload"]).alias("payloads")
    return groups.filter("n = __size").select("correlation_id", F.lit(1).cast("bigint").alias("group_start"), "n", payloads)
