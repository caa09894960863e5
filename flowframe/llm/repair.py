"""Repair conversations by the cheapest edits, ties to the least audit.

A conversation's rows in order form layers; a node is a layer and what the roles so far
allow next: anything (0), after a system row (1), after a user row (2), after an
assistant row (3). An arc keeps, re-roles or deletes the next row, or inserts a row.

1. Cost: rows are cut into blocks. Walking a block backwards turns costs to the end from
   behind it into those from before it. Costs less their smallest take few forms, so each
   step is looked up after its first time. One 4 x 4 table per block carries costs over
   block borders.
2. Rank: arcs that lie on a cheapest path stay. Nodes are ranked by the audits of length
   1, 2, 4, ... that begin there: a rank of twice the length is the rank of the pair of a
   node's rank and the rank of the node its pointer leads to; pointers double with it.
3. Path: at each node the arc with the least initial and then the least rank counts. The
   nodes of the path come from the doubled pointers, and blocks are chained by the state
   that each leaves in.

One conversation may hold any share of the rows: no task gets more of it than a block of
rows, one table per block, or, for a hash over its text, the text as a stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.llm.base import written
from flowframe.plans.ordered import number_groups

#: Rows of a block, and rows that one round of ranking takes; rows of blocks whose paths are kept, and their number.
BLOCK, ROUND, SHORT, KNOWN = 16_384, 65_536, 32, 50_000
#: Costs of the edits, and of a cut-off row that stays.
RENAME, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
FAR = 1 << 40
#: Role initials by class; any other is class 3. A row is sound (0), cut off (1) or must go (2).
INITIALS = "sua"
STEP = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}
#: The class that an inserted or renamed row has in each state, and the state after it.
FILL, FILLED = (1, 1, 2, 1), (2, 2, 3, 2)
#: Marks of the edits in the order of their initials D, I, K, R.
MARKS = "DIKR"
EMPTY_END = (0, FAR, FAR, 0)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Cost and next state of delete, keep and rename by (kind, mark, state); kind is 3 * class + soundness."""
    cost = np.full((12, 4, 4), FAR, dtype=np.int64)
    to = np.zeros((12, 4, 4), dtype=np.int64)
    for kind in range(12):
        role, state = divmod(kind, 3)
        for q in range(4):
            cost[kind, 0, q], to[kind, 0, q] = DELETE, q
            if state != 2:
                extra = CUT_OFF if state == 1 else 0
                if (q, role) in STEP:
                    cost[kind, 2, q], to[kind, 2, q] = extra, STEP[q, role]
                cost[kind, 3, q], to[kind, 3, q] = RENAME + extra, FILLED[q]
    return cost, to


COST, TO = _tables()


def closed(base) -> tuple[int, ...]:
    """Costs from a layer's states if rows may be inserted there first."""
    b0, b1, b2, b3 = (min(int(b), FAR) for b in base)
    v2, v3 = min(b2, INSERT + b3), min(b3, INSERT + b2)
    return min(b0, INSERT + v2, FAR), min(b1, INSERT + v2, FAR), min(v2, FAR), min(v3, FAR)


class Costs:
    """Costs to the end, less their smallest, by layer; every form and step is worked out once."""

    def __init__(self):
        self.forms: list[tuple[int, ...]] = []
        self.names: dict[tuple[int, ...], int] = {}
        self.steps: dict[int, tuple[int, int]] = {}

    def name(self, costs) -> tuple[int, int]:
        least = min(costs)
        form = tuple(c - least if c < FAR else FAR for c in costs)
        if form not in self.names:
            self.names[form] = len(self.forms)
            self.forms.append(form)
        return self.names[form], least

    def back(self, kinds: bytes, end) -> tuple[np.ndarray, np.ndarray]:
        """Form and smallest cost of every layer, the one behind the last row included."""
        form, least = self.name(end)
        forms, leasts = [form], [least]
        steps = self.steps
        for kind in reversed(kinds):
            at = form * 12 + kind
            step = steps.get(at)
            if step is None:
                after = np.array(self.forms[form])
                step = steps[at] = self.name(closed(np.minimum(COST[kind] + after[TO[kind]], FAR).min(axis=0)))
            form = step[0]
            least += step[1]
            forms.append(form)
            leasts.append(least)
        return np.array(forms[::-1]), np.array(leasts[::-1])

    def table(self, kinds: bytes) -> list[int]:
        """Costs from each state before the block to each state behind it."""
        columns = []
        for q in range(4):
            forms, leasts = self.back(kinds, [0 if q == e else FAR for e in range(4)])
            columns.append([min(c + int(leasts[0]), FAR) for c in self.forms[forms[0]]])
        return [columns[e][q] for q in range(4) for e in range(4)]


def ranked(first: np.ndarray, pointer: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks by whole audit, and the pointers over 1, 2, 4, ... edits.

    ``first`` is the mark of a node's first edit (0 at the end of a path, where the
    pointer leads to the node itself).
    """
    rank, pointers = first.astype(np.int64), [pointer]
    while True:
        behind = pointers[-1]
        _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[behind], return_inverse=True)
        if not first[behind].any():
            return rank, pointers
        pointers.append(behind[behind])


def solve(costs: Costs, blocks: list[tuple[bytes, tuple[int, ...], bool, int]]) -> list[tuple[list[int], list[str]]]:
    """Per block (kinds, costs behind it, whether it is the last, states it may be entered in):
    the state it is left in and the marks of the least cheapest path, by state of entry.

    Marks are D, K, R to user or assistant as u or a, and I of user or assistant as U or A.
    """
    optimal, target, done = [], [], []
    starts, layers = [], 0
    for kinds, end, last, _ in blocks:
        n = len(kinds)
        forms, leasts = costs.back(kinds, closed(end) if last else end)
        value = np.minimum(np.array(costs.forms)[forms] + leasts[:, None], FAR)
        here = np.zeros((n + 1, 4, 4), dtype=bool)
        to = np.zeros((n + 1, 4, 4), dtype=np.int64)
        base = 4 * layers
        if n:
            k = np.frombuffer(kinds, dtype=np.uint8)
            after = np.take_along_axis(value[1:, None, :].repeat(4, 1), TO[k], axis=2)
            here[:n] = (COST[k] + after == value[:n, None, :]) & (COST[k] < FAR)
            to[:n] = base + 4 * np.arange(1, n + 1)[:, None, None] + TO[k]
        inserts = n + 1 if last else n
        fill = np.array(FILLED)
        here[:inserts, 1] = INSERT + value[:inserts][:, fill] == value[:inserts]
        to[:inserts, 1] = base + 4 * np.arange(inserts)[:, None] + fill
        here &= (value < FAR)[:, None, :]
        optimal.append(here)
        target.append(to)
        starts.append(base)
        layers += n + 1
    here, to = np.concatenate(optimal), np.concatenate(target)
    here, to = here.transpose(0, 2, 1).reshape(-1, 4), to.transpose(0, 2, 1).reshape(-1, 4)
    own = np.arange(len(here))
    ending = ~here.any(axis=1)
    least = here.argmax(axis=1)
    first = np.where(ending, 0, least + 1)
    rank, _ = ranked(first, np.where(ending, own, to[own, least]))
    order = np.where(here, np.arange(1, 5) * (len(here) + 1) + rank[to], np.iinfo(np.int64).max)
    chosen = order.argmin(axis=1)
    first = np.where(ending, 0, chosen + 1)
    _, pointers = ranked(first, np.where(ending, own, to[own, chosen]))

    begin = np.array([base + q for (_, _, _, entries), base in zip(blocks, starts, strict=True) for q in range(entries)])
    nodes, path, place = begin, np.arange(len(begin)), np.zeros(len(begin), dtype=np.int64)
    final = begin
    for power in range(len(pointers) - 1, -1, -1):
        ahead = pointers[power]
        more = ahead[nodes]
        on = first[more] > 0
        nodes = np.concatenate([nodes, more[on]])
        path = np.concatenate([path, path[on]])
        place = np.concatenate([place, place[on] + (1 << power)])
        final = ahead[final]
    final = pointers[-1][final]
    live = first[nodes] > 0
    nodes, path, place = nodes[live], path[live], place[live]
    by = np.lexsort((place, path))
    nodes, path = nodes[by], path[by]
    fills = np.array(FILL)[nodes % 4]
    codes = np.frombuffer(b" DIK ", dtype=np.uint8)[first[nodes]].copy()
    codes[first[nodes] == 4] = np.frombuffer(b" ua", dtype=np.uint8)[fills[first[nodes] == 4]]
    codes[first[nodes] == 2] = np.frombuffer(b" UA", dtype=np.uint8)[fills[first[nodes] == 2]]
    cuts = np.searchsorted(path, np.arange(len(begin) + 1))
    out, at = [], 0
    for _, _, _, entries in blocks:
        marks = [codes[cuts[i]:cuts[i + 1]].tobytes().decode() for i in range(at, at + entries)]
        out.append(([int(x) % 4 for x in final[at:at + entries]], marks))
        at += entries
    return out


def _tables_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    costs = Costs()
    known: dict[bytes, tuple[list[int], int]] = {}

    def of(kinds: bytes) -> tuple[list[int], int]:
        if kinds in known:
            return known[kinds]
        roles = [k // 3 for k in kinds]
        made = costs.table(kinds), sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(roles, roles[1:]))
        if len(kinds) <= SHORT:
            if len(known) >= KNOWN:
                known.clear()
            known[kinds] = made
        return made

    for batch in batches:
        rows = [bytes(k) for k in batch.column("kinds").to_pylist()]
        made = [of(k) for k in rows]
        columns = [
            batch.column("conv"), batch.column("block"), pa.array([m[0] for m in made], pa.list_(pa.int64())), pa.array([m[1] for m in made], pa.int64()),
            pa.array([k[0] // 3 for k in rows], pa.int32()), pa.array([k[-1] // 3 for k in rows], pa.int32()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["conv", "block", "table", "wrong", "first", "last"])


def _ends_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block the costs behind it, and per conversation its cost and its adjacent roles out of order."""
    for batch in batches:
        convs, out = [], []
        for k, blocks in enumerate(batch.column("blocks").to_pylist()):
            after, rows = closed(EMPTY_END), []
            wrong = sum(b["wrong"] for b in blocks)
            wrong += sum((a["last"], b["first"]) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(blocks, blocks[1:]))
            for b in reversed(blocks):
                final = b is blocks[-1]
                rows.append([b["block"], list(EMPTY_END if final else after), final])
                t = b["table"]
                after = [min(min(t[4 * q + e] + after[e] for e in range(4)), FAR) for q in range(4)]
            for block, end, final in rows:
                convs.append(k)
                out.append((block, end, final, after[0], wrong))
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.int64(), pa.int64()]
        columns = [pa.array(x, kind) for x, kind in zip(zip(*out), kinds)] if out else [pa.array([], kind) for kind in kinds]
        conv = batch.column("conv").take(pa.array(convs, pa.int64()))
        yield pa.RecordBatch.from_arrays([conv, *columns], names=["conv", "block", "end", "final", "cost", "illegal"])


def _paths_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    costs = Costs()
    # Short conversations are alike: each kind of block is solved once in a task.
    known: dict[tuple, tuple[list[int], list[str]]] = {}
    for batch in batches:
        numbers = batch.column("block").to_pylist()
        blocks = [
            (bytes(kinds), tuple(end), final, 1 if number == 0 else 4)
            for kinds, end, final, number in zip(batch.column("kinds").to_pylist(), batch.column("end").to_pylist(), batch.column("final").to_pylist(), numbers, strict=True)
        ]
        if len(known) > KNOWN:
            known = {}
        new, at = list(dict.fromkeys(b for b in blocks if b not in known)), 0
        long = {}
        while at < len(new):
            rows, to = 0, at
            while to < len(new) and (to == at or rows + len(new[to][0]) <= ROUND):
                rows += len(new[to][0])
                to += 1
            for block, solved in zip(new[at:to], solve(costs, new[at:to]), strict=True):
                (known if len(block[0]) <= SHORT else long)[block] = solved
            at = to
        solved = [known.get(b) or long[b] for b in blocks]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("block"), pa.array([s[0] for s in solved], pa.list_(pa.int32())),
             pa.array([s[1] for s in solved], pa.list_(pa.string())), pa.array([[len(m) for m in s[1]] for s in solved], pa.list_(pa.int64()))],
            names=["conv", "block", "exits", "marks", "lengths"],
        )


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state each block is entered in, and the number of edits before it."""
    for batch in batches:
        convs, out = [], []
        for k, blocks in enumerate(batch.column("blocks").to_pylist()):
            state = steps = 0
            for b in blocks:
                convs.append(k)
                out.append((b["block"], state, steps))
                steps += b["lengths"][state]
                state = b["exits"][state]
        kinds = [pa.int64(), pa.int32(), pa.int64()]
        columns = [pa.array(x, kind) for x, kind in zip(zip(*out), kinds)] if out else [pa.array([], kind) for kind in kinds]
        conv = batch.column("conv").take(pa.array(convs, pa.int64()))
        yield pa.RecordBatch.from_arrays([conv, *columns], names=["conv", "block", "entry", "before"])


def _edits_of(block_rows: int):
    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            low = 0
            while low < whole.num_rows:
                # As many blocks as a round of ranking takes, so that the rows made at a time are bounded.
                high, size = low, 0
                while high < whole.num_rows and (high == low or size < ROUND):
                    size += len(whole.column("marks")[high].as_py())
                    high += 1
                batch, low = whole.slice(low, high - low), high
                texts = [m.encode() for m in batch.column("marks").to_pylist()]
                lengths = np.array([len(t) for t in texts])
                marks = np.frombuffer(b"".join(texts), dtype=np.uint8)
                new = (marks == ord("U")) | (marks == ord("A"))
                row = np.repeat(np.arange(len(texts)), lengths)
                begin = np.cumsum(lengths) - lengths
                taken = np.concatenate([[0], np.cumsum(~new)])
                inside = taken[1:] - taken[begin][row]
                place = batch.column("block").to_numpy()[row] * block_rows + inside
                steps = batch.column("before").to_numpy()[row] + np.arange(len(marks)) - begin[row]
                letters = pa.DictionaryArray.from_arrays(pa.array(marks.astype(np.int32)), pa.array([chr(k) for k in range(128)])).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("conv").take(pa.array(row)), pa.array(steps, pa.int64()), letters, pa.array(place, pa.int64(), mask=new)],
                    names=["conv", "step", "mark", "position"],
                )

    return edits


def _same(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join by columns whose nulls are equal; the right side's are dropped."""
    other = right.select(*[F.col(c).alias(f"__{c}" if c in names else c) for c in right.columns])
    same = F.lit(True)
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"__{name}"))
    return left.join(other, same, how).drop(*(f"__{name}" for name in names))


def _plain(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    said = F.coalesce(F.col(f"`{text}`"), F.lit(" "))
    return conversations.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        said.alias("text"), F.unhex(F.sha2(said, 256)).alias("print"),
    )


def judged_rows(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows of each conversation in order with their first fault.

    ``conv``, ``turn``, ``role`` (null is one space), ``print`` (the SHA-256 by which texts
    are told apart; a null text is one space), ``position`` from 1 by turn (nulls first),
    role and print, and ``fault``: ``blank`` (nothing but white space), ``duplicate`` (role
    and text stood earlier), ``truncated`` (the last character other than white space is
    none of ``.!?``) or null. Rows that are equal in all four are summed up before they are
    numbered. Other columns of the frame are left out, so their names may be any.
    """
    plain = _plain(conversations, conv, turn, role, text)
    visible = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    own = F.when(visible == "", "blank").when(~F.substring(visible, -1, 1).isin(".", "!", "?"), "truncated")
    counted = plain.select("conv", "turn", "role", "print", own.alias("own")).groupBy("conv", "turn", "role", "print", "own").agg(F.count(F.lit(1)).alias("copies"))
    # Nulls come first, and Spark's smallest struct has nulls first too.
    earliest = counted.groupBy("conv", "role", "print").agg(F.min(F.struct("turn")).alias("earliest"))
    known = _same(counted, earliest, ["conv", "role", "print"])
    later = ~F.col("turn").eqNullSafe(F.col("earliest.turn"))
    # In two steps, so that no list grows with the number of copies.
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(BLOCK).cast("long")))
    parts = known.select("conv", "turn", "role", "print", "own", "copies", later.alias("later"), first.alias("first"))
    upto = F.least(F.col("first") + BLOCK, F.col("copies")) - 1
    shared = parts.select("conv", "turn", "role", "print", "own", "later", F.explode(F.sequence("first", upto)).alias("copy"))
    again = (F.col("own").isNull() | (F.col("own") != "blank")) & (F.col("later") | (F.col("copy") > 0))
    fault = F.when(again, "duplicate").otherwise(F.col("own"))
    placed = number_groups(shared.withColumn("fault", fault), ["conv"], ["turn", "role", "print", "copy"])
    return placed.select("conv", "turn", "role", "print", "position", "fault")


def texts_of(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The text of each row by ``row``, a struct of its conversation, turn, role and print."""
    plain = _plain(conversations, conv, turn, role, text)
    return plain.groupBy(F.struct("conv", "turn", "role", "print").alias("row")).agg(F.first("text").alias("text"))


def repair(rows: DataFrame, texts: DataFrame, block_rows: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The cheapest edits of ``judged_rows``, and what each conversation costs.

    Edits: ``conv``, ``step`` from 0, ``edit`` (K, R, D, I), ``position`` of the row (null
    where one is inserted), and ``role`` and ``text`` afterwards (both null where deleted;
    texts come from ``texts_of``). The roles that stay spell ``(s?(ua)+)?`` by their first
    letters; of all cheapest edits those with the least audit (the initials in order) are
    taken. Costs: ``conv``, ``cost`` and ``illegal`` (neighbours whose initials are none of
    su, ua, au). A conversation without rows has none here.
    """
    initial = F.substring("role", 1, 1)
    role = F.lit(3)
    for k, letter in enumerate(INITIALS):
        role = F.when(initial == letter, k).otherwise(role)
    sound = F.when(F.col("fault").isNull(), 0).when(F.col("fault") == "truncated", 1).otherwise(2)
    kind = F.struct("position", (role * 3 + sound).cast("tinyint").alias("kind"))
    block = F.floor((F.col("position") - 1) / block_rows).cast("long").alias("block")
    gathered = rows.groupBy("conv", block).agg(F.sort_array(F.collect_list(kind)).alias("kinds"))
    blocks = written(gathered.select("conv", "block", F.transform("kinds", lambda k: k["kind"]).alias("kinds")), "blocks")
    conv = f"conv {rows.schema['conv'].dataType.simpleString()}"
    tables = blocks.mapInArrow(_tables_of, f"{conv}, block long, table array<long>, wrong long, first int, last int")
    per_conv = tables.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("block", "table", "wrong", "first", "last"))).alias("blocks"))
    ends = written(per_conv.mapInArrow(_ends_of, f"{conv}, block long, end array<long>, final boolean, cost long, illegal long"), "ends")
    solving = _same(blocks, ends.select("conv", "block", "end", "final"), ["conv", "block"])
    paths = written(solving.mapInArrow(_paths_of, f"{conv}, block long, exits array<int>, marks array<string>, lengths array<long>"), "paths")
    links = paths.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("block", "exits", "lengths"))).alias("blocks"))
    entries = links.mapInArrow(_chain, f"{conv}, block long, entry int, before long")
    chosen = _same(paths, entries, ["conv", "block"]).select("conv", "block", "before", F.col("marks")[F.col("entry")].alias("marks"))
    edits = chosen.mapInArrow(_edits_of(block_rows), f"{conv}, step long, mark string, position long")
    held = _same(edits, rows.select("conv", "position", "turn", "role", "print"), ["conv", "position"], "left")
    wanted = F.when(F.col("mark").isin("K", "u", "a"), F.struct("conv", "turn", "role", "print"))
    held = held.withColumn("__row", wanted).join(texts, F.col("__row") == F.col("row"), "left")
    named = F.when(F.lower("mark") == "u", "user").when(F.lower("mark") == "a", "assistant").when(F.col("mark") == "K", F.col("role"))
    said = F.when(F.col("mark").isin("U", "A"), "").when(F.col("mark") != "D", F.col("text"))
    edit = F.translate("mark", "uaUA", "RRII")
    done = held.select("conv", "step", edit.alias("edit"), "position", named.alias("role"), said.alias("text"))
    return done, ends.filter("block = 0").select("conv", "cost", "illegal")


def faults(rows: DataFrame) -> DataFrame:
    """Per conversation of ``judged_rows``: ``gaps`` between turns, and rows ``blank``, ``duplicate`` and ``truncated``."""
    turns = F.count_distinct("turn")
    return rows.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - turns, F.lit(0)).cast("long").alias("gaps"),
        *[F.count(F.when(F.col("fault") == name, 1)).alias(name) for name in ("blank", "duplicate", "truncated")],
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    conv, audit, digest, lines = None, [], hashlib.sha256(), 0
    begun = False

    def row():
        return pa.RecordBatch.from_arrays(
            [conv, pa.array(["".join(audit)]), pa.array([digest.hexdigest()])], names=["conv", "audit", "repaired_sha256"]
        )

    for batch in batches:
        keys = batch.column("conv")
        plain = keys.to_pylist()
        for i, (edit, role, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("edit", "role", "text")), strict=True)):
            if not begun or plain[i] != last:
                if begun:
                    yield row()
                conv, last, audit, digest, lines, begun = keys.slice(i, 1), plain[i], [], hashlib.sha256(), 0, True
            audit.append(edit)
            if edit != "D":
                digest.update((("\n" if lines else "") + f"{role}:{text}").encode())
                lines += 1
    if begun:
        yield row()


def digests(edits: DataFrame) -> DataFrame:
    """Per conversation its ``audit`` and the SHA-256 of the repaired ``role:text`` lines, in one pass over sorted rows."""
    conv = f"conv {edits.schema['conv'].dataType.simpleString()}"
    rows = edits.select("conv", "step", "edit", "role", "text").repartition("conv").sortWithinPartitions("conv", "step")
    return rows.select("conv", "edit", "role", "text").mapInArrow(_digests, f"{conv}, audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with faults put in by crc32 of ``conv_id:turn`` modulo 20: 0 drops a
    row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes its role user. Nulls are one space there."""
    def spaced(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    lot = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("lot") == 4, "user").otherwise(F.col("role"))
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), lot.alias("lot"))
    rows = rows.filter("lot <> 0").withColumns({"text": text, "role": role})
    twice = F.explode(F.when(F.col("lot") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.withColumn("copy", twice).select("conv_id", "turn", "role", "text")
