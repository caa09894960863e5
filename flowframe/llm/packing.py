"""Best-fit packing of documents into sequences of several permitted lengths.

Documents longer than the longest sequence are cut into pieces of just that length and
a rest. Pieces fall into groups of bounded size by a hash of their document; each group
is packed on its own, so work and memory per task do not grow with the input, and at
most a few sequences per group stay half empty. A group is packed longest piece first:
into the open bin with the least room that fits, else into a new bin. Which length is
opened is decided anew each time, over all permitted lengths jointly: by what a sequence
of that length, filled with the longest pieces still to be placed and cut down to what it
holds, would cost for each unit in it. In the end every bin is cut down to the shortest
permitted length that holds its contents. Opening one and the same length throughout is
tried too, and counts where it comes out cheaper.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.llm.base import pieces

#: Documents of a group, and repeated rows that go into one group together.
GROUP, COPIES = 20_000, 1_000


def cost(capacity: int, overhead: int) -> int:
    """What a sequence costs: its length, padding included, and a fixed part."""
    return capacity + overhead


def tightest(total: int, capacities: list[int]) -> int:
    """The shortest permitted length that holds so much."""
    return capacities[bisect_left(capacities, total)]


def least_cost(item: int, waiting: list[int], left: int, capacities: list[int], opened: list[int], overhead: int) -> int:
    """The length to open for an item: the one whose sequence would cost least for each unit in it.

    ``waiting`` holds all lengths, shortest first; the first ``left`` of them are still to be
    placed. Each length that may be opened is filled in thought with the longest of these
    that fit, and cut down to what it then holds. Ties go to the shorter length.
    """
    best = None
    for capacity in opened:
        if capacity < item:
            continue
        held, end = item, left
        while end:
            end = bisect_right(waiting, capacity - held, 0, end)
            if not end:
                break
            end -= 1
            held += waiting[end]
        price = (cost(tightest(held, capacities), overhead) / held, capacity)
        if best is None or price < best:
            best = price
    return tightest(item, capacities) if best is None else best[1]


def best_fit(lengths: list[int], capacities: list[int], opened: list[int], overhead: int = 0) -> list[tuple[int, list[int]]]:
    """Bins as (length to open, item numbers); items are tried in the given order, longest first.

    An item goes into the open bin with the least room that fits; else a bin is opened, of
    the one of ``opened`` that costs least for what is still to be placed, or of the
    shortest permitted length where none of them holds the item.
    """
    bins: list[tuple[int, list[int]]] = []
    rooms: list[tuple[int, int]] = []  # (room left, bin), sorted
    waiting = lengths[::-1]
    for item, length in enumerate(lengths):
        at = bisect_left(rooms, (length, -1))
        if at < len(rooms):
            room, k = rooms.pop(at)
            bins[k][1].append(item)
        else:
            if len(opened) == 1:
                room = opened[0] if opened[0] >= length else tightest(length, capacities)
            else:
                room = least_cost(length, waiting, len(lengths) - item - 1, capacities, opened, overhead)
            k = len(bins)
            bins.append((room, [item]))
        if room > length:
            insort(rooms, (room - length, k))
    return bins


def pack_lengths(lengths: list[int], capacities: list[int], overhead: int) -> list[tuple[int, list[int]]]:
    """(Permitted length, item numbers in order of place), every bin cut down to its contents.

    Bins are opened by least cost among all lengths; a single length for all bins may be
    cheaper at times, so each is tried as well, and the least cost of all counts, with ties
    to the choice among all lengths and then to the shorter one.
    """
    best: tuple[int, list[tuple[int, list[int]]]] | None = None
    for opened in (capacities, *([capacity] for capacity in capacities)):
        tight = [(tightest(sum(lengths[i] for i in items), capacities), items) for _, items in best_fit(lengths, capacities, opened, overhead)]
        total = sum(cost(capacity, overhead) for capacity, _ in tight)
        if best is None or total < best[0]:
            best = total, tight
    return best[1] if best else []


def _group(capacities: list[int], overhead: int, keys: list[str]):
    whole = capacities[-1]

    def pack(table: pa.Table) -> pa.Table:
        group = table["_group"][0].as_py()
        items = []  # (length, row, copy, piece, start)
        full = []
        for row, (length, first, n) in enumerate(
            zip(table["_length"].to_pylist(), table["_first"].to_pylist(), table["_copies"].to_pylist(), strict=True)
        ):
            for copy in range(first, first + n):
                cuts = range(0, max(length, 1), whole - 1)
                for piece, start in enumerate(cuts):
                    size = min(length - start, whole - 1) + 1
                    (full if size == whole else items).append((size, row, copy, piece, start))
        items.sort(key=lambda x: (-x[0], *x[1:]))
        bins = [(whole, [x]) for x in full]
        bins += [(c, [items[i] for i in held]) for c, held in pack_lengths([x[0] for x in items], capacities, overhead)]
        out = [[] for _ in range(8)]
        rows = []
        for k, (capacity, held) in enumerate(bins):
            offset = 0
            for size, row, copy, piece, start in held:
                rows.append(row)
                for column, x in zip(out, ((group << 32) + k, capacity, offset, copy, piece, start, size - 1, len(held)), strict=True):
                    column.append(x)
                offset += size
        kept = table.select(keys).take(pa.array(rows, pa.int64()))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.table([*kept.columns, *(pa.array(x, kind) for x, kind in zip(out, kinds, strict=True))], names=[*keys, *RESULTS])

    return pack


RESULTS = ["bin_id", "capacity", "offset", "copy", "piece", "start", "length", "bin_pieces"]


def pack(docs: DataFrame, length: Column, key: str = "doc_id", capacities: tuple[int, ...] = (2048, 4096, 8192, 16384, 32768), overhead: int = 32) -> DataFrame:
    """One row per piece: the key, ``copy`` and ``piece`` from 0, its ``start`` and
    ``length`` in its document, and ``bin_id``, ``capacity``, ``bin_pieces`` and its
    ``offset`` in that bin.

    ``length`` counts a document's units (characters, say); null counts as 0. Each piece
    takes one unit more for its end mark, so an empty document is one piece of length 0.
    Rows that repeat key and length are numbered by ``copy``. A null key is a value.
    No row is lost, cut pieces cover their document without overlap, and no bin holds
    more than its capacity.
    """
    if min(capacities) < 2 or overhead < 0:
        raise ValueError("a sequence holds at least one unit and the end mark")
    capacity = sorted(set(capacities))
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.coalesce(length, F.lit(0)).cast("long").alias("_length"))
    total = rows.count()
    counted = rows.groupBy("_key", "_length").agg(F.count("*").alias("_n"))
    parts = counted.select(
        "_key", "_length", "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(COPIES).cast("long"))).alias("_first")
    ).withColumn("_copies", F.least(F.col("_n") - F.col("_first"), F.lit(COPIES)))
    groups = parts.withColumn("_group", F.pmod(F.xxhash64("_key", "_length", "_first"), F.lit(pieces(total, GROUP))))
    kind = docs.schema[key].dataType.simpleString()
    schema = f"_key {kind}, bin_id long, capacity int, offset int, copy long, piece long, start long, length int, bin_pieces int"
    packed = groups.groupBy("_group").applyInArrow(_group(capacity, overhead, ["_key"]), schema)
    return packed.withColumnRenamed("_key", key)
