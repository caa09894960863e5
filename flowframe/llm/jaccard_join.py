"""Self-join of word-shingle sets by Jaccard similarity, and its connected groups.

**Partition.** Sets fall into bands by size, each ``100 / percent`` times as wide as the
one before, so two linked sets lie in one band or in neighbours. A scheme serves a band
and the next. Two linked sets of a scheme differ in at most H shingles. The scheme deals
the universe of shingles into segments by a hash, so by the pigeonhole principle:

* with ``H + T`` segments, at least T of them are equal in both sets (exact subsets), or
* with ``(H + 1) / 2`` segments, at least one differs by one shingle at most; it is found
  by the segment itself against the other's with one shingle taken away
  (one-deletion neighbourhoods).

**Allocation by cost.** A scheme takes the allotment that costs less: the keys it emits
against the segments so short that many sets share them. With T equal segments in
common, each set may also leave out its T - 1 most frequent keys, since the rarest common
key is never among them. Frequencies are counted over all sets.

**Verification.** Keys held by few sets give pairs. Sets that share the frequent ones are
joined into families, and a family is compared in blocks, each pair of blocks one task's
work that returns just enough links to connect what is linked. Parities of hashed
shingles, which bound the difference of two sets from below, spare most comparisons of
pairs. Every link rests on the counted intersection of the two whole sets.

Sets and shingles are known by 64-bit fingerprints. Equal sets are one class.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.base import pieces, written
from flowframe.llm.components import components
from flowframe.llm.shingles import mix, shingle_sets

#: No set has more shingles than this; bands end beyond it.
LARGEST = 1 << 40
#: Sets of a key whose pairs are listed one by one; more go into families.
LISTED = 8
#: Keys that one group of the first exchange holds, and keys that a task gathers before it sends.
KEYS, GATHERED = 500_000, 1 << 19
#: Sets and shingles in a block of a family.
BLOCK_SETS, BLOCK_SHINGLES = 512, 250_000
#: Bits of the filter that tells scans which sets take part; a fixed size.
FILTER_BITS = 1 << 25

_LOWER, _UPPER, _WHOLE, _DELETED = 0, 2, 0, 1  # the two lowest bits of a class in a key's rows


@cache
def band_edges(percent: int) -> list[int]:
    if not 1 <= percent <= 99:
        raise ValueError("the similarity must lie between 1 and 99 percent")
    edges = [1]
    while len(edges) < 2 or edges[-2] <= LARGEST:
        edges.append(-(-edges[-1] * 100 // percent))
    return edges


def scheme_bits(percent: int) -> int:
    """Lowest bits of a key that name its scheme; there are as many schemes as bands."""
    return max(7, (len(band_edges(percent)) - 1).bit_length())


@cache
def allotment(scheme: int, percent: int) -> tuple[int, int, bool]:
    """Segments, equal segments guaranteed (T), and whether one-deletion neighbourhoods are used."""
    edges = band_edges(percent)
    small = edges[scheme + 1] - 1
    differ = (100 - percent) * (small + small * 100 // percent) // (100 + percent)
    if differ == 0:
        return 0, 0, False
    spare = 2 + -(-differ // 5)
    whole, halved = differ + spare, -(-(differ + 1) // 2)
    size = edges[scheme + 1]

    def short(segments: int, least: int) -> float:
        """Segments expected to hold fewer than ``least`` shingles."""
        mean = size / segments
        return segments * math.exp(-mean) * sum(mean**k / math.factorial(k) for k in range(least))

    exact = whole + LISTED * short(whole, 2)
    deleting = halved + size + LISTED * short(halved, 3)
    return (halved, 1, True) if deleting < exact else (whole, spare, False)


def class_of(members: np.ndarray) -> int:
    """Fingerprint of a set; its two lowest bits are free."""
    size = np.array([len(members)], dtype=np.uint64)
    whole = mix(np.add.reduce(members, keepdims=True) + mix(size)) ^ mix(np.bitwise_xor.reduce(members, keepdims=True) + size)
    return int(whole.view(np.int64)[0]) & ~3


def keys_of(members: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, int]]:
    """Keys of a set with the flags that its class carries there; a key's lowest bits name its scheme."""
    edges = band_edges(percent)
    band = int(np.searchsorted(edges, len(members), side="right")) - 1
    bits = np.uint64(scheme_bits(percent))
    for scheme, side in ((band, _LOWER), (band - 1, _UPPER)):
        segments, _, deleting = allotment(scheme, percent) if scheme >= 0 else (0, 0, False)
        if not segments:
            continue
        place = (mix(members + np.uint64(scheme + 1)) % np.uint64(segments)).astype(np.int64)
        spread = mix(members)
        sums = np.zeros(segments, dtype=np.uint64)
        np.add.at(sums, place, spread)
        tags = mix(np.arange(segments, dtype=np.uint64) + np.uint64((scheme + 1) << 32))
        yield mix(sums ^ tags) << bits | np.uint64(scheme), side | _WHOLE
        if deleting:
            yield mix((sums[place] - spread) ^ tags[place]) << bits | np.uint64(scheme), side | _DELETED


SetBatches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's set size and class (null without words)."""
    for batch in batches:
        sets = [(len(s), class_of(s) if len(s) else None) for s in shingle_sets(batch.column(1))]
        sizes, classes = zip(*sets, strict=True) if sets else ((), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64())],
            names=["doc_id", "n_shingles", "class"],
        )


def _emit(percent: int, groups: int) -> SetBatches:
    """Keys and classes of the sets, in bundles for each group of keys; of equal sets in a task, the first."""

    def bundles(keys: list[np.ndarray], classes: list[np.ndarray]) -> pa.RecordBatch:
        every, owner = np.concatenate(keys), np.concatenate(classes)
        group = ((every >> np.uint64(scheme_bits(percent))) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        ends = np.cumsum(np.bincount(group, minlength=groups))
        cut = lambda x: [part.tobytes() for part in np.split(x[order], ends[:-1])]
        return pa.RecordBatch.from_arrays(
            [pa.array(range(groups), pa.int64()), pa.array(cut(every), pa.binary()), pa.array(cut(owner), pa.binary())],
            names=["group", "keys", "classes"],
        )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys, classes, held = [], [], 0
        for batch in batches:
            for members in shingle_sets(batch.column(0)):
                name = class_of(members) if len(members) else None
                if name is None or name in seen:
                    continue
                seen.add(name)
                for some, flags in keys_of(members, percent):
                    keys.append(some)
                    classes.append(np.full(len(some), name | flags, dtype=np.int64))
                    held += len(some)
                if held >= GATHERED:
                    yield bundles(keys, classes)
                    keys, classes, held = [], [], 0
        if held:
            yield bundles(keys, classes)

    return emit


def _shared(table: pa.Table) -> pa.Table:
    """The keys of a group that can make a pair, with their classes and the number of these."""
    keys = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in table["keys"].to_pylist()])
    classes = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in table["classes"].to_pylist()])
    order = np.lexsort((classes, keys))
    keys, classes = keys[order], classes[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (classes[1:] != classes[:-1])
    keys, classes = keys[new], classes[new]
    starts = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0)
    counts = np.diff(starts, append=len(keys))
    any_of = lambda flags: np.add.reduceat(flags.astype(np.int64), starts) > 0
    useful = (counts > 1) & any_of(classes & _UPPER == 0) & any_of(classes & _DELETED == 0)
    keep = np.repeat(useful, counts)
    return pa.table(
        {"key": keys[keep].view(np.int64), "class": classes[keep], "holders": np.repeat(counts, counts)[keep]}
    )


def kept_keys(docs: DataFrame, percent: int, shingles: int) -> DataFrame:
    """Keys and classes that are left after each class drops the keys it may do without."""
    groups = pieces(shingles * 7 // 10, KEYS)
    bundles = docs.mapInArrow(_emit(percent, groups), "group long, keys binary, classes binary")
    # More partitions than groups, so that few groups meet in one.
    shared = bundles.repartition(2 * groups, "group").groupBy("group").applyInArrow(_shared, "key long, class long, holders long")
    spare = [allotment(k, percent)[1] - 1 for k in range(len(band_edges(percent)) - 1)] + [0]
    scheme = F.col("key").bitwiseAND((1 << scheme_bits(percent)) - 1)
    # A whole key and a deleted one of the same class lie in schemes that drop none.
    rank = F.row_number().over(Window.partitionBy("class", scheme).orderBy(F.desc("holders"), "key"))
    may_drop = F.element_at(F.array(*(F.lit(max(0, x)) for x in spare)), (scheme + 1).cast("int"))
    return written(shared.select("key", "class", rank.alias("rank"), may_drop.alias("spare")).filter("rank > spare").select("key", "class"), "kept-keys")


def _holders(kept: DataFrame) -> DataFrame:
    """Keys that can still make a pair, and their number of holders."""
    whole = F.sum((F.col("class").bitwiseAND(_DELETED) == 0).cast("int"))
    lower = F.sum((F.col("class").bitwiseAND(_UPPER) == 0).cast("int"))
    counts = kept.groupBy("key").agg(F.count("*").alias("holders"), whole.alias("whole"), lower.alias("lower"))
    return written(counts.filter("holders > 1 and whole > 0 and lower > 0").select("key", "holders"), "holders")


def _listed_pairs(held: DataFrame) -> DataFrame:
    """The pairs of classes that share a key, each once."""
    lists = held.groupBy("key").agg(F.array_sort(F.collect_list("class")).alias("classes"))
    every = F.expr(
        "flatten(transform(classes, x -> transform(filter(classes, y -> y > x and (x & 1) + (y & 1) < 2 and (x & 2) + (y & 2) < 4), "
        "y -> struct(least(x & ~3L, y & ~3L) as a, greatest(x & ~3L, y & ~3L) as b))))"
    )
    return lists.select(F.explode(every).alias("pair")).select("pair.a", "pair.b").filter("a <> b").distinct()


SKETCH = 256


def _needed(bits: np.ndarray) -> SetBatches:
    """The sets whose class is in the filter, with their parity sketch; of equal sets in a task, the first."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rows = []
            for members in shingle_sets(batch.column(0)):
                name = class_of(members) if len(members) else None
                if name is None or name in seen:
                    continue
                at = (name >> 2) % FILTER_BITS
                if bits[at >> 3] >> (at & 7) & 1:
                    seen.add(name)
                    parity = np.bincount((mix(members + np.uint64(977)) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
                    words = np.packbits((parity & 1).astype(bool)).view(np.int64)
                    rows.append((name, len(members), *map(int, words), members.tobytes()))
                if len(rows) >= 256:
                    yield _set_rows(rows)
                    rows = []
            if rows:
                yield _set_rows(rows)

    return pick


_SET_NAMES = ["class", "size", "s0", "s1", "s2", "s3", "members"]
_SET_SCHEMA = "class long, size long, s0 long, s1 long, s2 long, s3 long, members binary"


def _set_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=_SET_NAMES)


def needed_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """One row per class of ``classes`` with its whole set. A filter of fixed size spares the rest the shuffle."""
    at = F.pmod(F.shiftright("class", 2), F.lit(FILTER_BITS))
    words = classes.groupBy((at / 32).cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(shiftright(class, 2), {FILTER_BITS}) % 32 as int))")).alias("bits"))
    found = words.toPandas()
    filled = np.zeros(FILTER_BITS // 32, dtype="<u4")
    filled[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64).astype(np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast(filled.view(np.uint8))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _needed(shared.value)(batches)

    picked = docs.mapInArrow(pick, _SET_SCHEMA).join(classes, "class", "left_semi")
    return written(picked.dropDuplicates(["class"]), "sets")


def linked(inter: int | np.ndarray, size_a: int | np.ndarray, size_b: int | np.ndarray, percent: int):
    return 100 * inter >= percent * (size_a + size_b - inter)


def _verify(percent: int) -> SetBatches:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = [], []
            for a, b, x, y in zip(*(batch.column(k) for k in range(4)), strict=True):
                x, y = (np.frombuffer(z.as_py(), dtype=np.uint64) for z in (x, y))
                if linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent):
                    u.append(a.as_py())
                    v.append(b.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return verify


def verified_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are linked, as ``u`` and ``v``."""
    facts = sets.drop("members")
    side = lambda x: facts.select(*(F.col(c).alias(x if c == "class" else f"{x}_{c}") for c in facts.columns))
    differ = sum((F.bit_count(F.col(f"a_s{k}").bitwiseXOR(F.col(f"b_s{k}"))) for k in range(4)), F.lit(0))
    near = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        (100 * F.least("a_size", "b_size") >= percent * F.greatest("a_size", "b_size"))
        & ((100 + percent) * differ <= (100 - percent) * (F.col("a_size") + F.col("b_size")))
    )
    near = written(near.select("a", "b"), "near-pairs")
    members = sets.select("class", "members")
    whole = near.join(members.toDF("a", "a_members"), "a").join(members.toDF("b", "b_members"), "b")
    return whole.select("a", "b", "a_members", "b_members").mapInArrow(_verify(percent), "u long, v long")


def _forest(percent: int):
    """Links that connect what is linked among the sets of two blocks (or of one)."""

    def connect(table: pa.Table) -> pa.Table:
        names = table["class"].to_numpy()
        sets = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in table["members"]]
        own = table["block"].to_numpy() == table["low"].to_numpy()
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        shingles, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), sizes)
        place = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)[column]
        row, place = row[place >= 0], place[place >= 0]
        order = np.argsort(place, kind="stable")
        row, place = row[order], place[order]
        inter = np.zeros((len(sets), len(sets)), dtype=np.float32)
        width = 4096
        cuts = np.searchsorted(place, np.arange(0, (place[-1] if len(place) else -1) + width + 1, width))
        for k, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            held = np.zeros((len(sets), width), dtype=np.float32)
            held[row[low:high], place[low:high] - k * width] = 1
            inter += held @ held.T
        near = linked(inter.astype(np.int64), sizes[:, None], sizes[None, :], percent)
        if not own.all():
            near &= own[:, None] != own[None, :]  # within a block, that block's own task looks
        u, v = [], []
        left = np.ones(len(sets), dtype=bool)
        for start in range(len(sets)):
            if not left[start]:
                continue
            left[start] = False
            reach = [start]
            while reach:
                one = reach.pop()
                new = np.flatnonzero(near[one] & left)
                left[new] = False
                reach.extend(new.tolist())
                u.extend([names[one]] * len(new))
                v.extend(names[new].tolist())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return connect


def family_links(hot: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that connect what is linked among classes that share frequent keys."""
    # Written, so that Spark may split the rows of a key that very many classes hold.
    pivots = written(hot.groupBy("key").agg(F.min("class").alias("v")), "pivots")
    edges = hot.select("key", F.col("class").alias("u")).join(pivots, "key")
    named = components(edges.select(F.col("u").bitwiseAND(F.lit(~3)).alias("u"), F.col("v").bitwiseAND(F.lit(~3)).alias("v")))
    roots = named.select(F.col("root").alias("node"), "root").distinct()
    families = named.union(roots).withColumnsRenamed({"node": "class", "root": "family"})
    members = written(families.join(sets.select("class", "size"), "class"), "families")
    blocks = members.groupBy("family").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    placed = members.join(written(blocks, "blocks"), "family").withColumn("block", F.pmod(F.xxhash64("class"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = placed.select("family", "class", "block", other.alias("other")).select(
        "family", "class", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    whole = cells.join(sets.select("class", "members"), "class")
    return whole.groupBy("family", "low", "high").applyInArrow(_forest(percent), "u long, v long")


def jaccard_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``class`` of every row.

    Two documents are linked if ``100 * intersection >= percent * union`` of their shingle
    sets; ``component_id`` is the smallest id that links lead to, the row's own included.
    Null, empty and wordless texts have size 0, no class, and are linked with nothing.
    Equal sets are linked. Repeated rows each appear. A null id is never the smallest; a
    group of null ids has a null ``component_id``.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    base = written(rows.mapInArrow(_describe, f"doc_id {kind}, n_shingles long, class long"), "set-sizes")
    shingles = base.agg(F.sum("n_shingles")).first()[0] or 0
    texts = rows.select("text")
    kept = kept_keys(texts, percent, shingles)
    held = kept.join(_holders(kept), "key")
    pairs = written(_listed_pairs(held.filter(F.col("holders") <= LISTED)), "pairs")
    hot = written(held.filter(F.col("holders") > LISTED).select("key", "class"), "hot-keys")
    classes = pairs.select("a").union(pairs.select("b")).union(hot.select(F.col("class").bitwiseAND(F.lit(~3))))
    sets = needed_sets(texts, written(classes.toDF("class").distinct(), "classes"))
    links = verified_pairs(pairs, sets, percent).union(family_links(hot, sets, percent))
    joined = written(components(links), "components")
    least = base.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("own"))
    named = least.join(joined.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    named = written(named, "classes-with-roots")
    groups = joined.select("root").distinct().join(named, "root").groupBy("root").agg(F.min("own").alias("group"))
    final = written(named.join(groups, "root", "left").select("class", F.coalesce("group", "own").alias("component")), "class-components")
    out = base.join(final, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select(F.col("doc_id").alias(doc_id), "n_shingles", component.alias("component_id"), "class")
