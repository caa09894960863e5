"""Collocations by direct-address tiles of frequency ranks.

1. Tasks turn texts into blocks of word numbers, a vocabulary per block and language.
2. Words that occur often enough are ranked by frequency in their language, and each block
   takes the ranks in place of its own numbers.
3. Neighbouring ranks (i, j) fall into tiles of ``SIDE`` x ``SIDE``. The tiles of the first
   ``HEAD`` rows and columns, where most pairs lie, are counted by ``numpy.bincount`` with
   the place in the tile as the address; all others as sorted coordinates with counts,
   dealt to buckets by a hash. Counts of a tile are added up over at most ``FAN`` blocks at
   a time, so no task takes more than a tile's cells and ``FAN`` lists.
4. Frequent pairs are ranked by frequency in turn, the owners of tiles return to each block
   the ranks of the pairs it has, and (pair, next word) is tiled and counted in the same
   way. Only where both pairs of three words are frequent can the three be.
5. Candidates are scored in exact integers, and dropped where a longer one holds them.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.base import pieces, written
from flowframe.plans.ordered import number_groups

#: Words of a block, cells of a tile's side, tiles of the dense head in each direction, lists merged at a time.
BLOCK, SIDE, HEAD, FAN = 1_000_000, 1_024, 4, 64
#: Texts taken from a batch and bytes of a text cut into words at a time, and vocabulary rows sent at a time.
TEXTS, SLICE, ROWS = 256, 1 << 20, 50_000
#: Blocks that share a bucket: the bucket's pairs are about those of so many blocks that lie outside of the head.
SHARED = 4
#: Ranked words that are broadcast: at most 1 million rows of some 40 bytes.
FEW_RANKS = 1_000_000

# What ends a piece of text, and what parts words in it besides the space.
ENDS, TAB = b".,;:!?\n\x0b\x0c\r", b"\t"
PLAIN = bytes.maketrans(ENDS + TAB, b"." * len(ENDS) + b" ")

BLOCKS = "block long, lang string, ids binary, local int, word string, n long"


def words_of(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, ``.`` between pieces, some at a time."""
    marked = data.lower().translate(PLAIN).replace(b".", b" . ")
    at = 0
    while at < len(marked):
        to = marked.find(b" ", at + SLICE)
        to = len(marked) if to < 0 else to
        yield marked[at:to].split()
        at = to


class _Vocabulary(defaultdict):
    """Words numbered as they come; 0 is the end of a piece."""

    def __init__(self):
        super().__init__()
        self.default_factory = self.__len__
        self[b"."]


def _blocks(block_words: int):
    """Blocks of word numbers and their vocabularies.

    A block that begins within a text begins with the two words before it; ``n`` of its
    row says how many words were counted already.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, size = TaskContext.get().partitionId() << 32, 0
        words: dict[str, _Vocabulary] = defaultdict(_Vocabulary)
        texts: dict[str, array] = defaultdict(lambda: array("I"))
        carried: dict[str, int] = {}

        def flush():
            for lang, held in texts.items():
                ids = np.frombuffer(held, dtype=np.uint32)
                begun = carried.get(lang, 0)
                counts = np.bincount(ids[begun:], minlength=len(words[lang]))
                names = pa.array([w.decode() for w in words[lang]], pa.string())
                for low in range(1, len(names), ROWS):
                    local = np.arange(low, min(low + ROWS, len(names)))
                    yield _rows(block, lang, len(local), local=pa.array(local, pa.int32()), word=names.slice(low, len(local)), n=pa.array(counts[local], pa.int64()))
                yield _rows(block, lang, 1, ids=pa.array([pack(ids.astype(np.int64))], pa.binary()), n=pa.array([begun], pa.int64()))

        for batch in (whole.slice(low, TEXTS) for whole in batches for low in range(0, whole.num_rows, TEXTS)):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for some in words_of((text or "").encode()):
                    if size >= block_words:
                        yield from flush()
                        names = list(words[lang])
                        tail = [names[i] for i in texts[lang][-2:]]
                        words.clear()
                        texts.clear()
                        carried.clear()
                        block, size, carried[lang] = block + 1, 0, len(tail)
                        some = tail + some
                    texts[lang].extend(map(words[lang].__getitem__, some))
                    size += len(some)
                texts[lang].append(0)
                size += 1
        if texts:
            yield from flush()

    return encode


def _rows(block: int, lang: str, rows: int, **columns) -> pa.RecordBatch:
    kinds = {"ids": pa.binary(), "local": pa.int32(), "word": pa.string(), "n": pa.int64()}
    given = [columns[name] if name in columns else pa.nulls(rows, kind) for name, kind in kinds.items()]
    both = [pa.array(np.full(rows, block), pa.int64()), pa.array([lang] * rows, pa.string())]
    return pa.RecordBatch.from_arrays([*both, *given], names=["block", "lang", *kinds])


def _mixed(codes: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket for each code, by multiplication."""
    return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets


def tiles(left: np.ndarray, right: np.ndarray, known: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The pairs of a block by tile: its number, codes in it and counts.

    Tiles of the head have numbers from 0 and places in the tile as codes; buckets of all
    others have numbers below 0 and codes of the whole pair. Of the first ``known`` pairs
    only the codes come out, as they were counted before.
    """
    fits = (left >= 0) & (right >= 0)
    before = np.flatnonzero(fits[:known])
    head = fits & (left < HEAD * SIDE) & (right < HEAD * SIDE)
    i, j = left[head], right[head]
    tile, place = (i // SIDE) * HEAD + j // SIDE, (i % SIDE) * SIDE + j % SIDE
    again = place[:np.count_nonzero(head[:known])], tile[:np.count_nonzero(head[:known])]
    order = np.argsort(tile, kind="stable")
    tile, place = tile[order], place[order]
    cuts = np.searchsorted(tile, np.arange(HEAD * HEAD + 1))
    for k in range(HEAD * HEAD):
        if cuts[k] < cuts[k + 1]:
            counts = np.bincount(place[cuts[k]:cuts[k + 1]], minlength=SIDE * SIDE)
            codes = np.flatnonzero(counts)
            counts = counts[codes]
            for code in again[0][again[1] == k]:
                counts[np.searchsorted(codes, code)] -= 1
            yield k, codes, counts
    rest = fits & ~head
    codes, counts = np.unique((left[rest] << 32) | right[rest], return_counts=True)
    for at in before:
        if rest[at]:
            counts[np.searchsorted(codes, (left[at] << 32) | right[at])] -= 1
    bucket = _mixed(codes, buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, codes, counts = bucket[order], codes[order], counts[order]
    for low, high in zip(*_runs(bucket)):
        yield -1 - int(bucket[low]), codes[low:high], counts[low:high]


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of equal values begin and end."""
    if not len(values):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    low = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return low, np.append(low[1:], len(values))


def merged(tile: int, lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of one tile, added up."""
    if tile >= 0:
        cells = np.zeros(SIDE * SIDE, dtype=np.int64)
        seen = np.zeros(SIDE * SIDE, dtype=bool)
        for codes, counts in lists:
            cells[codes] += counts
            seen[codes] = True
        codes = np.flatnonzero(seen)
        return codes, cells[codes]
    codes, counts = np.concatenate([c for c, _ in lists]), np.concatenate([n for _, n in lists])
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    low, _ = _runs(codes)
    return codes[low], np.add.reduceat(counts, low) if len(low) else counts


def whole_codes(tile: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two ranks of codes of a tile."""
    if tile < 0:
        return codes >> 32, codes & 0xFFFFFFFF
    row, column = divmod(tile, HEAD)
    return row * SIDE + codes // SIDE, column * SIDE + codes % SIDE


def pack(numbers: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers, compressed; rising ones as their differences."""
    numbers = np.diff(numbers, prepend=0) if rising else numbers
    wide = len(numbers) > 0 and (int(numbers.max()) >= 1 << 31 or int(numbers.min()) < -(1 << 31))
    data = numbers.astype("<i8" if wide else "<i4").tobytes()
    head = (len(data) << 2 | wide << 1 | rising).to_bytes(8, "little")
    return head + pa.Codec("zstd", 1).compress(data, asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    head = int.from_bytes(data[:8], "little")
    whole = pa.Codec("zstd", 1).decompress(data[8:], decompressed_size=head >> 2, asbytes=True)
    numbers = np.frombuffer(whole, dtype="<i8" if head & 2 else "<i4").astype(np.int64)
    return np.cumsum(numbers) if head & 1 else numbers


TILES = "block long, lang string, words binary, known long, tile long, codes binary, counts binary"


def _level_rows(block: int, lang: str, left: np.ndarray, words: np.ndarray, known: int, longest: int, buckets: int, keep: bool) -> pa.Table:
    """A block's tiles of (symbol, word after it), and its words themselves if they are needed again."""
    right = np.full(len(words), -1, dtype=np.int64)
    if len(words) > longest:
        right[:-longest] = words[longest:]
    if longest > 1:
        # The pairs of three words share one, and both must be frequent.
        right[:-1][left[1:] < 0] = -1
    found = list(tiles(left, right, max(0, known - longest), buckets))
    own = [pack(words)] if keep else []
    none = [None] * len(own)
    rows = len(own) + len(found)
    return pa.table(
        [
            pa.array([block] * rows, pa.int64()), pa.array([lang] * rows, pa.string()), pa.array(own + [None] * len(found), pa.binary()),
            pa.array([known] * len(own) + [None] * len(found), pa.int64()), pa.array(none + [t for t, _, _ in found], pa.int64()),
            pa.array(none + [pack(c, True) for _, c, _ in found], pa.binary()), pa.array(none + [pack(n) for _, _, n in found], pa.binary()),
        ],
        names=["block", "lang", "words", "known", "tile", "codes", "counts"],
    )


def _bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ranks of a block's words, as many rows together as came together."""
    for batch in batches:
        blocks, local, rank = (batch.column(c).to_numpy() for c in ("block", "local", "rank"))
        _, lang = np.unique(batch.column("lang").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        order = np.lexsort((local, lang, blocks))
        low, high = _runs(blocks[order] * (int(lang.max(initial=0)) + 1) + lang[order])
        first = pa.array(order[low], pa.int64())
        parts = [order[a:b] for a, b in zip(low, high)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("block").take(first), batch.column("lang").take(first), pa.array([pack(local[p].astype(np.int64), True) for p in parts], pa.binary()),
             pa.array([pack(rank[p]) for p in parts], pa.binary())],
            names=["block", "lang", "local", "rank"],
        )


def _ranked_words(buckets: int):
    def take(texts: pa.Table, ranks: pa.Table) -> pa.Table:
        block, lang = texts["block"][0].as_py(), texts["lang"][0].as_py()
        ids = unpack(texts["ids"][0].as_py())
        table = np.full(int(ids.max()) + 1, -1, dtype=np.int64)
        for local, rank in zip(ranks["local"].to_pylist(), ranks["rank"].to_pylist(), strict=True):
            table[unpack(local)] = unpack(rank)
        words = table[ids]
        return _level_rows(block, lang, words, words, texts["n"][0].as_py(), 1, buckets, True)

    return lambda texts, ranks: take(texts, ranks) if texts.num_rows else pa.Table.from_batches([], _schema(TILES))


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _ranked_pairs(buckets: int):
    """The next level of a block: its symbols are the ranks of its frequent pairs."""

    def take(texts: pa.Table, found: pa.Table) -> pa.Table:
        block, lang = texts["block"][0].as_py(), texts["lang"][0].as_py()
        words = unpack(texts["words"][0].as_py())
        right = np.append(words[1:], -1)
        codes = (words << 32) | right
        codes[(words < 0) | (right < 0)] = -1
        symbols = np.full(len(words), -1, dtype=np.int64)
        names = np.concatenate([np.zeros(0, dtype=np.int64), *map(unpack, found["codes"].to_pylist())])
        if len(names):
            ranks = np.concatenate([unpack(x) for x in found["ranks"].to_pylist()])
            order = np.argsort(names)
            names, ranks = names[order], ranks[order]
            at = np.minimum(np.searchsorted(names, codes), len(names) - 1)
            symbols = np.where(names[at] == codes, ranks[at], -1)
        return _level_rows(block, lang, symbols, words, texts["known"][0].as_py(), 2, buckets, False)

    return lambda texts, found: take(texts, found) if texts.num_rows else pa.Table.from_batches([], _schema(TILES))


def _merge(table: pa.Table) -> pa.Table:
    tile = table["tile"][0].as_py()
    lists = [(unpack(c), unpack(n)) for c, n in zip(table["codes"].to_pylist(), table["counts"].to_pylist(), strict=True)]
    codes, counts = merged(tile, lists)
    return pa.table(
        [table["lang"].slice(0, 1), table["tile"].slice(0, 1), table["share"].slice(0, 1), pa.array([pack(codes, True)], pa.binary()), pa.array([pack(counts)], pa.binary())],
        names=["lang", "tile", "share", "codes", "counts"],
    )


def _frequent(least: int):
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, tile, codes, counts in zip(*(batch.column(c).to_pylist() for c in ("lang", "tile", "codes", "counts")), strict=True):
                codes, counts = unpack(codes), unpack(counts)
                often = counts >= least
                i, j = whole_codes(tile, codes[often])
                n = len(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n, pa.string()), pa.array(np.full(n, tile), pa.int64()), pa.array(codes[often], pa.int64()),
                     pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array(counts[often], pa.int64())],
                    names=["lang", "tile", "code", "i", "j", "a"],
                )

    return pick


def frequent_pairs(level: DataFrame, blocks: int, least: int) -> DataFrame:
    """``lang``, ``tile``, ``code``, ranks ``i`` and ``j`` and count ``a`` of pairs that occur ``least`` times or more."""
    lists = level.filter("tile is not null").select("lang", "tile", "block", "codes", "counts")
    lang_and_tile = ["lang", "tile"]
    merged_lists = "lang string, tile long, share long, codes binary, counts binary"
    # Buckets are of bounded size as they are; the tiles of the head are added up in a tree first.
    head, key, shares = lists.filter("tile >= 0"), F.col("block"), blocks
    while shares > FAN:
        shares = pieces(shares, FAN)
        head = head.withColumn("share", F.pmod(F.xxhash64(key), F.lit(shares))).groupBy(*lang_and_tile, "share").applyInArrow(_merge, merged_lists)
        key = F.col("share")
    kept = [*lang_and_tile, "codes", "counts"]
    both = head.select(*kept).unionByName(lists.filter("tile < 0").select(*kept)).withColumn("share", F.lit(0).cast("long"))
    whole = both.groupBy(*lang_and_tile).applyInArrow(_merge, merged_lists)
    return whole.mapInArrow(_frequent(least), "lang string, tile long, code long, i long, j long, a long")


def _returned(lists: pa.Table, frequent: pa.Table) -> pa.Table:
    """To each block of a tile the ranks of the frequent pairs it has."""
    out = []
    if lists.num_rows and frequent.num_rows:
        tile = lists["tile"][0].as_py()
        codes, ranks = frequent["code"].to_numpy(), frequent["rank"].to_numpy()
        order = np.argsort(codes)
        codes, ranks = codes[order], ranks[order]
        for block, lang, own in zip(*(lists[c].to_pylist() for c in ("block", "lang", "codes")), strict=True):
            own = unpack(own)
            at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
            hit = codes[at] == own
            i, j = whole_codes(tile, own[hit])
            out.append((block, lang, pack((i << 32) | j, True), pack(ranks[at[hit]])))
    return pa.Table.from_pylist([dict(zip(("block", "lang", "codes", "ranks"), x)) for x in out], _schema("block long, lang string, codes binary, ranks binary"))


def by_rank(counted: DataFrame, count: str, names: list[str]) -> DataFrame:
    """``rank`` from 0 in each language, most frequent first."""
    placed = number_groups(counted.withColumn("__less", -F.col(count)), ["lang"], ["__less", *names])
    return placed.withColumn("rank", F.col("position") - 1).drop("__less", "position", "group_start", "group_pos")


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lowest-scoring cut of each candidate, in integers of any size."""
    for batch in batches:
        cuts = []
        for a, sides in zip(batch.column("a").to_pylist(), batch.column("cuts").to_pylist(), strict=True):
            scores = [1_000_000 * a * a // (side["l"] * side["r"]) for side in sides]
            k = scores.index(min(scores))
            cuts.append((sides[k]["l"], sides[k]["r"], scores[k]))
        rest = [pa.array([c[k] for c in cuts], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("lang", "phrase", "a", "n")), *rest], names=["lang", "phrase", "a", "n", "l", "r", "score"])


def _apart(df: DataFrame) -> DataFrame:
    """The frame under names of its own, so that it can meet another that was made from the same rows."""
    return df.select([F.col(c).alias(c) for c in df.columns])


def _tagged(df: DataFrame, tag: str) -> DataFrame:
    return df.select([F.col(c).alias(f"{tag}_{c}") for c in df.columns])


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 10, cover: int = 50, block_words: int = BLOCK) -> DataFrame:
    """Phrases of two and three words that occur ``least`` times or more in their language,
    with count ``a``, the counts ``l`` and ``r`` of both sides of the lowest-scoring cut,
    the language's words ``n`` and ``score`` = floor(1000000 * a * a / (l * r)).

    A-Z are lower-cased. Texts end, and are cut, at ``.,;:!?`` and line ends; words lie
    between spaces and tabs. Null texts count as empty, null languages as ``und``. Left out
    is a phrase that a longer one holds which occurs at least ``cover`` percent as often.
    Other columns are not read. Repeated rows count each. A task holds one block of words,
    so a text of any length is cut into blocks; phrases across their borders count.
    """
    rows = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    blocks = written(rows.mapInArrow(_blocks(block_words), BLOCKS), "blocks")
    texts = blocks.filter("ids is not null").select("block", "lang", "ids", "n")
    vocabulary = blocks.filter("word is not null").select("block", "lang", "local", "word", "n")
    number = max(1, texts.agg(F.count_distinct("block")).first()[0])
    buckets = pieces(number, SHARED)

    counted = written(vocabulary.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = written(by_rank(counted.filter(F.col("n") >= least), "n", ["word"]), "ranks")
    # Ranks are sent to all tasks while they are few; else Spark shuffles both sides.
    names = ranked.select("lang", "word", "rank")
    names = F.broadcast(names) if names.count() <= FEW_RANKS else names
    local = vocabulary.select("block", "lang", "local", "word").join(names, ["lang", "word"])
    local = local.select("block", "lang", "local", "rank").mapInArrow(_bundled, "block long, lang string, local binary, rank binary")
    first = written(
        _apart(texts).groupBy("block", "lang").cogroup(_apart(local.select("block", "lang", "local", "rank")).groupBy("block", "lang"))
        .applyInArrow(_ranked_words(buckets), TILES), "pairs-of-words",
    )
    pairs = written(by_rank(frequent_pairs(first, number, least), "a", ["i", "j"]), "pairs")

    # Tiles of the head lie in many blocks, so each share of the blocks gets the tile's frequent pairs.
    shares = pieces(number, FAN)
    share = F.when(F.col("tile") < 0, F.lit(0)).otherwise(F.pmod(F.xxhash64("block"), F.lit(shares))).cast("long")
    asked = first.filter("tile is not null").select("block", "lang", "tile", "codes", share.alias("share"))
    copies = F.explode(F.when(F.col("tile") < 0, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))
    answers = pairs.select("lang", "tile", "code", "rank", copies.alias("share"))
    keys = ["lang", "tile", "share"]
    told = _apart(asked).groupBy(*keys).cogroup(_apart(answers).groupBy(*keys)).applyInArrow(_returned, "block long, lang string, codes binary, ranks binary")
    symbols = first.filter("words is not null").select("block", "lang", "words", "known")
    second = _apart(symbols).groupBy("block", "lang").cogroup(_apart(told).groupBy("block", "lang")).applyInArrow(_ranked_pairs(buckets), TILES)
    triples = written(frequent_pairs(written(second, "pairs-of-pairs"), number, least).select("lang", F.col("i").alias("pair"), F.col("j").alias("k"), "a"), "triples")

    words = ranked.select("lang", F.col("rank").alias("w"), "word", F.col("n").alias("f"))
    named = pairs.select("lang", F.col("rank").alias("pair"), "i", "j", "a")
    one, two, three = (_tagged(words, t) for t in ("one", "two", "three"))
    twos = named.join(one, (F.col("lang") == F.col("one_lang")) & (F.col("i") == F.col("one_w")))
    twos = written(
        twos.join(two, (F.col("lang") == F.col("two_lang")) & (F.col("j") == F.col("two_w"))).select(
            "lang", "pair", "i", "j", "a", F.col("one_word").alias("u"), F.col("two_word").alias("v"), F.col("one_f").alias("fu"), F.col("two_f").alias("fv")
        ), "twos",
    )
    begin, end = _tagged(twos.select("lang", "pair", "j", "a", "u", "v", "fu"), "b"), _tagged(twos.select("lang", "i", "j", "a"), "e")
    held = triples.join(begin, (F.col("lang") == F.col("b_lang")) & (F.col("pair") == F.col("b_pair")))
    held = held.join(end, (F.col("lang") == F.col("e_lang")) & (F.col("b_j") == F.col("e_i")) & (F.col("k") == F.col("e_j")))
    held = held.join(three, (F.col("lang") == F.col("three_lang")) & (F.col("k") == F.col("three_w")))

    def cut(left: str, right: str):
        return F.struct(F.col(left).alias("l"), F.col(right).alias("r"))

    longer = held.select("lang", F.concat_ws(" ", "b_u", "b_v", "three_word").alias("phrase"), "a", F.array(cut("b_fu", "e_a"), cut("b_a", "three_f")).alias("cuts"))
    inside = held.select("lang", F.col("pair").alias("in"), "a").unionByName(
        held.join(_tagged(named, "s"), (F.col("lang") == F.col("s_lang")) & (F.col("b_j") == F.col("s_i")) & (F.col("k") == F.col("s_j")))
        .select("lang", F.col("s_pair").alias("in"), "a")
    )
    most = _tagged(inside.groupBy("lang", "in").agg(F.max("a").alias("a")), "most")
    covered = (F.col("lang") == F.col("most_lang")) & (F.col("pair") == F.col("most_in")) & (100 * F.col("most_a") >= cover * F.col("a"))
    shorter = twos.join(most, covered, "left_anti").select("lang", F.concat_ws(" ", "u", "v").alias("phrase"), "a", F.array(cut("fu", "fv")).alias("cuts"))
    every = shorter.unionByName(longer).join(totals, "lang")
    return every.mapInArrow(_scored, "lang string, phrase string, a long, n long, l long, r long, score long")


def best(found: DataFrame, most: int) -> DataFrame:
    """The first ``most`` phrases of each language by score, count and name, with ``rank`` from 1."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
