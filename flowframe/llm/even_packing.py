"""Pack tokens into windows of nearly equal length by multiway differencing.

Documents become token ids and an end id. One longer than a window gives whole windows and
a rest. Rests and shorter documents fall into groups of bounded size by a hash, and each
group is dealt to hardly more windows than could hold it:

* Each piece begins as a partition that has it in one window and nothing in the others.
* The two partitions with the largest spread are merged, the fullest window of one with
  the emptiest of the other, so that their imbalances oppose each other, until one is left.
* While a window holds more than allowed, the number of windows rises by one, and off the
  longest piece of each such window come small ones that begin with what is too much and
  get half as long each time, which leaves less imbalance.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.base import pieces

#: Pieces of a group on average, texts encoded at a time, and the smallest piece that is cut off on purpose.
GROUP, TEXTS, SLIVER = 512, 128, 8
#: Words after which the older half of those kept is forgotten, and the longest of them; characters from which a part is cut further.
WORDS, WORD_CHARS, SLICE_CHARS = 600_000, 64, 10_000

# The byte-level pattern for words of printable ASCII, line feeds and the letters of Latin-1, and the
# characters that stand for bytes which are not printable there.
COMMON = re.compile("[!-~\nÀ-ÖØ-öø-ÿ]+").fullmatch
MATCHES = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^ \nA-Za-z0-9À-ÖØ-öø-ÿ]+|[ \n]+(?![^ \n])|[ \n]+"
).findall
HIDDEN = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
LETTERS = {byte: 256 + k for k, byte in enumerate(HIDDEN)}

#: White space before a space, and a space after anything else.
BLANKS, SPACE, LONG = re.compile(r"\s "), re.compile(r"(?<=\S) "), re.compile(r"(?<=\S)(?=\s)")
ASCII_BLANKS = [f"{chr(code)} " for code in (*range(9, 14), *range(28, 33))]

Window = list[tuple[int, int, int]]


def difference(lengths: list[int], windows: int) -> list[list[int]]:
    """Item numbers per window: Karmarkar-Karp differencing into so many parts.

    A partition is the lengths of its windows less the shortest, longest first; windows
    that are still empty are left out. What stands in a window is a tree, as merging two
    windows makes one of both.
    """
    left, right = [-1] * len(lengths), [-1] * len(lengths)
    heap = [(-length, i, [length], [i]) for i, length in enumerate(lengths)]
    heapq.heapify(heap)
    tie = len(heap)
    while len(heap) > 1:
        _, _, a, at_a = heapq.heappop(heap)
        _, _, b, at_b = heapq.heappop(heap)
        shared = len(a) + len(b) - windows
        if shared <= 0 and len(b) == 1 and b[0] <= a[-1]:
            # The common case at first: one more window that is the shortest so far.
            a.append(b[0])
            at_a.append(at_b[0])
            sums, nodes = a, at_a
        else:
            a, b, at_a, at_b = map(np.asarray, (a, b, at_a, at_b))
            if shared <= 0:
                sums, nodes = np.concatenate([a, b]), np.concatenate([at_a, at_b])
            else:
                # The last of one meet the last of the other in opposite order; what is left over meets empty windows.
                alone_a, alone_b = len(a) - shared, len(b) - shared
                met = np.arange(len(left), len(left) + shared)
                left += at_a[alone_a:].tolist()
                right += at_b[alone_b:][::-1].tolist()
                sums = np.concatenate([a[:alone_a], b[:alone_b], a[alone_a:] + b[alone_b:][::-1]])
                nodes = np.concatenate([at_a[:alone_a], at_b[:alone_b], met])
            order = np.argsort(-sums, kind="stable")
            sums, nodes = sums[order], nodes[order]
            if len(sums) < windows:
                sums, nodes = sums.tolist(), nodes.tolist()
        if len(sums) == windows:
            sums = np.asarray(sums) - sums[-1]
        heapq.heappush(heap, (-int(sums[0]), tie, sums, nodes))
        tie += 1
    out = []
    for node in np.asarray(heap[0][3]).tolist() if heap else []:
        held, stack = [], [node]
        while stack:
            x = stack.pop()
            if right[x] < 0:
                held.append(x)
            else:
                stack += [left[x], right[x]]
        out.append(sorted(held))
    return out


def even_windows(lengths: list[int], capacity: int) -> list[Window]:
    """Windows of (item, start, length) with at most ``capacity`` units each, of nearly equal length."""
    parts = [(i, at, min(length - at, capacity)) for i, length in enumerate(lengths) for at in range(0, length, capacity)]
    # With a little room in each: windows that must all be full are out of reach.
    windows = pieces(sum(lengths), capacity - capacity // 256)
    while True:
        held = difference([p[2] for p in parts], windows)
        exceeded = [(sum(parts[i][2] for i in window) - capacity, window) for window in held]
        exceeded = [(excess, window) for excess, window in exceeded if excess > 0]
        if not exceeded:
            return [_joined(parts[i] for i in window) for window in held]
        windows += 1
        for excess, window in exceeded:
            longest = max(window, key=lambda i: (parts[i][2], -i))
            item, start, length = parts[longest]
            off = min(length // 2, max(excess, SLIVER))
            while off >= min(SLIVER, length):
                length -= off
                parts.append((item, start + length, off))
                off //= 2
            parts[longest] = (item, start, length)


def _joined(parts) -> Window:
    """The parts of a window by item and start; those that follow each other are one."""
    out: Window = []
    for item, start, length in sorted(parts):
        if out and out[-1][0] == item and sum(out[-1][1:]) == start:
            out[-1] = (item, out[-1][1], out[-1][2] + length)
        else:
            out.append((item, start, length))
    return out


def _single_spaces(text: str) -> bool:
    """Whether no space follows white space."""
    if text.isascii():
        return not any(pair in text for pair in ASCII_BLANKS)
    return BLANKS.search(text) is None


def id_width(path: str, end_id: int) -> int:
    """Bytes that hold every id of a tokenizer, and the end id."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(path).get_vocab_size() - 1, end_id) < 1 << 16 else 4


class Encoder(dict):
    """Token ids of whole texts as little-endian unsigned integers of ``width`` bytes.

    A space after any other character than white space always begins a new match of the
    tokenizer's pattern, so what stands between such spaces is encoded on its own. As a
    dictionary it holds the ids of the words met of late, a space before each. New ones of
    common characters are cut by the pattern here and only their new parts go to the
    tokenizer's model; any other goes through the whole tokenizer.
    """

    def __init__(self, path: str, width: int = 4):
        from tokenizers import Tokenizer, models, pre_tokenizers

        super().__init__()
        self.kind, self.code = f"<u{width}", {2: "H", 4: "I"}[width]
        self.tokenizer = Tokenizer.from_file(path)
        plain = self.tokenizer.pre_tokenizer
        if not isinstance(plain, pre_tokenizers.ByteLevel) or plain.add_prefix_space or not plain.use_regex:
            raise ValueError("the tokenizer must cut texts by the byte-level pattern")
        if not isinstance(self.tokenizer.model, models.BPE) or self.tokenizer.normalizer is not None:
            raise ValueError("the tokenizer must merge bytes as they are")
        # Names of special tokens in a text are ordinary text.
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.older: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        """The ids of a match of the pattern."""
        if part.isascii():
            letters = part.replace(" ", "Ġ").replace("\n", "Ċ")
        else:
            letters = part.encode().decode("latin-1").translate(LETTERS)
        return array(self.code, [token.id for token in self.model.tokenize(letters)]).tobytes()

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self._new(word)
        if len(word) <= WORD_CHARS:
            self[word] = found
        return found

    def _new(self, word: str) -> bytes:
        if len(word) > WORD_CHARS or not COMMON(word):
            return self.whole(f" {word}")
        if word.isalpha():
            return self._part(f" {word}")
        ids = []
        for part in MATCHES(f" {word}"):
            known = self.parts.get(part)
            if known is None:
                known = self.parts[part] = self._part(part)
            ids.append(known)
        return b"".join(ids)

    def whole(self, part: str) -> bytes:
        """A part of a text through the tokenizer; a long one is cut at white space after something else."""
        slices = LONG.split(part) if len(part) > SLICE_CHARS else [part]
        ids = (self.tokenizer.encode_batch_fast([one], add_special_tokens=False)[0].ids for one in slices)
        return b"".join(np.array(one, dtype=self.kind).tobytes() for one in ids)

    def encode(self, text: str) -> bytes:
        if len(self) > WORDS:
            self.older = dict(self)
            self.clear()
        if len(self.parts) > WORDS:
            self.parts = {}
        first, *words = text.split(" ") if _single_spaces(text) else SPACE.split(text)
        return self.whole(first) + b"".join(map(self.__getitem__, words))


#: One encoder per file and worker process, so that its words last for more than one task.
_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder_of(path: str, width: int) -> Encoder:
    if (path, width) not in _ENCODERS:
        _ENCODERS[path, width] = Encoder(path, width)
    return _ENCODERS[path, width]


def _cut(path: str, capacity: int, end_id: int, width: int):
    """Tokens of each document in whole windows and a rest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, width)
        end, step = end_id.to_bytes(width, "little"), width * capacity
        met: dict[int, int] = {}
        for batch in batches:
            for low in range(0, batch.num_rows, TEXTS):
                some = batch.slice(low, TEXTS)
                keys = some.column("key")
                names = keys.to_pylist()
                rows, starts, whole, data, copies = [], [], [], [], []
                for row, text in enumerate(some.column("text").to_pylist()):
                    ids = encoder.encode(text or "") + end
                    # Rows that are equal are told apart by their number in the task, so that they may go to many groups.
                    name = zlib.crc32(repr(names[row]).encode()) << 32 | zlib.crc32(ids)
                    met[name] = met.get(name, -1) + 1
                    for at in range(0, len(ids), step):
                        rows.append(row)
                        starts.append(at // width)
                        whole.append(len(ids) // width)
                        data.append(ids[at:at + step])
                        copies.append(met[name])
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(whole, pa.int64()),
                     pa.array(data, pa.binary()), pa.array(copies, pa.int64())],
                    names=["key", "start", "doc_tokens", "ids", "copy"],
                )

    return cut


def _dealt(capacity: int, width: int):
    def deal(table: pa.Table) -> pa.Table:
        group = table["group"][0].as_py()
        keys, starts, whole, ids, copies = (table[c].to_pylist() for c in ("key", "start", "doc_tokens", "ids", "copy"))
        order = sorted(range(len(ids)), key=lambda i: (-len(ids[i]), zlib.crc32(ids[i]), starts[i], whole[i], repr(keys[i]), copies[i]))
        full = [i for i in order if len(ids[i]) == width * capacity]
        rest = order[len(full):]
        windows = [[(i, 0, capacity)] for i in full]
        windows += [[(rest[i], at, n) for i, at, n in window] for window in even_windows([len(ids[i]) // width for i in rest], capacity)]
        rows, columns = [], [[] for _ in range(6)]
        for k, window in enumerate(windows):
            offset = 0
            for i, at, n in window:
                part = np.frombuffer(ids[i], dtype=f"<u{width}", count=n, offset=width * at)
                rows.append(i)
                for column, x in zip(columns, (starts[i] + at, n, part.astype("<u4").tobytes(), whole[i], (group << 32) + k, offset), strict=True):
                    column.append(x)
                offset += n
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        key = table["key"].combine_chunks().take(pa.array(rows, pa.int64()))
        return pa.table([key, *(pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True))], names=["key", *RESULTS])

    return deal


RESULTS = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def pack_even(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 0) -> DataFrame:
    """One row per piece: the key, its ``start``, ``length`` and ``ids`` (little-endian
    unsigned 32-bit) in its document, the document's ``doc_tokens``, and its ``offset`` in
    the window ``sequence_id``.

    ``tokenizer`` is a file of the tokenizers library with a byte-level pattern; names of
    special tokens in a text are ordinary text. Each document ends with ``end_id``; a null
    text counts as empty, so it is that id alone. Every id lies in exactly one piece, and
    the pieces of a window lie one after the other from offset 0. Keys may be null or
    repeated; equal rows are packed each. Groups are packed on their own; a task holds one
    group of pieces, or the longest run of a text without white space while it is encoded.
    """
    if capacity < 1:
        raise ValueError("a window holds at least one token")
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    groups = pieces(max(size["n"], (size["bytes"] or 0) // (2 * capacity)), GROUP)
    kind = rows.schema["key"].dataType.simpleString()
    width = id_width(tokenizer, end_id)
    cut = rows.mapInArrow(_cut(tokenizer, capacity, end_id, width), f"key {kind}, start long, doc_tokens long, ids binary, copy long")
    group = F.pmod(F.xxhash64("key", F.crc32("ids"), "doc_tokens", "start", "copy"), F.lit(groups))
    dealt = cut.withColumn("group", group).groupBy("group").applyInArrow(
        _dealt(capacity, width), f"key {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
    return dealt.withColumnRenamed("key", key)
