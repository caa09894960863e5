"""Byte-level BPE: a lazily built transducer encodes, an incremental UTF-8 machine decodes.

The merges of a rank file define one last token for every prefix of a byte string:
the token at whose start the prefix's own last token does not merge with it. So the
encoder is a deterministic machine. Its state lists the places where a token may
still be growing: the last token before each and the node of the vocabulary's tree
reached since. States and moves are made when first needed. A move tells the last
token of the prefix read so far; a token goes out as soon as all growing places agree
on it, which is at most a few token lengths later.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bounds on what a worker remembers; when full, it forgets and goes on.
STATES = 250_000
WORDS = 150_000

NONE = -1
#: Ids of a vocabulary have fewer bits than this.
ID_BITS = 24


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merge(ranks: dict[bytes, int], data: bytes, until: int = 1) -> list[bytes]:
    """Merge the pair of lowest rank, leftmost first, until none is left or ``until`` parts are."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > until:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return parts


class Transducer:
    """Encodes byte strings by a vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.text = {rank: token for token, rank in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [NONE]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token.append(NONE)
                node = self.children[node][byte]
            self.token[node] = rank
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.forget()

    def forget(self) -> None:
        self.apart: dict[tuple[int, int], bool] = {}
        self.ids = {(NONE, 0): 0}
        self.states: list[tuple[int, ...]] = [(NONE, 0)]
        # (state, byte) -> (next state, last token), each pair packed into one number.
        self.moves: dict[int, int] = {}

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte, or if merging never gives it."""
        if token not in self.halves:
            parts = merge(self.ranks, self.text[token], 2)
            self.halves[token] = tuple(self.ranks[x] for x in parts) if len(parts) == 2 else None  # type: ignore[assignment]
        return self.halves[token]

    def _reachable(self, token: int) -> bool:
        return len(self.text[token]) == 1 or self._halves(token) is not None

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether merging leaves a border between these two neighbours.

        Merges are undone from the last one on. At each step the two tokens at the
        border must not merge before the next larger merge on either side happens.
        """
        before = 1 << 60
        while True:
            joined = self.ranks.get(self.text[left] + self.text[right])
            if joined is not None and joined < before:
                return False
            split_left, split_right = self._halves(left), self._halves(right)
            if split_left and (left > right or not split_right):
                before, left = left, split_left[1]  # the left side's merge wins a tie of ranks: it comes first
            elif split_right:
                before, right = right + 1, split_right[0]
            else:
                return True

    def _fits(self, last: int, token: int) -> bool:
        if last == NONE:
            return self._reachable(token)
        key = (last, token)
        if key not in self.apart:
            self.apart[key] = self._reachable(token) and self._stay_apart(last, token)
        return self.apart[key]

    def _move(self, state: int, byte: int) -> int:
        growing, found = [], NONE
        places = iter(self.states[state])
        for last, node in zip(places, places, strict=True):
            node = self.children[node].get(byte, NONE)
            if node == NONE:
                continue
            if found == NONE and self.token[node] != NONE and self._fits(last, self.token[node]):
                found = self.token[node]
            if self.children[node]:
                growing += (last, node)
        key = (*growing, found, 0)
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
        self.moves[state << 8 | byte] = move = self.ids[key] << ID_BITS | found
        return move

    def encode(self, data: bytes) -> list[int]:
        """The tokens of one match of the pattern, the whole vocabulary entry first if there is one."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        lasts: list[int] = []
        self._read(0, data, lasts)
        return self._back(lasts, len(lasts))

    def _read(self, state: int, data: bytes, lasts: list[int]) -> int:
        if state == 0 and len(self.states) > STATES:
            self.forget()
        moves, mask = self.moves.get, (1 << ID_BITS) - 1
        for byte in data:
            move = moves(state << 8 | byte)
            if move is None:
                move = self._move(state, byte)
            state = move >> ID_BITS
            lasts.append(move & mask)
        return state

    def stream(self, chunks: Iterable[bytes]) -> Iterator[list[int]]:
        """Tokens of a byte string that arrives in chunks, as far as each chunk settles them."""
        state, lasts = 0, []
        for chunk in chunks:
            state = self._read(state, chunk, lasts)
            ready = self._settled(lasts, state)
            yield ready
            if ready:
                del lasts[: sum(len(self.text[x]) for x in ready)]
        yield self._back(lasts, len(lasts))

    def _back(self, lasts: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(lasts[end - 1])
            end -= len(self.text[lasts[end - 1]])
        return out[::-1]

    def _depth(self, node: int) -> int:
        if not hasattr(self, "depths"):
            self.depths = [0] * len(self.children)
            for parent, children in enumerate(self.children):
                for child in children.values():
                    self.depths[child] = self.depths[parent] + 1
        return self.depths[node]

    def _settled(self, lasts: list[int], state: int) -> list[int]:
        """The tokens up to the last border that lies on the way back from every growing place."""
        ways = {len(lasts) - self._depth(node) for node in self.states[state][1::2]}
        while len(ways) > 1:
            last = max(ways)
            ways.remove(last)
            ways.add(last - len(self.text[lasts[last - 1]]))
        return self._back(lasts, ways.pop())


def _utf8_table() -> list[list[int]]:
    """Moves of a machine that reads UTF-8 byte by byte; state 0: between characters, -1: not allowed."""
    lead = {0xE0: 4, 0xED: 5, 0xF0: 6, 0xF4: 8}
    first = [0] * 128 + [-1] * 66 + [1] * 30 + [2] * 16 + [7] * 5 + [-1] * 11
    for byte, state in lead.items():
        first[byte] = state
    nexts = {1: (0x80, 0xBF, 0), 2: (0x80, 0xBF, 1), 3: (0x80, 0xBF, 2), 4: (0xA0, 0xBF, 1)}
    nexts |= {5: (0x80, 0x9F, 1), 6: (0x90, 0xBF, 2), 7: (0x80, 0xBF, 2), 8: (0x80, 0x8F, 2)}
    return [first, *([to if low <= b <= high else -1 for b in range(256)] for low, high, to in (nexts[s] for s in range(1, 9)))]


class Utf8Stream:
    """Text from bytes that arrive in pieces; a malformed sequence becomes U+FFFD."""

    TABLE = _utf8_table()

    def __init__(self) -> None:
        self.state, self.held = 0, bytearray()

    def feed(self, data: bytes) -> str:
        out = []
        for byte in data:
            to = self.TABLE[self.state][byte]
            if to == -1 and self.state:
                out.append("�")
                self.held.clear()
                to = self.TABLE[0][byte]
            if to == -1:
                out.append("�")
                self.state = 0
                continue
            self.held.append(byte)
            self.state = to
            if to == 0:
                out.append(self.held.decode())
                self.held.clear()
        return "".join(out)

    def close(self) -> str:
        rest, self.state = "�" if self.state else "", 0
        self.held.clear()
        return rest


class Codec:
    """Whole texts to ids and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.raw = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        # Words seen of late, in two halves: when the newer is full, the older is forgotten.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @cached_property
    def plain(self) -> dict[int, str]:
        """What a token reads as when no character is open before or after it."""
        out = {}
        for token, rank in self.ranks.items():
            stream = Utf8Stream()
            read = stream.feed(token)
            if not stream.state and "�" not in read:
                out[rank] = read
        return out

    @cached_property
    def transducer(self) -> Transducer:
        """Built by the first text to encode; a worker that only decodes does without."""
        return Transducer(self.ranks)

    def _word(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            out = array("I", self.transducer.encode(word.encode())).tobytes()
        self.words[word] = out
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if len(self.words) >= WORDS:
            self.words, self.older = {}, self.words
        known = self.words.get
        return b"".join([known(word) or self._word(word) for word in self.find(text)])

    def decode(self, ids: bytes) -> Iterator[str]:
        """The text of such ids, piece by piece."""
        stream, raw = Utf8Stream(), self.raw
        tokens = memoryview(ids).cast("I").tolist()
        read = list(map(self.plain.get, tokens))
        read.append(None)
        at = 0
        while at < len(tokens):
            odd = read.index(None, at)
            yield from read[at:odd]
            at = odd
            while at < len(tokens):
                yield stream.feed(raw[tokens[at]])
                at += 1
                if not stream.state:
                    break
        yield stream.close()


_codecs: dict[tuple[int, str], Codec] = {}


def _codec(shared, pattern: str) -> Codec:
    """One codec per worker process; tasks of a worker share what it has learnt."""
    key = (shared.value["key"], pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(shared.value["ranks"], pattern)
    return _codecs[key]


def _share(df: DataFrame, path: str):
    """The vocabulary, read where the driver is; a file of fixed size."""
    ranks = read_ranks(path)
    return df.sparkSession.sparkContext.broadcast({"ranks": ranks, "key": hash(frozenset(ranks.items()))})


def bpe_encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """All rows with their whole text's ids as binary: little-endian unsigned 32-bit integers.

    A null text counts as empty and gives no ids. Bytes that are not UTF-8 become
    U+FFFD first. The other columns pass through; one that is named like the result
    gives way. Memory follows the longest text.
    """
    shared = _share(docs, path)
    columns = [c for c in docs.columns if c.lower() != out.lower()]
    source = docs.select(*(F.col(f"`{c}`") for c in columns), F.col(f"`{text}`").cast("binary").alias("__llm_raw"))
    schema = docs.select(*(F.col(f"`{c}`") for c in columns), F.lit(b"").alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                raw = part.column(len(columns))
                ids = [codec.encode((x.as_py() or b"").decode("utf-8", "replace")) for x in raw]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(ids, pa.binary())], names=[*columns, out])

    return source.mapInArrow(run, schema)


def bpe_decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All rows with the text of their ids; null ids give an empty text."""
    shared = _share(docs, path)
    columns = [c for c in docs.columns if c.lower() != out.lower()]
    schema = docs.select(*(F.col(f"`{c}`") for c in columns), F.lit("").alias(out)).schema
    place = columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = ["".join(codec.decode(x.as_py() or b"")) for x in part.column(place)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*columns, out])

    return docs.select(*(F.col(f"`{c}`") for c in columns)).mapInArrow(run, schema)
