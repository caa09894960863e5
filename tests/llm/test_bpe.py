import hashlib
import random
from array import array

import public_tokenizers
import pytest
import tiktoken

from flowframe.llm import bpe
from flowframe.llm.bpe import Codec, Utf8Stream, bpe_decode, bpe_encode, merge, read_ranks
from flowframe.llm.queries import QUERIES

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec(ranks):
    return Codec(ranks, PATTERN)


def byte_strings(ranks, n):
    rng, tokens = random.Random(1), list(ranks)
    for i in range(n):
        size = rng.randint(0, 14)
        if i % 3 == 0:
            yield b"".join(rng.choice(tokens) for _ in range(size))
        elif i % 3 == 1:
            yield bytes(rng.choice(b"abeinrst ") for _ in range(4 * size))
        else:
            yield bytes(rng.randrange(256) for _ in range(2 * size))


def test_transducer_against_plain_merging(codec, ranks):
    for data in byte_strings(ranks, 3000):
        want = [ranks[x] for x in merge(ranks, data)]
        for size in (1, 3, len(data) + 1):
            chunks = [data[i : i + size] for i in range(0, len(data), size)]
            assert [x for part in codec.transducer.stream(chunks) for x in part] == want


def test_tokens_go_out_after_a_bounded_lookahead(codec):
    data = b"the quick brown fox" * 200
    held, out = 0, 0
    for chunk, part in zip([data[i : i + 1] for i in range(len(data))], codec.transducer.stream(data[i : i + 1] for i in range(len(data))), strict=False):
        held += len(chunk)
        out += sum(len(codec.transducer.text[x]) for x in part)
        assert held - out <= 40


def test_other_vocabulary():
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    machine = bpe.Transducer(ranks)
    for data in byte_strings(ranks, 600):
        assert [x for part in machine.stream([data]) for x in part] == [ranks[x] for x in merge(ranks, data)]


def test_forgetting_changes_nothing(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "STATES", 50)
    monkeypatch.setattr(bpe, "WORDS", 5)
    small = Codec(ranks, PATTERN)
    text = "Der schnelle braune Fuchs, naïve café, don't 12345   \n\n 日本語 🙂 " * 3
    for _ in range(3):
        assert small.encode(text) == array("I", library.encode_ordinary(text)).tobytes()


def test_utf8_stream_against_python(ranks):
    rng = random.Random(2)
    samples = [bytes(rng.choice([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xED, 0xFF]) for _ in range(9)) for _ in range(3000)]
    for data in [*samples, "é€🙂".encode(), b"\xf4\x90\x80\x80", b"\xc0\x80"]:
        stream = Utf8Stream()
        got = "".join(stream.feed(data[i : i + 1]) for i in range(len(data))) + stream.close()
        assert got == data.decode("utf-8", "replace")


def test_rows_of_every_kind(spark, library):
    texts = [None, "", " ", "x" * 50_000, "word " * 100_000, "é🙂" * 999, "same", "same", "<|endoftext|>"]
    df = spark.createDataFrame([(i, t, b"clash") for i, t in enumerate(texts)], "doc_id long, text string, IDS binary")
    encoded = bpe_encode(df, PATH, PATTERN)
    assert encoded.columns == ["doc_id", "text", "ids"]
    for row in bpe_decode(encoded, PATH, PATTERN).collect():
        text = texts[row.doc_id] or ""
        assert bytes(row.ids) == array("I", library.encode_ordinary(text)).tobytes() and row.decoded == text
    assert bpe_encode(df.filter("false"), PATH, PATTERN).collect() == []


def test_whole_table_against_the_library(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    texts = dict(map(tuple, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()))
    rows = QUERIES["op5_bpe_codec"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
