import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flowframe.llm import even_packing as e
from flowframe.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["", " ", "  ", "a", " a", "a ", "  a", "a  b", "a\n b", "a \n b", "it's  fine", "x" * 5000 + " y", "1 234  5", "é à ü", "日本 語", "a  b",
          "  x", "a\x1c b", "tab\t tab", "<|endoftext|> end <|endoftext|>", "'s 's", "end. \n\n", "a᠎ b", "🙂 🙂🙂  🙂", "a\x00 b", "\r\n x", "a" * 20_000 + "\n" + "b" * 9]


TOKENIZER = Tokenizer.from_file(PATH)
TOKENIZER.encode_special_tokens = True


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]


def plain_difference(lengths, windows):
    """Partitions as full lists of windows; returns the final lengths, less the shortest."""
    parts = [(sorted([x] + [0] * (windows - 1), reverse=True), k) for k, x in enumerate(lengths)]
    k = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: (p[0][-1] - p[0][0], p[1]))
        (a, _), (b, _) = parts.pop(0), parts.pop(0)
        merged = sorted((x + y for x, y in zip(a, reversed(b), strict=True)), reverse=True)
        parts.append(([x - merged[-1] for x in merged], k))
        k += 1
    return parts[0][0]


@pytest.mark.parametrize("seed", range(12))
def test_differencing_against_full_lists(seed):
    rng = random.Random(seed)
    windows = rng.randint(2, 9)
    lengths = [rng.randint(1, 200) for _ in range(rng.randint(windows, 40))]
    held = e.difference(lengths, windows)
    assert sorted(itertools.chain(*held)) == list(range(len(lengths)))
    sums = sorted((sum(lengths[i] for i in w) for w in held), reverse=True)
    sums += [0] * (windows - len(sums))
    assert [x - sums[-1] for x in sums] == plain_difference(lengths, windows)


def test_known_partition():
    # Two parts of 4, 5, 6, 7, 8: differencing ends at 16 and 14.
    assert sorted(sum([4, 5, 6, 7, 8][i] for i in w) for w in e.difference([4, 5, 6, 7, 8], 2)) == [14, 16]


@pytest.mark.parametrize("lengths", [[], [1], [600] * 50, [64] * 33, [1] * 70, [64, 1], list(range(1, 65)), [63] * 9, [2] * 100])
def test_windows_hold_what_they_may(lengths):
    windows = e.even_windows(lengths, 64)
    covered = defaultdict(list)
    for window in windows:
        assert 0 < sum(n for _, _, n in window) <= 64
        for i, at, n in window:
            assert n > 0
            covered[i].append((at, n))
    for i, length in enumerate(lengths):
        end = 0
        for at, n in sorted(covered[i]):
            assert at == end
            end += n
        assert end == length


def test_windows_are_near_equal():
    rng = random.Random(2)
    windows = e.even_windows([rng.randint(1, 1024) for _ in range(800)], 1024)
    sums = [sum(n for _, _, n in w) for w in windows]
    assert min(sums) > 960 and sum(1024 - s for s in sums) < 0.025 * sum(sums)


def test_ids_are_those_of_whole_texts():
    rng = random.Random(4)
    mixed = ["".join(rng.choice(["a", "the", " ", " ", "\n", "\t", ".", "'ll", "9", "ß", "　", "\u0085", "​", "🙂"]) for _ in range(60)) for _ in range(400)]
    common = ["".join(rng.choice(["a", "B", " ", " ", "\n", "'", "'s", "ll", "7", "é", "ÿ", "×", "!", "$$", "_", "\x7f"]) for _ in range(40)) for _ in range(600)]
    texts = TRICKY + mixed + common
    encoder, narrow = e.Encoder(PATH), e.Encoder(PATH, e.id_width(PATH, 0))
    assert (e.id_width(PATH, 0), e.id_width(PATH, 1 << 16)) == (2, 4)
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain_ids(text)[:-1], text
        assert np.frombuffer(narrow.encode(text), "<u2").tolist() == plain_ids(text)[:-1], text


def test_every_byte_has_its_letter():
    from tokenizers.pre_tokenizers import ByteLevel

    plain = ByteLevel(add_prefix_space=False, use_regex=False)
    for text in ["".join(map(chr, range(128))), "".join(map(chr, range(128, 0x2000)))]:
        assert text.encode().decode("latin-1").translate(e.LETTERS) == plain.pre_tokenize_str(text)[0][0]


def test_other_tokenizers_are_refused(tmp_path):
    import json

    other = json.load(open(PATH))
    other["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "t.json").write_text(json.dumps(other))
    with pytest.raises(ValueError):
        e.Encoder(str(tmp_path / "t.json"))


def check(rows, docs):
    """Pieces against ids of whole texts, gapless windows, and little padding."""
    windows, covered = defaultdict(list), defaultdict(list)
    for x in rows:
        windows[x.sequence_id].append((x.offset, x.length))
        covered[x.doc_id].append(x)
    for held in windows.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end and length > 0
            end += length
        assert end <= 1024
    want = Counter()
    for doc_id, text in docs:
        ids = np.array(plain_ids(text), "<u4")
        want[doc_id] += len(ids)
        if sum(1 for d, _ in docs if d == doc_id) == 1:
            end = 0
            for x in sorted(covered[doc_id], key=lambda x: x.start):
                assert x.start == end and x.doc_tokens == len(ids)
                end += x.length
                assert x.ids_crc32 == zlib.crc32(ids[x.start:end].tobytes())
            assert end == len(ids)
    assert want == Counter({k: sum(x.length for x in v) for k, v in covered.items()})
    return {k: sum(n for _, n in v) for k, v in windows.items()}


SCHEMA = "doc_id long, text string, ids string, start int, sequence_id string"


def query(spark, folder, docs):
    spark.createDataFrame([(*d, "clash", 1, "clash") for d in docs], SCHEMA).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return QUERIES["op12_differencing_packing"](spark, str(folder)).collect()


def test_query_on_odd_rows(spark, tmp_path):
    docs = [(k, text) for k, text in enumerate(TRICKY)] + [(1000, None), (None, "no id here"), (None, None), (7, "same id, other text")]
    docs += [(2000, "the same row")] * 40 + [(3000, "word " * 300_000)]
    check(query(spark, tmp_path, docs), docs)


def test_query_on_empty_table(spark, tmp_path):
    assert query(spark, tmp_path, []) == []


def test_query_on_test_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(x) for x in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    sizes = check(QUERIES["op12_differencing_packing"](spark, folder).collect(), docs)
    padding = sum(1024 - n for n in sizes.values() if n & (n - 1))
    assert padding < 0.03 * sum(sizes.values())


def test_equal_rows_go_to_many_groups(spark, monkeypatch):
    monkeypatch.setattr(e, "GROUP", 50)
    frame = spark.createDataFrame([(None, "a b c")] * 1000, "doc_id long, text string").repartition(2)
    packed = e.pack_even(frame, PATH).selectExpr("sequence_id >> 32 AS g").groupBy("g").count().collect()
    assert sum(x["count"] for x in packed) >= 1000 and max(x["count"] for x in packed) < 200
