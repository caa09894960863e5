"""Language by compression: the dictionary that shortens a text most names its language.

Per language, texts of a bounded sample make one raw-content zstandard dictionary. A
text is lower-cased, runs of anything but letters become one space, and it is encoded
whole, in blocks of ``BLOCK`` bytes so that the dictionary counts all along, once with
each dictionary. The smallest sum wins. A text whose runner-up is nearly as small is
marked as rejected. The encoder stores a very short input as it is, so a text of fewer
than ``SHORT`` bytes goes through its most thorough setting after several lead-ins from
the dictionary; their own sizes are taken off the sum.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.llm.base import without

BLOCK = 2048
LEVEL = 6
SHORT, LEADS, LEAD = 64, 8, 48
#: Bounds of the sample: texts of a language, characters of a text, bytes of a dictionary, languages.
TEXTS, CHARS, BYTES, LANGUAGES = 256, 1024, 1 << 17, 256
#: Softness of the score, as a share of the smallest size.
SOFTNESS = 0.05
RESULTS = ("lang_pred", "score", "rejected")

# Marks belong to the letters they stand on.
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")


def letters(text: str) -> bytes:
    """The text as its classifier sees it; empty if it has no letter."""
    plain = _OTHER.sub(" ", text.lower()).strip()
    return plain.encode() if any(map(str.isalpha, plain)) else b""


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id") -> dict[str, bytes]:
    """A dictionary per language, from the rows with text and language.

    A hash of the key deals each language's rows into ``TEXTS`` buckets; the row with
    the smallest hash of each gives the first ``CHARS`` characters of its text. So what
    the driver gets is bounded at any input size. More than ``LANGUAGES`` languages are
    an error.
    """
    rows = docs.select(
        F.col(f"`{lang}`").alias("_lang"), F.col(f"`{text}`").alias("_text"), F.xxhash64(F.col(f"`{key}`")).alias("_hash")
    ).filter("_lang is not null and _text is not null")
    buckets = rows.groupBy("_lang", F.pmod("_hash", F.lit(TEXTS)).alias("_bucket")).agg(F.min("_hash").alias("_hash"))
    picked = buckets.limit(TEXTS * LANGUAGES + 1).collect()
    if len({row["_lang"] for row in picked}) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    hashes = sorted({row["_hash"] for row in picked})
    sample = rows.filter(F.col("_hash").isin(hashes)).groupBy("_lang", "_hash").agg(F.min(F.substring("_text", 1, CHARS)).alias("_text"))
    model: dict[str, bytes] = {}
    for row in sorted(sample.collect(), key=lambda row: (row["_lang"], row["_hash"])):
        known = model.get(row["_lang"], b"")
        if len(known) < BYTES:
            model[row["_lang"]] = (known + letters(row["_text"]) + b" ")[:BYTES]
    return {name: data for name, data in model.items() if data.strip()}


class Classifier:
    """The dictionaries, ready to encode with."""

    def __init__(self, model: dict[str, bytes]):
        plain = {"write_content_size": 0, "write_checksum": 0, "write_dict_id": 0}
        usual = zstandard.ZstdCompressionParameters.from_level(LEVEL, **plain)
        thorough = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_BTULTRA2, min_match=3, window_log=18, chain_log=18, hash_log=17, search_log=8,
            target_length=256, **plain,
        )
        names = sorted(model)
        self.encoders = {name: self._encoder(model[name], usual) for name in names}
        self.short = {}
        for name in names:
            encode, data = self._encoder(model[name], thorough), model[name]
            leads = [data[at : at + LEAD] for at in (len(data) * i // LEADS for i in range(LEADS))]
            self.short[name] = encode, leads, sum(len(encode(lead)) for lead in leads)

    @staticmethod
    def _encoder(data: bytes, options: zstandard.ZstdCompressionParameters) -> Callable[[bytes], bytes]:
        made = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        made.precompute_compress(compression_params=options)
        return zstandard.ZstdCompressor(dict_data=made, compression_params=options).compress

    def sizes(self, data: bytes) -> dict[str, int]:
        if len(data) < SHORT:
            return {name: sum(len(encode(lead + data)) for lead in leads) - own for name, (encode, leads, own) in self.short.items()}
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        return {name: sum(len(encode(block)) for block in blocks) for name, encode in self.encoders.items()}

    def predict(self, text: str | None, margin: float) -> tuple[str, float, bool]:
        data = letters(text or "")
        if not data or not self.encoders:
            return "und", 0.0, True
        ranked = sorted((size, name) for name, size in self.sizes(data).items())
        best = ranked[0][0]
        score = 1 / sum(math.exp((best - size) / (SOFTNESS * max(1, best))) for size, _ in ranked)
        narrow = len(ranked) > 1 and ranked[1][0] - best < margin * ranked[1][0]
        return ranked[0][1], score, narrow


def identify(docs: DataFrame, model: dict[str, bytes], text: str = "text", margin: float = 0.005) -> DataFrame:
    """All rows with ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    A text that is null or has no letter, and any text if nothing was learnt, is
    ``und`` with score 0 and rejected. Otherwise ``lang_pred`` is the language of the
    smallest size, ties to the first by name, and the row is rejected if the runner-up
    is larger by less than ``margin`` of its size. Columns named like a result give way.
    """
    docs = docs if text in RESULTS else without(docs, *RESULTS)
    columns = docs.columns
    place = columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    extra = [F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("rejected")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [classifier.predict(x.as_py(), margin) for x in part.column(place)]
                kinds = (pa.string(), pa.float64(), pa.bool_())
                new = [pa.array(x, kind) for x, kind in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*columns, *RESULTS])

    return docs.mapInArrow(run, docs.select("*", *extra).schema)


def learnable(key: str = "doc_id") -> Column:
    """The rows to learn from: crc32 of the key as text, modulo 4, is not 2."""
    return F.crc32(F.col(key).cast("string")) % 4 != 2
