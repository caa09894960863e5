"""Exact duplicates by a Golomb-coded exchange of fingerprints.

1. Each partition sorts the 64-bit fingerprints of its texts and sends each owner of a
   stretch of their range the distinct ones as Golomb-Rice coded differences, with one
   bit per fingerprint that the partition itself holds more than once.
2. Each owner decodes and merges its lists and returns to every sender a bitmap: which of
   its fingerprints occur elsewhere or more than once.
3. Senders' lists and bitmaps give the suspect fingerprints. Only texts that have one are
   shuffled and compared byte by byte, by grouping on the text itself.

A group of copies, however large, is summed up in each task before the shuffle, and
rows meet their group's result in a join that Spark may split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.base import fold, pieces, without, written

#: Fingerprints that one owner merges.
OWNED = 500_000
RESULTS = ("keep_id", "group_size", "kept", "text_sha256")

LIST = "sender long, owner long, n long, rice int, unary binary, rests binary, twice binary"


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n).astype(bool)


def golomb_encode(numbers: np.ndarray) -> tuple[int, bytes, bytes]:
    """Sorted distinct 64-bit numbers as Golomb-Rice coded differences: parameter, quotients in unary, remainders."""
    steps = np.diff(numbers, prepend=np.uint64(0))
    rice = max(0, int(numbers[-1] // np.uint64(len(numbers))).bit_length() - 1)
    tall = (steps >> np.uint64(rice)).astype(np.int64)
    ends = np.cumsum(tall + 1)
    unary = np.zeros(int(ends[-1]), dtype=bool)
    unary[ends - 1] = True
    shifts = np.arange(rice - 1, -1, -1, dtype=np.uint64)
    rests = (steps[:, None] >> shifts) & np.uint64(1)
    return rice, _bits(unary), _bits(rests.astype(bool).ravel())


def golomb_decode(n: int, rice: int, unary: bytes, rests: bytes) -> np.ndarray:
    ends = np.flatnonzero(_flags(unary, 8 * len(unary)))[:n]
    tall = np.diff(ends, prepend=-1) - 1
    steps = tall.astype(np.uint64) << np.uint64(rice)
    bits = _flags(rests, n * rice).reshape(n, rice)
    for k in range(rice):
        steps |= bits[:, k].astype(np.uint64) << np.uint64(rice - 1 - k)
    return np.cumsum(steps, dtype=np.uint64)


def _send(owners: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender, parts = 0, []
        for batch in batches:
            if batch.num_rows:
                sender = batch.column(0)[0].as_py()
                parts.append(batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
        if not parts:
            return
        prints, counts = np.unique(np.concatenate(parts), return_counts=True)
        owner = ((prints >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
        cuts = np.flatnonzero(np.diff(owner, prepend=owner[0] - np.uint64(1) if owner[0] else np.uint64(1 << 40)))
        rows = []
        for low, high in zip(cuts, [*cuts[1:], len(prints)], strict=True):
            base = (owner[low] << np.uint64(32)) // np.uint64(owners) << np.uint64(32)
            rows.append((sender, int(owner[low]), int(high - low), *golomb_encode(prints[low:high] - base), _bits(counts[low:high] > 1)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), _LIST_TYPES, strict=True)], names=_LIST_NAMES
        )

    return send


_LIST_NAMES = [x.split()[0] for x in LIST.split(", ")]
_LIST_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def _lists(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[dict, np.ndarray]]:
    for row in table.to_pylist():
        yield row, golomb_decode(row["n"], row["rice"], row["unary"], row["rests"])


def _merge(table: pa.Table) -> pa.Table:
    """An owner's answer: per sender, one bit for each of its fingerprints."""
    rows, lists = zip(*_lists(table), strict=True)
    every, places, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    flags = counts > 1
    ends = np.cumsum([len(x) for x in lists])
    for row, end in zip(rows, ends, strict=True):
        own = places[end - row["n"] : end]
        flags[own[_flags(row["twice"], row["n"])]] = True
    out = [_bits(flags[places[end - row["n"] : end]]) for row, end in zip(rows, ends, strict=True)]
    return pa.table({"sender": [r["sender"] for r in rows], "owner": [r["owner"] for r in rows], "bitmap": pa.array(out, pa.binary())})


def _suspects(owners: int):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, prints in _lists(batch):
                base = ((row["owner"] << 32) // owners) << 32
                hits = prints[_flags(row["bitmap"], row["n"])] + np.uint64(base)
                yield pa.RecordBatch.from_arrays([pa.array(hits.view(np.int64))], names=["__llm_print"])

    return decode


def suspect_prints(prints: DataFrame, total: int) -> DataFrame:
    """The fingerprints (column ``__llm_print``) that occur more than once, each once."""
    owners = pieces(total, OWNED)
    named = prints.select(F.spark_partition_id().cast("long").alias("sender"), "__llm_print")
    sent = written(named.mapInArrow(_send(owners), LIST), "golomb-lists")
    answers = sent.groupBy("owner").applyInArrow(_merge, "sender long, owner long, bitmap binary")
    back = sent.join(answers, ["sender", "owner"])
    return written(back.mapInArrow(_suspects(owners), "__llm_print long").distinct(), "suspect-prints")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of
    equal texts the row with the largest id stays. A null id loses to any other. Of
    rows that repeat that id with that text, one stays. Columns named like a result
    give way to it.
    """
    docs = without(docs, *RESULTS)
    norm, key = fold(F.col(f"`{text}`")), F.col(f"`{doc_id}`")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumn("__llm_print", F.xxhash64(norm))
    prints = suspect_prints(marked.select("__llm_print"), docs.count())
    single = marked.join(prints, "__llm_print", "left_anti").select(*columns, *_alone(key, F.sha2(norm, 256)))
    # Written once: what follows reads the suspects three times and the other rows never again.
    suspects = written(marked.join(prints, "__llm_print", "left_semi"), "suspects")
    groups = (
        suspects.groupBy("__llm_print", norm.alias("__llm_norm"))
        .agg(F.max(key).alias("__llm_keep"), F.count("*").alias("__llm_size"))
        .filter("__llm_size > 1")
        .select(F.col("__llm_print").alias("__llm_group"), F.sha2("__llm_norm", 256).alias("__llm_text"), "__llm_keep", "__llm_size")
    )
    groups = written(groups, "copies")
    rows = suspects.withColumn("__llm_sha", F.sha2(norm, 256))
    same = (F.col("__llm_print") == F.col("__llm_group")) & (F.col("__llm_sha") == F.col("__llm_text"))
    top = key.eqNullSafe(F.col("__llm_keep"))
    grouped = [F.col("__llm_keep").alias("keep_id"), F.col("__llm_size").alias("group_size")]
    joined = rows.join(groups, same, "left")
    lone = joined.filter("__llm_size is null").select(*columns, *_alone(key, F.col("__llm_sha")))
    others = joined.filter(F.col("__llm_size").isNotNull() & ~top)
    others = others.select(*columns, *grouped, F.lit(False).alias("kept"), F.col("__llm_sha").alias("text_sha256"))
    # Only rows that repeat the largest id meet here.
    one = F.row_number().over(Window.partitionBy("__llm_print", "__llm_sha").orderBy(F.lit(1))) == 1
    tops = rows.join(groups, same & top).select(*columns, *grouped, one.alias("kept"), F.col("__llm_sha").alias("text_sha256"))
    return single.unionByName(lone).unionByName(others).unionByName(tops)


def _alone(key: Column, sha: Column) -> list[Column]:
    return [key.alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha.alias("text_sha256")]
