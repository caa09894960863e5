"""Captured network data: syslog lines and framed byte streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowframe.functions.columns import as_col
from flowframe.operators.split import split_expression
from flowframe.plans.ordered import running_totals
from flowframe.plans.spans import entering_states, kept

# The line shapes of RFC 3164 and RFC 5424.
RFC3164 = r"(?s)^<(\d{1,3})>([A-Za-z]{3} +\d{1,2} \d{2}:\d{2}:\d{2}) ([^\s\x01]+) (\w+)(?:\[\d+\])?:? ?(.*)$"
RFC5424 = (
    r"(?s)^<(\d{1,3})>(\d{1,2}) ([!-~]+) ([!-~]+) ([!-~]+) ([!-~]+) ([!-~]+) "
    r"((?:-|(?:\[(?:[^\]\\]|\\.)*\])+)(?: .*)?)$"
)
SD_ELEMENTS = r"^((?:\[(?:[^\]\\]|\\.)*\])+)"

# The default limit for one record, and the framing characters.
MAX_RECORD = 2048
DELIMITERS = {"CRLF": "\r\n", "LF": "\n", "NULL": "\u0000", "STXETX": "\u0003"}
START_OF_TEXT = "\u0002"
LENGTH_BYTES = {"L1": 1, "L2": 2, "L4": 4}


def syslog_parse(df: DataFrame, line: str | Column = "payload", *, rfc: str = "3164") -> DataFrame:
    """Add a column per syslog field; ``parse_error`` marks lines that do not fit.

    RFC 3164 gives FACILITY, SEVERITY, TIMESTAMP, HOST, TAG, MESSAGE; RFC 5424
    the same kind of fields with the prefix ``syslog_``, and ``syslog_SD`` the
    structured data as an array of its bracketed elements.
    """
    text = as_col(line)
    pattern, groups = (RFC3164, 5) if rfc == "3164" else (RFC5424, 8)
    # All fields in one pass: written out one after the other, then cut again. The
    # last one takes what is left, so it may hold the separator itself.
    together = "\u0001".join(f"${group}" for group in range(1, groups + 1))
    fields = F.when(text.rlike(pattern), F.split(F.regexp_replace(text, pattern, together), "\u0001", groups))
    rows = df.withColumn("__fields", fields)

    def field(group: int) -> Column:
        return F.col("__fields")[group - 1]

    def present(group: int) -> Column:
        return F.when(field(group) != "-", field(group))

    priority = field(1).cast("int")
    facility, severity = F.floor(priority / 8).cast("int"), priority % 8
    unfit = F.col("__fields").isNull().alias("parse_error")
    if rfc == "3164":
        return rows.select(
            *df.columns, facility.alias("FACILITY"), severity.alias("SEVERITY"), field(2).alias("TIMESTAMP"),
            field(3).alias("HOST"), field(4).alias("TAG"), field(5).alias("MESSAGE"), unfit,
        )
    tail = field(8)
    data = F.when(tail.startswith("["), F.regexp_extract(tail, SD_ELEMENTS, 1)).otherwise(F.substring(tail, 1, 1))
    elements = F.regexp_extract_all(data, F.lit(r"(\[(?:[^\]\\]|\\.)*\])"), F.lit(1))
    return rows.select(
        *df.columns,
        facility.alias("syslog_FACILITY"),
        severity.alias("syslog_SEVERITY"),
        field(2).cast("int").alias("syslog_VERSION"),
        present(3).alias("syslog_TIMESTAMP"),
        present(4).alias("syslog_HOST"),
        present(5).alias("syslog_APP_NAME"),
        present(6).alias("syslog_PROCID"),
        present(7).alias("syslog_MSGID"),
        elements.alias("syslog_SD"),
        F.substring(tail, F.length(data) + 2, F.length(tail)).alias("syslog_MESSAGE"),
        unfit,
    )


def frame_split(
    df: DataFrame,
    encoding: str = "CRLF",
    *,
    payload: str = "payload",
    max_record: int = MAX_RECORD,
    correlate: str | Column | None = None,
) -> DataFrame:
    """Cut captured data into records, one row each, with ``record_error``.

    Delimiters: CRLF, LF, NULL, STXETX. Length prefixes: L1, L2, L4. RAW takes the
    whole input. Records are binary, byte by byte as captured; text input counts as
    UTF-8. Faulty records stay, marked: those above ``max_record`` bytes, what follows
    the last complete record, and data that does not begin with STX where it must.
    """
    if encoding in LENGTH_BYTES:
        return _split_lengths(df, LENGTH_BYTES[encoding], payload, max_record)
    rows = df if payload == "payload" else df.withColumnRenamed(payload, "payload")
    # One character per byte, so that no byte is lost on the way through text functions.
    rows = rows.withColumn("payload", F.decode(F.col("payload").cast("binary"), "ISO-8859-1"))
    text = F.col("payload")
    too_long = F.when(F.length("payload") > max_record, F.lit("record too long"))

    def as_bytes(frame: DataFrame) -> DataFrame:
        return frame.withColumn("payload", F.encode("payload", "ISO-8859-1"))

    if encoding == "RAW":
        return as_bytes(split_expression(rows, F.array(text), correlate=correlate).withColumn("record_error", too_long))
    end = DELIMITERS[encoding]
    rows = rows.withColumn("__open", (text != "") & ~text.endswith(end))
    parts = split_expression(rows, F.split(text, end), correlate=F.lit(None) if correlate is None else correlate)
    # The last part is what follows the last delimiter: usually nothing.
    last = F.col("sequence_number") == F.col("sequence_size")
    parts = parts.withColumn("__cut", last).filter(~F.col("__cut") | F.col("__open"))
    error = F.when(F.col("__cut"), F.lit("incomplete record"))
    if encoding == "STXETX":
        begun = text.startswith(START_OF_TEXT)
        error = error.when(~begun, F.lit("no start of record"))
        parts = parts.withColumn("record_error", error)
        parts = parts.withColumn("payload", F.when(begun, F.substring(text, F.lit(2), F.length(text))).otherwise(text))
    else:
        parts = parts.withColumn("record_error", error)
    parts = as_bytes(parts.withColumn("record_error", F.coalesce("record_error", too_long)))
    if correlate is None:
        return parts.drop("correlation_id", "sequence_number", "sequence_size", "__open", "__cut")
    size = F.col("sequence_size") - F.when(F.col("__open"), 0).otherwise(1)
    return parts.withColumn("sequence_size", size).drop("__open", "__cut")


def _split_lengths(df: DataFrame, width: int, payload: str, max_record: int) -> DataFrame:
    """Length-prefixed records; reads each input once, batch by batch."""
    kept = [name for name in df.columns if name != payload]
    out = T.StructType(
        [df.schema[name] for name in kept]
        + [
            T.StructField("frame_no", T.IntegerType()),
            T.StructField("payload", T.BinaryType()),
            T.StructField("record_error", T.StringType()),
        ]
    )

    def frames(data):
        at, number = 0, 1
        while at < len(data):
            size = int.from_bytes(data[at:at + width], "big")
            record = data[at + width:at + width + size]
            if at + width > len(data) or len(record) < size:
                yield number, data[at:], "incomplete record"
                return
            yield number, record, "record too long" if size > max_record else None
            at, number = at + width + size, number + 1

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            found = [
                (i, *frame) for i, data in enumerate(batch.column(payload).to_pylist()) for frame in frames(data or b"")
            ]
            at, numbers, records, errors = ([one[k] for one in found] for k in range(4))
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name).take(rows) for name in kept],
                    pa.array(numbers, pa.int32()), pa.array(records, pa.binary()), pa.array(errors, pa.string()),
                ],
                names=out.names,
            )

    return df.select(*kept, payload).mapInArrow(cut, out)


#: Bytes of a connection that one task cuts at a time.
STREAM_BLOCK = 262_144
#: Bytes of records, and of maps of blocks, that a task gathers before they leave it; and what a record costs beside its bytes.
GATHERED, RECORD_COST = 4_000_000, 200


def _blocks_of(df: DataFrame, keys: list[str], order_by: list[str], payload: str, block: int, back: int, ahead: int, chunks: int | None) -> DataFrame:
    """Per ``key`` and ``block`` the captured pieces in it, with ``back`` bytes before and ``ahead`` behind it."""
    rows = df.select(*keys, *[name for name in order_by if name not in keys], F.col(payload).cast("binary").alias("__data"))
    rows = rows.filter(F.octet_length("__data") > 0).withColumn("__size", F.octet_length("__data").cast("bigint"))
    placed = running_totals(rows, keys, order_by, {"__at": "__size"}, chunks=chunks)
    at, size = F.col("__at"), F.col("__size")
    first = F.greatest(F.floor((at - ahead) / block), F.lit(0)).cast("bigint")
    last = F.floor((at + size + back - 1) / block).cast("bigint")
    parts = placed.select(F.struct(*keys).alias("key"), "__at", "__size", "__data", F.explode(F.sequence(first, last)).alias("block"))
    low = F.greatest(at, F.col("block") * block - back)
    high = F.least(at + size, (F.col("block") + 1) * block + ahead)
    piece = F.substring("__data", (low - at + 1).cast("int"), (high - low).cast("int"))
    return parts.groupBy("key", "block").agg(F.sort_array(F.collect_list(F.struct(low.alias("at"), piece.alias("piece")))).alias("pieces"))


def _joined(batch, row: int) -> tuple[int, bytes]:
    """Where the bytes of a block begin in its connection, and these bytes."""
    at, piece = batch.column("pieces")[row].values.flatten()
    return at[0].as_py(), b"".join(piece.to_pylist())


def delimited_records(base: int, data: bytes, number: int, block: int, end: bytes, start: bytes, max_record: int):
    """The records that begin in a block: (place, record, error); ``data`` begins at ``base`` of the connection."""
    low, high = number * block, (number + 1) * block
    at = 0 if low == 0 else data.find(end, max(low - len(end) - base, 0))
    if low:
        at = len(data) if at < 0 else at + len(end)
    while base + at < high and at < len(data):
        found = data.find(end, at)
        record = data[at:found] if found >= 0 else data[at:]
        begun = record.startswith(start)
        body = record[len(start):] if begun else record
        error = None
        if len(body) > max_record:
            error, body = "record too long", body[:max_record]
        elif found < 0:
            error = "incomplete record"
        yield base + at, body, error if begun or error else "no start of record"
        if found < 0:
            return
        at = found + len(end)


def _headers(data: bytes, width: int):
    """The record length that would be read at each place at which a whole header fits."""
    import numpy as np

    octets = np.frombuffer(data, dtype=np.uint8).astype(np.int64)
    fits = max(len(octets) - width + 1, 0)
    sizes = np.zeros(fits, dtype=np.int64)
    for k in range(width):
        sizes = (sizes << 8) | octets[k:k + fits]
    return sizes


def length_function(data: bytes, own: int, width: int, max_record: int) -> bytes:
    """Where the first record behind a block of ``own`` bytes begins, by how far into it the first one begins.

    The last entry stands for a connection whose reading has ended with a record too long.
    """
    import numpy as np

    broken = width + max_record
    sizes = _headers(data, width)[:own]
    jump = np.arange(own + broken + 1)
    jump[len(sizes):own] = own
    following = np.arange(len(sizes)) + width + sizes
    jump[:len(sizes)] = np.where(sizes > max_record, own + broken, following)
    while True:
        further = jump[jump]
        if (further == jump).all():
            break
        jump = further
    entry = np.arange(broken + 1)
    out = np.where(entry < own, jump[np.minimum(entry, own + broken)] - own, entry - own)
    out[broken] = broken
    return out.astype("<i4").tobytes()


def _compose_lengths(f: bytes, g: bytes) -> bytes:
    import numpy as np

    return np.frombuffer(g, dtype="<i4")[np.maximum(np.frombuffer(f, dtype="<i4"), 0)].tobytes()


def _apply_length(f: bytes, state: bytes) -> bytes:
    import numpy as np

    return np.frombuffer(f, dtype="<i4")[np.frombuffer(state, dtype="<i4")].tobytes()


def length_records(base: int, data: bytes, own: int, entry: int, width: int, max_record: int):
    """The records that begin in a block of ``own`` bytes, the first of them ``entry`` bytes into it."""
    at = entry if entry < width + max_record else own
    while at < own:
        size = int.from_bytes(data[at:at + width], "big")
        record = data[at + width:at + width + size]
        if at + width <= len(data) and size > max_record:
            yield base + at, record[:max_record], "record too long"
            return
        if at + width > len(data) or len(record) < size:
            yield base + at, data[at:], "incomplete record"
            return
        yield base + at, record, None
        at += width + size


def frame_split_stream(
    df: DataFrame,
    encoding: str,
    keys: list[str],
    order_by: list[str],
    *,
    payload: str = "payload",
    max_record: int = MAX_RECORD,
    block: int = STREAM_BLOCK,
    chunks: int | None = None,
) -> DataFrame:
    """The records of each connection, whose bytes were captured in chunks cut anywhere.

    ``keys`` name a connection and ``order_by``, a total order within it, its chunks; a
    null or empty chunk adds nothing. Gives ``keys``, ``record_at`` (the byte of the
    connection at which the record begins), ``payload`` and ``record_error``. Records may
    run over any number of chunks, and a connection may hold any share of the bytes: it is
    cut into blocks of bytes that overlap by one record. A delimited record above
    ``max_record`` bytes is marked and cut to that many. With length prefixes one too long
    ends the reading of its connection, as nothing behind it can be trusted; where the
    first record of each block begins is found by composing the blocks' maps in a tree.
    What follows the last complete record is marked as incomplete.
    """
    if encoding not in DELIMITERS and encoding not in LENGTH_BYTES:
        raise ValueError(f"'{encoding}' is not one of {', '.join([*DELIMITERS, *LENGTH_BYTES])}")
    end = DELIMITERS.get(encoding, "").encode()
    start = START_OF_TEXT.encode() if encoding == "STXETX" else b""
    width = LENGTH_BYTES.get(encoding, 0)
    ahead = max_record + len(start) + len(end) + width + 1
    if ahead > block:
        raise ValueError("a block must hold more than a record")
    blocks = _blocks_of(df, keys, order_by, payload, block, len(end), ahead, chunks)
    key = f"key {blocks.schema['key'].dataType.simpleString()}"
    out = f"{key}, record_at long, payload binary, record_error string"

    def records(found):
        import pyarrow as pa

        kinds = (pa.int64(), pa.binary(), pa.string())

        def as_batch(batch, held):
            at, *columns = zip(*held, strict=True)
            columns = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(at, pa.int64())), *columns], names=["key", "record_at", "payload", "record_error"])

        def cut(batches):
            for batch in batches:
                held, size = [], 0
                for row in range(batch.num_rows):
                    for one in found(batch, row):
                        held.append((row, *one))
                        size += len(one[1]) + RECORD_COST
                        if size >= GATHERED:
                            yield as_batch(batch, held)
                            held, size = [], 0
                if held:
                    yield as_batch(batch, held)

        return cut

    if not width:
        made = blocks.mapInArrow(
            records(lambda batch, row: delimited_records(*_joined(batch, row), batch.column("block")[row].as_py(), block, end, start, max_record)), out
        )
        return made.select("key.*", "record_at", "payload", "record_error")

    stored = kept(blocks, "captured")
    at_once = max(GATHERED // (4 * (width + max_record + 1)), 1)

    def functions(batches):
        import pyarrow as pa

        for batch in batches:
            for low in range(0, batch.num_rows, at_once):
                part = batch.slice(low, at_once)
                made = []
                for row in range(part.num_rows):
                    data = _joined(part, row)[1]
                    made.append(length_function(data, min(block, len(data)), width, max_record))
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("block"), pa.array(made, pa.binary())], names=["key", "block", "f"])

    # A connection of one block is read from its beginning, so that only those of more need maps.
    large = stored.filter("block > 0").select(F.col("key").alias("large")).distinct()
    several = stored.join(large, F.col("key") == F.col("large"), "left_semi")
    maps = kept(several.mapInArrow(functions, f"{key}, block long, f binary"), "spans")
    begin = (0).to_bytes(4, "little")
    states, _ = entering_states(maps, _compose_lengths, _apply_length, begin)
    states = states.select(F.col("key").alias("__key"), F.col("block").alias("__block"), "state")
    entered = stored.join(states, (F.col("key") == F.col("__key")) & (F.col("block") == F.col("__block")), "left")
    entered = entered.select("key", "pieces", F.coalesce("state", F.lit(bytearray(begin)).cast("binary")).alias("state"))

    def of_block(batch, row):
        base, data = _joined(batch, row)
        return length_records(base, data, min(block, len(data)), int.from_bytes(batch.column("state")[row].as_py(), "little"), width, max_record)

    return entered.mapInArrow(records(of_block), out).select("key.*", "record_at", "payload", "record_error")
