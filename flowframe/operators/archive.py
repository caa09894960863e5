"""Unpack archives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def archive_expand(df: DataFrame, *, payload: str = "payload", batch_bytes: int = 16_000_000) -> DataFrame:
    """One row per file in each zip payload: all other columns, ``entry_no``, ``entry``, its bytes, ``error``.

    A payload that is no readable archive, or is null, gives one row with the error and
    no entry; an entry that cannot be read gives its row with the error. Entries leave
    in batches of about ``batch_bytes``, so a task holds one batch of archives and one
    of entries.
    """
    kept = [name for name in df.columns if name not in (payload, "entry_no", "entry", "error")]
    schema = T.StructType(
        [df.schema[name] for name in kept]
        + [
            T.StructField("entry_no", T.IntegerType()),
            T.StructField("entry", T.StringType()),
            T.StructField(payload, T.BinaryType()),
            T.StructField("error", T.StringType()),
        ]
    )

    def files(data):
        import io
        import zipfile

        try:
            archive = zipfile.ZipFile(io.BytesIO(data or b""))
        except (zipfile.BadZipFile, OSError, ValueError) as fault:
            yield None, None, None, str(fault)
            return
        with archive:
            for number, entry in enumerate((e for e in archive.infolist() if not e.is_dir()), 1):
                try:
                    yield number, entry.filename, archive.read(entry), None
                except (zipfile.BadZipFile, OSError, ValueError, NotImplementedError, RuntimeError, EOFError) as fault:
                    yield number, entry.filename, None, str(fault)

    def entries(batches):
        import pyarrow as pa

        kinds = [pa.int32(), pa.string(), pa.binary(), pa.string()]

        def as_batch(batch, held):
            rows, *columns = zip(*held, strict=True)
            old = [batch.column(name).take(pa.array(rows, pa.int64())) for name in kept]
            new = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*old, *new], names=schema.names)

        for batch in batches:
            held, size = [], 0
            for row in range(batch.num_rows):
                for found in files(batch.column(payload)[row].as_py()):
                    held.append((row, *found))
                    size += len(found[2] or b"") + 100
                    if size > batch_bytes:
                        yield as_batch(batch, held)
                        held, size = [], 0
            if held:
                yield as_batch(batch, held)

    return df.select(*kept, payload).mapInArrow(entries, schema)
