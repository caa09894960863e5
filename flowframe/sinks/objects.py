"""Write rows to objects of exact names, each row once, whatever task fails.

1. Stage: the rows of an object meet in one task, in order, and are streamed to an object
   of their own below a hidden folder of the run. A task that is tried again stages anew
   in another folder, and never touches what readers see.
2. Commit: when all tasks are through, the driver names the lists of what the tasks that
   count have staged. If any task fails for good, nothing was changed and the folder goes.
3. Publish: a Spark job moves every staged object to its name. What was moved already is
   left alone, so tasks may be tried again, and ``finish_writes`` goes on where a driver
   was lost.
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from flowframe.functions.columns import as_col
from flowframe.plans.ordered import number_groups
from flowframe.plans.scratch import qualified, scratch_path

EXISTS = ("replace", "ignore", "append", "fail")
STORE = "flowframe.plans.scratch:task_store"
#: Bytes copied at a time from an object that is appended to.
COPY = 8 << 20
LISTED = "path string, staged string, rows bigint, size bigint, outcome string"


def opened(store: str, uri: str):
    """The file system of a path and the path in it, from the function that ``store`` names as module:function."""
    module, name = store.split(":")
    return getattr(importlib.import_module(module), name)(uri)


class Below:
    """Places below a root in its store, which is looked up once and not for each object."""

    def __init__(self, store: str, root: str):
        self.root = root
        self.store, self.base = opened(store, root)

    def place(self, uri: str) -> str:
        if not uri.startswith(f"{self.root}/"):
            raise ValueError(f"{uri} is not below {self.root}")
        return self.base.rstrip("/") + uri[len(self.root) :]


@dataclass
class Staged(WriterCommitMessage):
    """Where one task's list of staged objects lies."""

    listed: str | None


class StageWriter(DataSourceArrowWriter):
    """Stages rows (path, data, facts) that come sorted by path."""

    def __init__(self, options: dict[str, str]):
        self.folder, self.exists, self.store = options["folder"], options["exists"], options["store"]
        self.line_end = bytes.fromhex(options["lineend"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        from pyarrow import fs

        own = f"{self.folder}/{uuid.uuid4().hex}"
        root = Below(self.store, self.folder.rsplit("/", 1)[0])
        store = root.store
        listed, out, current, made = [], None, None, False
        for batch in iterator:
            for uri, data, facts in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if current is None or uri != current["path"]:
                    if out is not None:
                        out.close()
                    out, current = None, {"path": uri, "staged": None, "rows": 0, "size": 0, "outcome": "written"}
                    listed.append(current)
                    target = root.place(uri)
                    there = self.exists != "replace" and store.get_file_info(target).type != fs.FileType.NotFound
                    if there and self.exists == "fail":
                        raise FileExistsError(uri)
                    if there and self.exists == "ignore":
                        current["outcome"] = "ignored"
                    else:
                        current["staged"] = f"{own}/{len(listed)}"
                        place = root.place(current["staged"])
                        if not made:
                            store.create_dir(place.rsplit("/", 1)[0], recursive=True)
                            made = True
                        out = store.open_output_stream(place, metadata=dict(facts) if facts else None)
                        if there:
                            with store.open_input_stream(target) as old:
                                while part := old.read(COPY):
                                    out.write(part)
                record = (data or b"") + self.line_end
                if out is not None:
                    out.write(record)
                current["rows"] += 1
                current["size"] += len(record)
        if out is not None:
            out.close()
        if not listed:
            return Staged(None)
        place = root.place(f"{own}/list.json")
        store.create_dir(place.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(place) as lines:
            for entry in listed:
                lines.write(json.dumps(entry).encode() + b"\n")
        return Staged(f"{own}/list.json")

    def commit(self, messages: list[Staged | None]) -> None:
        store, place = opened(self.store, f"{self.folder}/committed")
        store.create_dir(place.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(place) as out:
            out.write("".join(f"{m.listed}\n" for m in messages if m is not None and m.listed).encode())

    def abort(self, messages: list[Staged | None]) -> None:
        from pyarrow import fs

        store, place = opened(self.store, self.folder)
        if store.get_file_info(place).type != fs.FileType.NotFound:
            store.delete_dir(place)


class ObjectStage(DataSource):
    """The write side of ``write_objects`` as a Spark data source."""

    @classmethod
    def name(cls) -> str:
        return "flowframe_objects"

    def writer(self, schema, overwrite: bool) -> StageWriter:
        return StageWriter(dict(self.options))


def _move(store_name: str, root: str):
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        below, made = Below(store_name, root), set()
        store = below.store
        for batch in batches:
            for uri, staged in zip(batch.column("path").to_pylist(), batch.column("staged").to_pylist(), strict=True):
                if staged is None:
                    continue
                target, source = below.place(uri), below.place(staged)
                folder = target.rsplit("/", 1)[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                try:
                    store.move(source, target)
                except OSError:
                    # What an earlier try has moved is gone.
                    if store.get_file_info(source).type != fs.FileType.NotFound:
                        raise
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("path", "rows", "size", "outcome")], names=["path", "rows", "size", "outcome"])

    return move


def _publish(spark: SparkSession, folder: str, store: str) -> DataFrame:
    """Move what a committed run has staged; gives what became of each object."""
    own, place = opened(store, f"{folder}/committed")
    with own.open_input_stream(place) as lines:
        lists = lines.read().decode().split()
    result = "path string, rows bigint, size bigint, outcome string"
    outcomes = scratch_path(spark, "outcomes")
    if lists:
        listed = spark.read.schema(LISTED).json(lists)
        # As many tasks move as have staged: the lists are small, and left to Spark one task would move all.
        listed.repartition(len(lists), "path").mapInArrow(_move(store, folder.rsplit("/", 1)[0]), result).write.parquet(outcomes)
    else:
        spark.createDataFrame([], result).write.parquet(outcomes)
    own.delete_dir(opened(store, folder)[1])
    return spark.read.schema(result).parquet(outcomes)


def finish_writes(spark: SparkSession, root: str, *, store: str = STORE) -> int:
    """Publish the committed runs below ``root`` that a lost driver left, and clear away the others; gives their number."""
    from pyarrow import fs

    base = qualified(spark, root).rstrip("/") if store == STORE else root.rstrip("/")
    own, place = opened(store, base)
    runs = 0
    for found in own.get_file_info(fs.FileSelector(place, allow_not_found=True)):
        if not found.base_name.startswith(".staging-"):
            continue
        folder = f"{base}/{found.base_name}"
        if own.get_file_info(opened(store, f"{folder}/committed")[1]).type == fs.FileType.NotFound:
            own.delete_dir(found.path)
        else:
            _publish(spark, folder, store)
            runs += 1
    return runs


def write_objects(
    df: DataFrame, root: str, path: list[str], *, content: str = "content", exists: str = "replace",
    charset: str = "UTF-8", metadata: str | None = None, order_by: list[str | Column] | None = None,
    line_end: str = "", share_rows: int | None = None, store: str = STORE,
) -> DataFrame:
    """Write rows to the objects they name; gives ``path``, ``rows``, ``size`` and ``outcome`` of each.

    An object lies under ``root`` at the ``path`` columns joined by slashes and holds its
    rows in ``order_by`` (else in the order of their bytes), each followed by ``line_end``:
    binary content as it is, text in ``charset``; null is empty. A root without a scheme is
    one of Spark's default file system. ``exists`` is what happens to an object that was
    there before the run: ``replace``, ``ignore`` (the rows are left out), ``append`` (the
    rows come after it) or ``fail`` (nothing is written at all). ``metadata`` is a map
    column (an ACL among it, say); that of an object's first row goes to the store with it.
    ``share_rows`` cuts every object in shares of so many rows, ``name-00000.ext`` and so
    on, for names that very many rows have; without it one task streams a name's rows.
    """
    if exists not in EXISTS:
        raise ValueError(f"'{exists}' is not one of replace, ignore, append and fail")
    spark = df.sparkSession
    base = qualified(spark, root).rstrip("/") if store == STORE else root.rstrip("/")
    data = F.col(content) if dict(df.dtypes)[content] == "binary" else F.encode(F.col(content).cast("string"), charset)
    facts = F.lit(None).cast("map<string,string>") if metadata is None else F.col(metadata)
    order = {f"__order{k}": as_col(c) for k, c in enumerate(order_by or [])}
    rows = df.select(F.concat_ws("/", F.lit(base), *path).alias("path"), data.alias("data"), facts.alias("facts"), *[c.alias(n) for n, c in order.items()])
    if share_rows is not None:
        placed = number_groups(rows.withColumn("__hash", F.xxhash64("data")), ["path"], [*order, "__hash"])
        share = F.floor((F.col("position") - 1) / share_rows).cast("string")
        share = F.lpad(share, F.greatest(F.length(share), F.lit(5)), F.lit("0"))
        end = F.regexp_extract("path", r"(\.[^./]*)$", 1)
        stem = F.substring("path", F.lit(1), F.length("path") - F.length(end))
        rows = placed.withColumn("path", F.concat(stem, F.lit("-"), share, end)).select(*rows.columns)
    folder = f"{base}/.staging-{uuid.uuid4().hex}"
    together = rows.repartition("path").sortWithinPartitions("path", *order, "data").select("path", "data", "facts")
    spark.dataSource.register(ObjectStage)
    together.write.format(ObjectStage.name()).options(
        folder=folder, exists=exists, store=store, lineEnd=line_end.encode(charset).hex()
    ).mode("append").save()
    return _publish(spark, folder, store)
