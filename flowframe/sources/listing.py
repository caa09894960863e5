"""Folders of very many files: listed and read in tasks.

Spark lists a folder on the driver, one file after the other, plans every file there, and opens
each with several calls of its file system. Here each folder is listed by a task, level by
level, the list is a table, and tasks read the files it names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from flowframe.plans.scratch import cut_lineage, qualified, scratch_path, shared_dir, task_store

ENTRIES = "base string, root string, place string, folder boolean, size bigint, millis bigint"
#: Entries, or bytes of contents, that leave a task at a time.
ROWS, GATHERED = 10_000, 4_000_000
#: What a file counts beside its bytes where listed files are dealt to tasks.
FILE_COST = 16_384


def _roots(spark: SparkSession, path: str | list[str]) -> list[tuple[str, str]] | None:
    """The folders as (path, place in its store), if tasks have a store for all of them."""
    from pyarrow import fs

    if any(spark.conf.get(f"spark.sql.files.{name}", "false") == "true" for name in ("ignoreMissingFiles", "ignoreCorruptFiles")):
        return None
    try:
        shared_dir(spark)
    except RuntimeError:
        return None
    found = {}
    for one in dict.fromkeys([path] if isinstance(path, str) else path):
        # Patterns, single files and what else Spark reads are left to it.
        if not one or any(sign in one for sign in "{}[]*?\\%"):
            return None
        base = qualified(spark, one).rstrip("/")
        try:
            store, place = task_store(base)
            if store.get_file_info(place).type != fs.FileType.Directory:
                return None
        except (OSError, ValueError, NotImplementedError):
            return None
        found[base] = place.rstrip("/")
    if any(other != base and other.startswith(f"{base}/") for base in found for other in found):
        return None
    return list(found.items())


def _list_folders(batches: Iterator) -> Iterator:
    import pyarrow as pa
    from pyarrow import fs

    def hidden(name: str, folder: bool) -> bool:
        """Names that Spark's readers pass over."""
        kept = folder and name.startswith(("_metadata", "_common_metadata"))
        return not kept and ((name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_"))

    for batch in batches:
        for base, root, place in zip(*(batch.column(name).to_pylist() for name in ("base", "root", "place")), strict=True):
            infos = task_store(base)[0].get_file_info(fs.FileSelector(place or "/"))
            for low in range(0, len(infos), ROWS):
                part = [i for i in infos[low : low + ROWS] if not hidden(i.base_name, i.type == fs.FileType.Directory)]
                folders = [i.type == fs.FileType.Directory for i in part]
                columns = [
                    pa.array([base] * len(part), pa.string()), pa.array([root] * len(part), pa.string()), pa.array([i.path for i in part], pa.string()),
                    pa.array(folders, pa.bool_()), pa.array([None if f else i.size for i, f in zip(part, folders, strict=True)], pa.int64()),
                    pa.array([None if f or i.mtime_ns is None else i.mtime_ns // 1_000_000 for i, f in zip(part, folders, strict=True)], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["base", "root", "place", "folder", "size", "millis"])


def listed_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame | None:
    """The files below folders that Spark's readers would read, as a stored table; None where Spark has to list them itself.

    One row per file: ``path`` as Spark names it, ``size``, ``modified``, and what ``read_listed``
    needs. A folder's own entries are listed by one task, a level of folders by one job.
    """
    roots = _roots(spark, path)
    if roots is None:
        return None
    folders = spark.range(1).select(F.inline(F.array(*(
        F.struct(F.lit(base).alias("base"), F.lit(place).alias("root"), F.lit(place).alias("place")) for base, place in roots
    ))))
    number, levels = len(roots), []
    while number:
        levels.append(scratch_path(spark, "listing"))
        dealt = folders.repartition(min(number, 4 * spark.sparkContext.defaultParallelism))
        dealt.mapInArrow(_list_folders, ENTRIES).write.parquet(levels[-1])
        folders = spark.read.schema(ENTRIES).parquet(levels[-1]).filter("folder").select("base", "root", "place")
        number = folders.count()
    files = spark.read.schema(ENTRIES).parquet(*levels).filter(~F.col("folder"))
    if glob is not None:
        # The pattern as Spark's readers understand it.
        pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
        files = files.filter(F.substring_index("place", "/", -1).rlike(rf"(?s)\A(?:{pattern})\z"))
    below = F.substring("place", F.length("root") + 1, F.length("place"))
    return files.select(F.concat("base", below).alias("path"), "size", F.timestamp_millis("millis").alias("modified"), "base", "place")


def _read(batches: Iterator) -> Iterator:
    """Listed files with their bytes; ``path`` twice, as ``binaryFile`` and as file metadata tell it."""
    import re
    from urllib.parse import quote

    import pyarrow as pa

    own = [("path", pa.string()), ("url", pa.string()), ("modified", pa.timestamp("us", "UTC")), ("content", pa.binary())]
    # Java's URIs quote what is not ASCII only if it is a space or a control character.
    quoted = re.compile("[\x00-\xa0  -     　]+")

    def as_batch(held):
        return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, (_, kind) in zip(held, own, strict=True)], names=[name for name, _ in own])

    def as_url(path):
        scheme, rest = path.split(":", 1)
        return f"{scheme}:" + quoted.sub(lambda part: quote(part[0], safe="/@,;:$&+=_-!.~'()*"), rest)

    stores, held, size = {}, ([], [], [], []), 0
    for batch in batches:
        for base, place, path, modified in zip(*(batch.column(name).to_pylist() for name in ("base", "place", "path", "modified")), strict=True):
            if base not in stores:
                stores[base] = task_store(base)[0]
            with stores[base].open_input_file(place) as file:
                data = file.read()
            for column, value in zip(held, (path, as_url(path), modified, data), strict=True):
                column.append(value)
            size += len(data) + 100
            if size >= GATHERED:
                yield as_batch(held)
                held, size = ([], [], [], []), 0
    if held[0]:
        yield as_batch(held)


def listed_facts(listed: DataFrame, small: Column) -> Row:
    """Of the small files the ``number`` and the ``cost`` to read them, and the number of ``others``."""
    cost = F.sum(F.when(small, F.col("size") + FILE_COST))
    return listed.agg(F.coalesce(cost, F.lit(0)).alias("cost"), F.count_if(small).alias("number"), F.count_if(~small).alias("others")).first()


def read_listed(listed: DataFrame, facts: Row, then: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """What ``then`` makes of batches (path, url, modified, content) of the listed files, dealt evenly to tasks.

    The dealt list is kept, so that what follows is one pass without a shuffle.
    """
    spark = listed.sparkSession
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    tasks = max(min(facts["number"], spark.sparkContext.defaultParallelism), math.ceil(facts["cost"] / most), 1)
    dealt = cut_lineage(listed.select("base", "place", "path", "modified").repartition(tasks))
    return dealt.mapInArrow(lambda batches: then(_read(batches)), schema)
