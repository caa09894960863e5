"""Where checkpoints and intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only on a local master."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="flowframe-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame to reliable storage and go on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system that Spark means by the path has it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system that Spark means by it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def task_store(uri: str):
    """In a task: the store of a path with a scheme, and the path in it."""
    from urllib.parse import quote, unquote, urlparse

    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), unquote(urlparse(quote(uri, safe=":/%")).path)
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3" + uri[3:]
    return fs.FileSystem.from_uri(quote(uri, safe=":/%"))
