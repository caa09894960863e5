"""Seen keys at any number: a Bloom filter per bucket of keys beside the ledger.

A key belongs to a bucket by a hash, and sets ``PROBES`` of the bucket's 32,768 bits. A run
joins its keys with the bits, one small row per bucket; only keys whose bits are all set can
have been seen, and only those are compared with the ledger itself, of which just the folders
that hold such keys are read. So a run that brings nothing old does not touch the ledger.

Bits are stored before the keys they stand for. A run that is lost between the two leaves
bits too many, which cost a comparison and never a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.plans.scratch import cut_lineage, path_exists

# Fixed value: the bits of one bitmap of Spark's bitmap functions.
BITS = 32_768
#: Bits that a key sets, and the ledger's folders.
PROBES, FOLDERS = 4, 64


def _places(key: list[str], buckets: int) -> dict[str, Column]:
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets))
    probes = [F.pmod(F.xxhash64(*key, F.lit(k + 1)), F.lit(BITS)).cast("int") for k in range(PROBES)]
    return {"__bucket": bucket, "__probes": F.array(*probes)}


def _bits(keys: DataFrame) -> DataFrame:
    """The bitmap of each bucket of these keys."""
    spread = keys.select("__bucket", F.explode("__probes").alias("place"))
    return spread.groupBy("__bucket").agg(F.bitmap_construct_agg("place").alias("bits"))


def _is_set(bits: Column, place: Column) -> Column:
    octet = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(octet, place % 8) == 1


def _latest(spark: SparkSession, path: str) -> int | None:
    """The number of the last filter that was stored whole."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/bits")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    runs = [status.getPath().getName() for status in files.listStatus(folder)]
    whole = [int(run[4:]) for run in runs if run.startswith("run=") and path_exists(spark, f"{path}/bits/{run}/_SUCCESS")]
    return max(whole, default=None)


def possibly_seen(df: DataFrame, path: str, key: list[str], buckets: int) -> DataFrame:
    """The rows with ``maybe``: false where the key was surely never marked."""
    spark = df.sparkSession
    placed = df.withColumns(_places(key, buckets))
    run = _latest(spark, path)
    if run is None:
        return placed.withColumn("maybe", F.lit(False)).drop("__probes")
    bits = spark.read.schema("__bucket bigint, bits binary").parquet(f"{path}/bits/run={run}").withColumnRenamed("__bucket", "__of")
    joined = placed.join(bits, F.col("__bucket") == F.col("__of"), "left")
    every = F.lit(True)
    for k in range(PROBES):
        every = every & _is_set(F.col("bits"), F.col("__probes")[k])
    return joined.withColumn("maybe", F.coalesce(every, F.lit(False))).drop("__probes", "__of", "bits")


def unseen_large(df: DataFrame, path: str, key: list[str], *, buckets: int = 4096) -> DataFrame:
    """The rows whose key was never marked under ``path``; null is a key like any other."""
    spark = df.sparkSession
    asked = cut_lineage(possibly_seen(df, path, key, buckets))
    rows = asked.filter("not maybe")
    maybe = asked.filter("maybe").withColumn("__folder", F.pmod("__bucket", F.lit(FOLDERS)).cast("int"))
    # At most as many as there are folders.
    folders = [row[0] for row in maybe.select("__folder").distinct().collect()]
    if folders and path_exists(spark, f"{path}/keys"):
        ledger = spark.read.parquet(f"{path}/keys").filter(F.col("__folder").isin(folders))
        ledger = ledger.select(*[F.col(name).alias(f"__{name}") for name in key])
        same = F.lit(True)
        for name in key:
            same = same & F.col(name).eqNullSafe(F.col(f"__{name}"))
        maybe = maybe.join(ledger, same, "left_anti")
    return rows.unionByName(maybe.drop("__folder")).select(*df.columns)


def mark_seen_large(
    df: DataFrame, path: str, key: list[str], deliver: Callable[[DataFrame], None] | None = None, *, buckets: int = 4096
) -> DataFrame:
    """``mark_seen`` with a ledger under ``path`` whose size the join does not follow.

    ``buckets`` is the number of bitmaps, the same for all runs: with up to some 3,000 keys
    in each, about one new key in 100 is compared with the ledger. ``deliver`` is as for
    ``mark_seen``. The filter is read and stored anew by each run, at 4 KB a bucket.
    """
    spark = df.sparkSession
    fresh = cut_lineage(unseen_large(df, path, key, buckets=buckets))
    if deliver is not None:
        deliver(fresh)
    keys = cut_lineage(fresh.select(*key).distinct().withColumns(_places(key, buckets)))
    run = _latest(spark, path)
    bits = _bits(keys)
    if run is not None:
        old = spark.read.schema("__bucket bigint, bits binary").parquet(f"{path}/bits/run={run}")
        bits = old.unionByName(bits).groupBy("__bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    bits.write.mode("overwrite").parquet(f"{path}/bits/run={(run or 0) + 1}")
    folder = F.pmod("__bucket", F.lit(FOLDERS)).cast("int")
    keys.select(*key, folder.alias("__folder")).repartition("__folder").write.mode("append").partitionBy("__folder").parquet(f"{path}/keys")
    return fresh
