"""Small Spark helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Narrow tables up to this many rows (of 50 bytes, 25 MB) may be broadcast; longer ones are joined by shuffle.
BROADCAST_IDS = 500_000
#: Bytes of a written intermediate table that one task takes at least.
TASK_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; only where that is unset and everything runs in one process is a folder made."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-", dir="/tmp"))
    return sc.getCheckpointDir()


def _bytes(value: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long")
    if isinstance(kind, T.StructType):
        return sum((_bytes(value[f.name], f.dataType) for f in kind), F.lit(0).cast("long"))
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.aggregate(value, F.lit(0).cast("long"), lambda n, x: n + _bytes(x, kind.elementType)) if isinstance(kind.elementType, (T.StringType, T.BinaryType)) else F.size(value) * F.lit(8 * len(getattr(kind.elementType, "fields", "1"))), F.lit(0)).cast("long")
    return F.lit(8).cast("long")


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the cluster's checkpoint folder and go on from there, in no more partitions than their bytes need."""
    return counted(df)[0]


def counted(df: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """cut(), with the number of rows and an order-free digest of them, both taken while they are written."""
    _folder(df.sparkSession)
    seen = Observation()
    size = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(0).cast("long"))
    digest = F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    out = df.observe(seen, F.count(F.lit(1)).alias("n"), digest.alias("x"), F.sum(size).alias("bytes")).checkpoint(eager=True)
    n, x, total = (seen.get[k] for k in ("n", "x", "bytes"))
    return out.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-(total or 0) // TASK_BYTES))), (n, x)


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors all reach, where Spark checkpoints."""
    return _folder(spark) + "/" + os.urandom(8).hex()


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a shared folder once what was read from it is written elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def by_ids(df: DataFrame, ids: DataFrame, how: str, on: str = "doc_id") -> DataFrame:
    """Semi or anti join of wide rows with a list of ids that is already materialised.

    The list is counted; a short one is broadcast, so the wide rows need no shuffle, a long one is joined by shuffle."""
    return df.join(small(ids.select(on).distinct()), on, how)


def small(ids: DataFrame) -> DataFrame:
    """A narrow table with the hint to broadcast it, if its counted rows are no more than BROADCAST_IDS."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an undirected edge list (a, b); root is the smallest node that is reachable.

    Alternating large-star and small-star contraction: each step needs only joins and minima by key,
    chains shrink geometrically and no component is ever held in one place."""
    e, mark = counted(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while mark[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        before = mark
        e, mark = counted(star.where("a <> b").distinct())
        if mark == before:
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b").distinct())
