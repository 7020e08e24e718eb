"""Where jobs write what they read more than once, jobs that take a table part by part, and connected components on top of it."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a part has, about, where a job takes its tables part by part, and how many parts there are at most.
PART_ROWS, MOST_PARTS = 4_000_000, 64
#: Shuffles of a query are deleted when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; only where none is named and everything runs in one process, a local folder is made."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-", dir="/tmp"))
    return sc.getCheckpointDir()


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors all reach; one made within passing() goes with it."""
    folder = f"{shared_folder(spark)}/{os.urandom(8).hex()}"
    if (made := _made.get()) is not None:
        made.append(folder)
    return folder


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end all folders that were made within: for jobs whose result is written elsewhere by then."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for folder in made:
            remove(spark, folder)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Writes within leave no shuffle files behind."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def save(df: DataFrame, folder: str, *by: str) -> None:
    """Add the rows to the Parquet table under `folder`, parted by the columns `by`; their shuffles go when they are written."""
    with tidy(df.sparkSession):
        df.write.mode("append").option("compression", "zstd").parquet(folder, partitionBy=list(by) or None)


def cut(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder; what follows reads them from there, and only the columns it needs."""
    spark = df.sparkSession
    folder = scratch(spark)
    if any("void" in kind for _, kind in df.dtypes):  # which Parquet doesn't know
        return df.checkpoint(eager=True)
    save(df, folder)
    return spark.read.schema(df.schema).parquet(folder)


def kept(spark: SparkSession, job: Callable[[], DataFrame]) -> DataFrame:
    """cut(job()), after which everything else that the job wrote is deleted."""
    folder = scratch(spark)
    with passing(spark):
        out = job()
        save(out, folder)
    return spark.read.schema(out.schema).parquet(folder)


def by_parts(job: Callable[..., DataFrame], *tables: tuple[DataFrame, Column]) -> DataFrame:
    """job(*tables), for written tables, each with a key, of which the job brings together rows of equal keys only.

    Where they have more than PART_ROWS rows, they are parted by a hash of the key, and the job takes one part of each after another. What it
    writes and shuffles is deleted after each part, so the disk that it needs follows a part and not the table. Rows of one key are in one part."""
    spark = tables[0][0].sparkSession
    parts = min(MOST_PARTS, -(-sum(d.count() for d, _ in tables) // PART_ROWS))
    if parts <= 1:
        return job(*[d for d, _ in tables])
    result, dealt = scratch(spark), []
    with passing(spark):
        for d, key in tables:
            dealt.append((scratch(spark), T.StructType([*d.schema, T.StructField("_part", T.IntegerType())])))
            save(d.withColumn("_part", F.pmod(F.xxhash64(key, F.lit("part")), F.lit(parts)).cast("int")), dealt[-1][0], "_part")
        for k in range(parts):
            with passing(spark):
                out = job(*[spark.read.schema(schema).parquet(folder).where(F.col("_part") == k).drop("_part") for folder, schema in dealt])
                save(out, result)
            for folder, _ in dealt:
                remove(spark, f"{folder}/_part={k}")
    return spark.read.schema(out.schema).parquet(result)


def counted(df: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """cut(), with the number of rows and an order-free digest of them, taken while they are written."""
    seen = Observation()
    out = cut(df.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*df.columns)).alias("x")))
    return out, (seen.get["n"], seen.get["x"])


def small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """A narrow table, written and counted, with the hint to broadcast it if it has no more rows than `most` (of some 100 bytes)."""
    out, (n, _) = counted(df)
    return F.broadcast(out) if n <= most else out


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an undirected edge list (a, b); root is the smallest node that can be reached.

    Large stars and small stars are contracted in turn, by joins and minima alone: no component is ever in one place."""
    low_first = lambda d: d.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e, mark = counted(low_first(edges))
    while mark[0]:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").where("b <> low").select("b", "low").toDF("a", "b").union(least.toDF("a", "b"))
        before, (e, mark) = mark, counted(low_first(small))
        if mark == before:
            break
    return e.toDF("node", "root").union(e.select("b", "b").distinct())
