"""Run state and the measurement table kept up to date by streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from corundum.operators.state import checkpoint_fold
from corundum.sources.tables import BUCKETS, append_to_table


def fold_stream(events: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A stream of checkpoint events folded into the current row of each paper; start() runs it.

    The state of a paper is that of checkpoint_fold's aggregates, each value with the time and id of its event. So order of arrival is of no account:
    late events take their place by event time, ties by id, and the state's size is that of the papers, however many events they have. Every
    batch writes the papers it changed to its own folder under `path`, which is replaced if the batch is repeated. Each event must come once,
    as costs are added up."""

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return checkpoint_fold(events).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)


def current_state(spark: SparkSession, path: str) -> DataFrame:
    """The latest row of each paper that fold_stream wrote."""
    rows = spark.read.parquet(path)
    fields = [c for c in rows.columns if c not in ("batch", "paper")]
    return rows.groupBy("paper").agg(F.max_by(F.struct(*fields), "batch").alias("r")).select("paper", "r.*")


def append_stream(records: DataFrame, path: str, checkpoint: str, buckets: int = BUCKETS) -> DataStreamWriter:
    """A stream of measurement rows merged into the maintained table under `path`; a batch may be repeated."""
    return records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, _: append_to_table(batch, path, buckets))
