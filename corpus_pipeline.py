"""A corpus from raw documents to shards: five operators of corundum.llm, one after the other.

Each stage gets all rows its predecessor kept; run() writes every stage's rows to the shared folder and reads them again.

All stages hand on every column of their input, whatever it is named, and take an empty table to an empty one. A null, empty or
blank text is a document without words: it isn't toxic, has no near copies and no benchmark passage, is in the mix as often as its
place says and has size 1 in its shard. Very long texts are processed whole. A row whose doc_id is null stays like any other. What
happens to repeated rows is said at each stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corundum.llm._spark import cut, shared_folder, small, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold of their language (the default where lang is null); equal texts of one
    language stay or go together."""
    from corundum.llm.toxicity import fit

    classifier = fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(~classifier.flag(classifier.score("text"), F.col("lang")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id. Rows that repeat both id and text are one document
    and stay or go together; rows that repeat an id with other texts are documents of their own. Rows without an id go
    where their group has a row with one, and stay together where none has."""
    from corundum.llm.minhash import near_duplicates

    found = near_duplicates(docs).where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = small(cut(found.select(F.col("doc_id").alias("gone_id"), F.col("raw").alias("gone_raw")).distinct()))
    raw = F.unhex(F.md5(F.coalesce(docs["text"], F.lit(""))))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"]) & (raw == gone["gone_raw"]), "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs; each row is judged by its own text."""
    from corundum.llm.decontaminate import decontaminate

    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    return decontaminate(whole, table(spark, sf_dir, "benchmark"), text="doc.text").where("n_hit = 0").select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it; rows of equal id, text and source are taken equally often."""
    from corundum.llm.mixing import repeat_rows

    return repeat_rows(docs)


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its size, text_crc32, shard and slot (they replace columns of these names); repeated rows get slots of their own."""
    from corundum.llm.sharding import shard

    return shard(docs, whole_rows=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`: the rows of the finished corpus, with size, text_crc32, shard and slot."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark)
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return docs


#: The first stage trains a model, which SQL can't express. tests/llm/test_pipeline.py compares each other stage with brute force on its own
#: input, and the first with its classifier's scores row by row.
ORACLE_SQL = None
