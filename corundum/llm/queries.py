"""The registered queries of the corpus operators: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corundum.llm import licenses, mixing, quality
from corundum.llm._spark import cut, shared_folder, table


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corundum.llm.minhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)
    return found.drop("raw").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corundum.llm.toxicity import fit, held_out

    docs = table(spark, sf_dir, "documents")
    classifier = fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", "lang", held_out(F.col("doc_id")).alias("held_out"), classifier.score("text").alias("score"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), classifier.flag("score", "lang").alias("flagged"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corundum.llm.decontaminate import decontaminate

    found = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corundum.llm.warc import read_chunks, record_index, remove_archives, write_archives

    folder = shared_folder(spark)
    manifest = write_archives(table(spark, sf_dir, "pages"), folder)
    index = cut(record_index(read_chunks(manifest, folder, with_data=False)))
    remove_archives(spark, folder)
    return index


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corundum.llm.sharding import shard

    return shard(table(spark, sf_dir, "documents")).withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corundum.llm.passages import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corundum.llm.html_text import extract

    found = table(spark, sf_dir, "pages").select("page_id", "url", extract("html").alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corundum.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corundum.llm.vector_codes import compress

    return compress(table(spark, sf_dir, "embeddings"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corundum.llm.packing import pack, pieces

    return pack(pieces(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_license_scan, op3_decontaminate, op4_quality_rules, op5_warc, op6_sharding, op7_substring_dedup, op8_html_text, op9_mixing, op10_minhash_near_dedup, op11_embedding_whitening, op12_vector_codes, op13_best_fit_packing)}
ORACLES: dict[str, str] = {"op2_license_scan": licenses.ORACLE, "op4_quality_rules": quality.ORACLE, "op9_mixing": mixing.ORACLE}
