"""Corpus identity, manifest and artifact selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corundum.functions.scalars import blank, filled, normalize_paper_path


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content) of every PDF below a folder, whatever the case of its suffix."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[pP][dD][fF]").load(folder).select("path", "content")


def corpus_dedup(files: DataFrame) -> DataFrame:
    """paper_uid and path of each distinct content; the first path in case-folded order stays.

    The content is dropped as soon as it is hashed, and the first path is a map-side minimum."""
    ids = files.select(F.substring(F.sha2("content", 256), 1, 12).alias("paper_uid"), "path")
    return ids.groupBy("paper_uid").agg(F.min_by("path", F.struct(F.lower("path"), "path")).alias("path"))


def manifest_upsert(manifest: DataFrame, updates: DataFrame, prune_to: DataFrame | None = None) -> DataFrame:
    """The manifest with new facts; blank or missing ones never overwrite. prune_to: papers that stay."""
    columns = [c for c in manifest.columns if c != "paper_uid"]
    new = updates.select("paper_uid", *[(filled(c) if t == "string" else F.col(c)).alias(f"n_{c}") for c, t in updates.dtypes if c in columns])
    known = [c for c in columns if f"n_{c}" in new.columns]
    out = manifest.join(new, "paper_uid", "full").select("paper_uid", *[F.coalesce(f"n_{c}", c).alias(c) if c in known else F.col(c) for c in columns])
    return out if prune_to is None else out.join(prune_to.select("paper_uid").distinct(), "paper_uid", "left_semi")


def load_manifest_papers(manifest: DataFrame, parsed: DataFrame) -> DataFrame:
    """Papers of the manifest with what was parsed of them; those without a parse stay, marked incomplete."""
    facts = parsed.select("paper_uid", *[F.col(c).alias(f"p_{c}") for c in parsed.columns if c != "paper_uid"], F.lit(True).alias("parse_complete"))
    both = [c for c in manifest.columns if c != "paper_uid"]
    j = manifest.join(facts, "paper_uid", "left")
    own = [F.coalesce(filled(f"p_{c}"), F.col(c)).alias(c) if f"p_{c}" in facts.columns else F.col(c) for c in both]
    more = [F.col(f"p_{c}").alias(c) for c in parsed.columns if c != "paper_uid" and c not in both]
    return j.select("paper_uid", *own, *more, F.coalesce("parse_complete", F.lit(False)).alias("parse_complete"))


def select_artifacts(artifacts: DataFrame, papers: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """One artifact per paper and kind, with its resolved uid.

    The uid is the artifact's own (score 2), else that of a DOI only one paper has, else that of the one paper its records' names lead to
    (score 1); artifacts outside the manifest go; the best score wins, ties the last file name."""
    named = papers.where(~blank("paper_uid"))
    one = lambda key, name: named.select(key.alias(name), "paper_uid").where(~blank(name)).groupBy(name).agg(F.count("*").alias("n"), F.first("paper_uid").alias(f"u_{name}"))
    by_doi = one(F.lower(F.trim(F.coalesce("doi", F.lit("")))), "k_doi").where("n = 1").drop("n")
    by_name = named.select(normalize_paper_path("pdf_path").alias("name"), F.col("paper_uid").alias("u"))
    a = artifacts.withColumn("k_doi", F.lower(F.trim(F.coalesce("doi", F.lit("")))))
    names = a.select("file_name", F.explode(F.array_distinct(F.transform("records", lambda r: r["paper_id"]))).alias("raw")).where(~blank("raw")).select("file_name", normalize_paper_path("raw").alias("name")).join(by_name, "name")
    names = names.groupBy("file_name").agg(F.min("u").alias("lo"), F.max("u").alias("hi")).where("lo = hi").select("file_name", F.col("lo").alias("u_name"))
    a = a.join(by_doi, "k_doi", "left").join(names, "file_name", "left")
    uid = F.coalesce(filled("paper_uid"), F.col("u_k_doi"), F.col("u_name"))
    a = a.withColumn("score", F.when(~blank("paper_uid"), 2).when(uid.isNotNull(), 1).otherwise(0)).withColumn("paper_uid", uid)
    if manifest is not None:
        a = a.join(manifest.select("paper_uid").distinct(), "paper_uid", "left_semi")
    w = Window.partitionBy(F.coalesce("paper_uid", "doi"), "kind").orderBy(F.col("score").desc(), F.col("file_name").desc())
    return a.withColumn("nth", F.row_number().over(w)).where("nth = 1").select(*artifacts.columns, "score")


def pair_screening(papers: DataFrame, screenings: DataFrame) -> DataFrame:
    """Each paper with its screening: the last of its uid, else the only one of its DOI without uid, else defaults.

    Screenings are (seq, paper_uid, doi, extraction_priority, complexity, estimated_records)."""
    facts = ["extraction_priority", "complexity", "estimated_records"]
    by_uid = screenings.where(~blank("paper_uid")).groupBy("paper_uid").agg(F.max_by(F.struct(*facts), "seq").alias("u"))
    by_doi = screenings.where(blank("paper_uid")).groupBy("doi").agg(F.count("*").alias("n"), F.first(F.struct(*facts)).alias("d")).where("n = 1").select("doi", "d")
    default = {"extraction_priority": F.lit("medium"), "complexity": F.lit("moderate"), "estimated_records": F.lit(0).cast("bigint")}
    s = F.coalesce("u", "d")
    return papers.join(by_uid, "paper_uid", "left").join(by_doi, "doi", "left").select(*papers.columns, s.isNotNull().alias("screened"), *[F.when(s.isNotNull(), s[c]).otherwise(v).alias(c) for c, v in default.items()])


def route_extraction(papers: DataFrame, screenings: DataFrame, artifacts: DataFrame, force: bool = False) -> DataFrame:
    """(paper_uid, kind) of the work that is left: no skipped papers, no papers whose artifact of the needed kind is complete.

    Papers with data tables need a table artifact, others a text one."""
    paired = pair_screening(papers, screenings).where(F.lower("extraction_priority") != "skip")
    work = paired.select("paper_uid", F.when(F.size("data_tables") > 0, "table").otherwise("text").alias("kind"))
    done = artifacts.where("complete").select("paper_uid", "kind").distinct()
    return work if force else work.join(done, ["paper_uid", "kind"], "left_anti")
