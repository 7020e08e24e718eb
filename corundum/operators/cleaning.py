"""Filters between extraction and assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corundum.functions.scalars import blank, col, rounded
from corundum.operators.assembly import JOINED, merge_pairs


def near_any(frequency: str | Column, known: str | Column, tol: float) -> Column:
    return F.exists(col(known), lambda x: (x > 0) & (F.abs(col(frequency) - x) / x < tol))


def filter_cited(records: DataFrame, papers: DataFrame, tol: float = 0.05) -> DataFrame:
    """Drop values that a paper cites from others: without value or source table, at foreign frequencies, of foreign materials.

    Rows of regression tables pass. A paper without frequencies or materials doesn't test them; with at most two materials
    a foreign name is replaced by the first."""
    facts = papers.select("paper_uid", F.col("measurement_frequencies_mhz").alias("_f"), F.col("primary_materials").alias("_m")).dropDuplicates(["paper_uid"])
    d = records.where((F.col("dielectric_constant").isNotNull() | F.col("loss_factor").isNotNull()) & (F.coalesce("source_table", F.lit("")) != "")).join(facts, "paper_uid", "left")
    own = F.lower("source_table").contains("regression")
    known = F.concat("_f", F.array(F.lit(915.0), F.lit(2450.0)))
    frequency = (F.coalesce(F.size("_f"), F.lit(0)) <= 0) | F.col("frequency_mhz").isNull() | near_any("frequency_mhz", known, tol)
    name = F.lower("material_name")
    first = lambda c: F.get(F.split(F.trim(c), r"\s+"), F.lit(0))
    ok = F.exists("_m", lambda m: name.contains(F.lower(m)) | F.lower(m).contains(name) | (first(F.lower(m)) == first(name)))
    tested = F.coalesce(F.size("_m"), F.lit(0)) > 0
    foreign = tested & ~F.coalesce(ok, F.lit(False))
    d = d.where(own | (frequency & (~foreign | (F.size("_m") <= 2))))
    return d.withColumn("material_name", F.when(~own & foreign, F.get("_m", F.lit(0))).otherwise(F.col("material_name"))).select(*records.columns)


#: Frequencies that running text may name where neither metadata nor tables do, MHz (fixed values).
NAMED = (27.0, 40.0, 433.0, 915.0, 1800.0, 2450.0)


def known_frequencies(papers: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """(paper_uid, _f): a paper's own frequencies, else the MHz values of its table headers, else well-known ones of its first 5000 characters."""
    own = F.when(F.size("measurement_frequencies_mhz") > 0, F.col("measurement_frequencies_mhz"))
    said = F.lit(None).cast("array<double>")
    if "full_text" in papers.columns:
        numbers = F.regexp_extract_all(F.lower(F.substring("full_text", 1, 5000)), F.lit(r"([0-9]+)\s*mhz"), F.lit(1))
        said = F.array_intersect(F.transform(numbers, lambda x: x.try_cast("double")), F.array(*[F.lit(x) for x in NAMED]))
    p = papers.where(~blank("paper_uid")).groupBy("paper_uid").agg(F.min(own).alias("_own"), F.min(said).alias("_said"))
    if tables is None:
        return p.select("paper_uid", F.coalesce("_own", "_said").alias("_f"))
    values = F.flatten(F.transform(F.flatten("headers"), lambda h: F.regexp_extract_all(h, F.lit(r"(?i)([0-9]+(?:\.[0-9]+)?)\s*MHz"), F.lit(1))))
    heads = tables.select("paper_uid", F.explode(F.array_distinct(values)).alias("v")).groupBy("paper_uid").agg(F.collect_set(F.col("v").try_cast("double")).alias("_head"))
    return p.join(heads, "paper_uid", "left").select("paper_uid", F.coalesce("_own", "_head", "_said").alias("_f"))


def filter_text_records(records: DataFrame, papers: DataFrame, tables: DataFrame | None = None, tol: float = 0.05) -> DataFrame:
    """Text records with both properties at a frequency of their paper; a paper of which none is known tests nothing."""
    d = records.where("dielectric_constant is not null and loss_factor is not null").join(known_frequencies(papers, tables), "paper_uid", "left")
    return d.where((F.coalesce(F.size("_f"), F.lit(0)) <= 0) | F.col("frequency_mhz").isNull() | near_any("frequency_mhz", "_f", tol)).select(*records.columns)


def sanity_filter(records: DataFrame) -> DataFrame:
    """Drop ε′ outside 0.1 to 120 and ε″ outside 0 to 2000; NULL passes."""
    return records.where(F.coalesce(F.col("dielectric_constant").between(0.1, 120), F.lit(True)) & F.coalesce(F.col("loss_factor").between(0, 2000), F.lit(True)))


def merge_split_extraction(records: DataFrame) -> DataFrame:
    """Merge the two halves of a measurement within one paper's extraction; provenance is part of the key, NULL equals NULL."""
    text = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))
    key = {
        "k_paper": F.col("paper_uid"),
        "k_material": text("material_name"),
        "k_frequency": rounded("frequency_mhz", 1),
        "k_temperature": rounded("temperature_c", 1),
        "k_moisture": rounded("moisture_content_pct", 1),
        "k_basis": F.replace(F.lower(F.trim(F.when(blank("moisture_basis"), "unknown").otherwise(F.col("moisture_basis")))), F.lit(" basis"), F.lit("")),
        "k_salt": text("salt_content"),
        "k_conductivity": rounded("electrical_conductivity_s_m", 4),
        "k_provenance": text("data_provenance"),
    }
    return merge_pairs(records, key, [c for c in JOINED if c != "data_provenance"])
