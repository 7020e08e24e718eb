"""Reference and prediction tables in, the exported table out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corundum.functions.lineage import PART_ROWS, cut, passing, tidy
from corundum.functions.scalars import extract_mean, normalize_paper_label
from corundum.operators.assembly import assemble, condition_key, coverage_ledger, coverage_summary, dedup_records, stable_order
from corundum.schema import COLUMNS, OUTPUT, OUTPUT_SCHEMA

REQUIRED = ("paper_id", "frequency_mhz", "temperature_c", "dielectric_constant", "loss_factor")
#: Other names of reference columns (fixed values).
ALIASES = {
    "paper": "paper_id", "source": "paper_id", "material": "material_name", "frequency": "frequency_mhz", "freq_mhz": "frequency_mhz", "frequency_(mhz)": "frequency_mhz",
    "temperature": "temperature_c", "temp_c": "temperature_c", "moisture": "moisture_content_pct", "moisture_content": "moisture_content_pct", "moisture_pct": "moisture_content_pct",
    "epsilon_prime": "dielectric_constant", "eps_prime": "dielectric_constant", "epsilon_double_prime": "loss_factor", "eps_double_prime": "loss_factor", "salt": "salt_content", "conductivity": "electrical_conductivity_s_m",
}
NUMBERS = ("frequency_mhz", "temperature_c", "moisture_content_pct", "electrical_conductivity_s_m", "dielectric_constant", "loss_factor")


def normalize_columns(df: DataFrame, required: Iterable[str] = REQUIRED) -> DataFrame:
    """Lower-case known column names, numbers from `mean ± error` cells, and paper_key; a missing column raises."""
    names: list[str] = []
    for c in df.columns:
        n = c.strip().lower().replace(" ", "_")
        names.append(ALIASES.get(n, n))
    df = df.toDF(*names)
    if gone := [c for c in required if c not in names]:
        raise ValueError(f"reference columns are missing: {gone}")
    df = df.withColumns({c: extract_mean(c) for c in NUMBERS if c in names})
    return df.withColumn("paper_key", normalize_paper_label("paper_id"))


def load_reference(spark: SparkSession, paths: list[str], fmt: str = "csv") -> DataFrame:
    """Reference rows of one or more CSV, TSV or Parquet inputs, each with its source_file."""
    out = None
    for p in paths:
        d = spark.read.parquet(p) if fmt == "parquet" else spark.read.csv(p, header=True, sep="\t" if fmt == "tsv" else ",")
        d = normalize_columns(d.select("*", F.col("_metadata.file_name").alias("source_file")))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def load_predictions(df: DataFrame) -> DataFrame:
    """Predictions with paper_key; a conductivity that an old table kept as salt moves to its own column."""
    d = df.withColumn("paper_key", normalize_paper_label("paper_id"))
    if "electrical_conductivity_s_m" not in d.columns:
        d = d.withColumn("electrical_conductivity_s_m", F.lit(None).cast("double"))
    if "salt_content" not in d.columns:
        return d
    value = F.regexp_extract("salt_content", r"(?i)^\s*([0-9]*\.?[0-9]+)\s*S\s*/\s*m\s*$", 1).try_cast("double")
    moves = F.coalesce(value.isNotNull() & F.col("electrical_conductivity_s_m").isNull(), F.lit(False))
    return d.withColumns({"electrical_conductivity_s_m": F.when(moves, value).otherwise(F.col("electrical_conductivity_s_m")), "salt_content": F.when(~moves, F.col("salt_content"))})


def export_frame(records: DataFrame) -> DataFrame:
    """The exported columns in order, missing ones as NULL, in the total order."""
    return stable_order(records.select(*[(F.col(c) if c in records.columns else F.lit(None)).cast(t).alias(c) for c, t in OUTPUT]))


def export_dataset(records: DataFrame, path: str, table: str | None = None, csv_codec: str = "none") -> None:
    """Write the table as CSV and Parquet under `path`, and as a catalog table; an empty one still has its schema. csv_codec may be gzip."""
    out = export_frame(records)
    with tidy(records.sparkSession):  # the sort's shuffle goes before the CSV is written
        out.write.mode("overwrite").parquet(f"{path}/parquet")
    back = records.sparkSession.read.parquet(f"{path}/parquet")
    # Cells as they are: no trimming, quotes doubled.
    back.write.mode("overwrite").csv(f"{path}/csv", header=True, escape='"', compression=csv_codec, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if table:
        back.write.mode("overwrite").saveAsTable(table)


def assembly_job(artifacts: DataFrame, papers: DataFrame, path: str, strict: bool = False, csv_codec: str = "none", **options) -> dict[str, DataFrame]:
    """Artifacts to the exported table under `path`, and from what was written: table, fingerprint, ledger and summary.

    strict raises where a selected paper yields nothing or is incomplete. options are those of assemble."""
    with passing(artifacts.sparkSession):
        export_dataset(assemble(artifacts, papers, **options), path, csv_codec=csv_codec)
    table = artifacts.sparkSession.read.parquet(f"{path}/parquet")
    ledger = coverage_ledger(table, artifacts, papers)
    return {"table": table, "fingerprint": dataset_fingerprint(table), "ledger": ledger, "summary": coverage_summary(ledger, strict)}


def _output(df: DataFrame) -> DataFrame:
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in OUTPUT])


def append_assemble(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The existing table with new rows, deduplicated anew; usable as the body of foreachBatch."""
    return dedup_records(_output(existing).unionByName(_output(new)))


#: Buckets of a maintained table unless said otherwise. It is the table's for good; take so many that a bucket is some gigabytes.
BUCKETS = 64


def append_to_table(new: DataFrame, path: str, buckets: int = BUCKETS) -> list[int]:
    """Add rows to the deduplicated Parquet table under `path`, made if absent; returns the buckets that were rewritten.

    The table is partitioned by a hash of the measurement condition without its moisture, the coarsest key by which rows displace one another. So
    rows of other buckets can't change: only the buckets that the new rows touch are read, deduplicated with them and overwritten. A row that was dropped
    before stays dropped, as what displaced it, or something better, is still there; the table equals that of all rows at once, and the same rows
    may come again. One writer at a time; a batch whose write fails is repeated whole. An empty `new` changes nothing."""
    spark = new.sparkSession
    key = condition_key()
    bucket = F.pmod(F.xxhash64(*[v for k, v in key.items() if k != "k_moisture"]), F.lit(buckets)).cast("int")
    sizes = lambda d: {r["bucket"]: r["count"] for r in d.groupBy("bucket").count().collect()}
    with passing(spark):
        rows = cut(_output(new).withColumn("bucket", bucket))
        added = sizes(rows)
        touched = sorted(added)
        if touched:
            rows.limit(0).write.mode("append").partitionBy("bucket").parquet(path)  # the folder, where there is none
            table = lambda some: spark.read.schema(f"{OUTPUT_SCHEMA}, bucket int").parquet(path).where(F.col("bucket").isin(some))
            there = sizes(table(touched))
            for some in _batches(touched, {b: n + there.get(b, 0) for b, n in added.items()}):
                with passing(spark):
                    # Written elsewhere first, as Spark can't overwrite what it reads.
                    merged = cut(dedup_records(table(some).unionByName(rows.where(F.col("bucket").isin(some)))))
                    with tidy(spark):
                        merged.hint("rebalance", "bucket").write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("bucket").parquet(path)
    return touched


def _batches(buckets: list[int], rows: dict[int, int]) -> list[list[int]]:
    """The buckets in batches of PART_ROWS rows at most, or of one bucket: one batch is on disk twice at a time."""
    out, n = [], PART_ROWS
    for b in buckets:
        if n + rows[b] > PART_ROWS:
            out, n = [*out, []], 0
        out[-1].append(b)
        n += rows[b]
    return out


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a maintained table."""
    return spark.read.schema(f"{OUTPUT_SCHEMA}, bucket int").parquet(path).select(*COLUMNS)


def dataset_fingerprint(df: DataFrame, by: str = "paper_uid") -> DataFrame:
    """Rows, distinct models and an order-free SHA-256 per paper: of the sums of four parts of the rows' own canonical hashes.

    Sums are combined on the map side, so a paper with a large share of the rows is no list in one place."""
    text = lambda c, t: F.coalesce(F.when(F.col(c).isNotNull(), F.format_string("%.6f", F.col(c))) if t in ("double", "float") else F.col(c).cast("string"), F.lit("\\N"))
    row = F.sha2(F.concat_ws("|", *[text(c, t) for c, t in sorted(df.dtypes)]), 256)
    parts = [F.sum(F.conv(F.substring("h", 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")).cast("string") for k in range(4)]
    rows = df.select(F.col(by), row.alias("h"), "extraction_model")
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.countDistinct("extraction_model").alias("models"), F.sha2(F.concat_ws(",", *parts), 256).alias("sha256"))
