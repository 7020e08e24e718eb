"""Sources, cleaning, costs and run state over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corundum.functions.lineage import by_parts, scratch
from corundum.functions.scalars import artifact_name, is_uid, slugify, split_artifact_name
from corundum.operators import cleaning as C
from corundum.operators import state as S
from corundum.plans.assembly_queries import COLS, artifacts, dedup, merge
from corundum.plans.fixtures import ctes, frame
from corundum.schema import COLUMNS, OUTPUT
from corundum.sources import corpus, tables
from corundum.streaming import runs

PRICES = [("small", 0.25, 1.25), ("large", 3.0, 15.0)]


def _prices(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(i).alias("input"), F.lit(o).alias("output")) for m, i, o in PRICES])))


def _costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.cost_ledger(frame(spark, sf_dir, "usage"), _prices(spark), 0.5)


def _screenings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = frame(spark, sf_dir, "orders")
    known = F.col("o_orderkey") % 3 != 2  # the others name papers that no manifest has
    uid = F.substring(F.sha2(F.concat(F.when(known, "c").otherwise("s"), F.col("o_custkey").cast("string")), 256), 1, 12)
    return o.select(
        F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderkey") % 5 != 0, uid).otherwise("").alias("paper_uid"), F.concat(F.when(known, "10.2000/C").otherwise("10.2000/S"), F.col("o_custkey").cast("string")).alias("doi"),
        F.when(F.col("o_orderpriority").startswith("5"), "skip").otherwise(F.lower("o_orderpriority")).alias("extraction_priority"), F.col("o_orderstatus").alias("complexity"), (F.col("o_orderkey") % 7).cast("bigint").alias("estimated_records"),
    )


SCREEN = """s AS (SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 5 <> 0 THEN substr(sha256(CASE WHEN o_orderkey % 3 <> 2 THEN 'c' ELSE 's' END || o_custkey), 1, 12) ELSE '' END AS paper_uid, CASE WHEN o_orderkey % 3 <> 2 THEN '10.2000/C' ELSE '10.2000/S' END || o_custkey AS doi,
  CASE WHEN o_orderpriority LIKE '5%' THEN 'skip' ELSE lower(o_orderpriority) END AS extraction_priority, o_orderstatus AS complexity, (o_orderkey % 7)::BIGINT AS estimated_records FROM orders),
u AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY paper_uid ORDER BY seq DESC) AS nth FROM s WHERE paper_uid <> '') WHERE nth = 1),
d AS (SELECT doi, min(extraction_priority) AS extraction_priority, min(complexity) AS complexity, min(estimated_records) AS estimated_records FROM s WHERE paper_uid = '' GROUP BY 1 HAVING count(*) = 1),
x AS (SELECT m.*, u.seq IS NOT NULL OR d.doi IS NOT NULL AS screened,
  CASE WHEN u.seq IS NOT NULL THEN u.extraction_priority ELSE coalesce(d.extraction_priority, 'medium') END AS extraction_priority, CASE WHEN u.seq IS NOT NULL THEN u.complexity ELSE coalesce(d.complexity, 'moderate') END AS complexity,
  CASE WHEN u.seq IS NOT NULL THEN u.estimated_records ELSE coalesce(d.estimated_records, 0) END AS estimated_records FROM manifest m LEFT JOIN u ON u.paper_uid = m.paper_uid LEFT JOIN d ON d.doi = m.doi)"""
ARTIFACTS = "a AS (SELECT DISTINCT substr(sha256(CASE WHEN o_orderkey % 10 < 6 THEN 'c' ELSE 'a' END || o_custkey), 1, 12) AS paper_uid, CASE WHEN o_orderkey % 2 = 0 THEN 'table' ELSE 'text' END AS kind, o_orderkey % 4 < 3 AS complete FROM orders)"


def _route(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = frame(spark, sf_dir, "manifest").withColumn("data_tables", F.when(F.col("year") % 2 == 0, F.array(F.lit("table_1"))).otherwise(F.array().cast("array<string>")))
    a = frame(spark, sf_dir, "orders").select(F.substring(F.sha2(F.concat(F.when(F.col("o_orderkey") % 10 < 6, "c").otherwise("a"), F.col("o_custkey").cast("string")), 256), 1, 12).alias("paper_uid"), F.when(F.col("o_orderkey") % 2 == 0, "table").otherwise("text").alias("kind"), (F.col("o_orderkey") % 4 < 3).alias("complete"))
    return corpus.route_extraction(papers, _screenings(spark, sf_dir), a)


def _select(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = frame(spark, sf_dir, "papers")
    keep = papers.where("parse_complete")
    return corpus.select_artifacts(artifacts(spark, sf_dir), papers, keep).select("file_name", "paper_uid", "kind", "score")


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.load_predictions(frame(spark, sf_dir, "pred").drop("paper_key")).select("pred_id", "paper_key", "salt_content", "electrical_conductivity_s_m")


def _raw_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold rows as a reference file has them: headers in other words, numbers with errors."""
    g = frame(spark, sf_dir, "gold")
    number = lambda c: F.format_string("%.1f", c)
    return g.select(
        F.col("paper_id").alias(" Paper "),
        F.concat(number("frequency_mhz"), F.lit(" ± 0.5")).alias("Frequency"),
        number("temperature_c").alias("Temperature"),
        F.concat(F.lit("−"), number("dielectric_constant"), F.lit(" +/- 1")).alias("eps_prime"),
        F.when(F.col("loss_factor") > 5, number("loss_factor")).otherwise("n.d.").alias("Loss_Factor"),
    )


def _reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reference files, one of commas and one of tabs, read back."""
    raw, folder = _raw_reference(spark, sf_dir), scratch(spark)
    few = F.col(" Paper ").startswith("1")
    raw.where(few).write.option("header", "true").csv(f"{folder}/some.csv")
    raw.where(~few).write.option("header", "true").option("sep", "\t").csv(f"{folder}/rest.tsv")
    files = tables.load_reference(spark, [f"{folder}/some.csv"]).unionByName(tables.load_reference(spark, [f"{folder}/rest.tsv"], "tsv"))
    return files.select("paper_key", "frequency_mhz", "temperature_c", "dielectric_constant", "loss_factor")


def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported table as its Parquet and CSV files have it, each row with the number of files it is in."""
    folder = scratch(spark)
    tables.export_dataset(frame(spark, sf_dir, "records").drop("journal"), folder, csv_codec="gzip")
    types = ", ".join(f"{c} {t}" for c, t in OUTPUT)
    back = spark.read.parquet(f"{folder}/parquet").unionByName(spark.read.schema(types).csv(f"{folder}/csv", header=True, escape='"'))
    text = [F.coalesce(c, F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in OUTPUT]
    return by_parts(lambda d: d.groupBy(*COLUMNS).agg(F.count("*").alias("n")), (back.select(*text), F.xxhash64(*COLUMNS)))


def _append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of every second year, to which the other years are added bucket by bucket."""
    r, folder = frame(spark, sf_dir, "records"), scratch(spark)
    for rows in (r.where("year % 2 = 0"), r.where("year % 2 <> 0")):
        tables.append_to_table(rows, folder, 8)
    return tables.read_table(spark, folder)


def _fold_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in six files, shuffled, that a stream takes two at a time."""
    folder, e = scratch(spark), frame(spark, sf_dir, "checkpoint_events")
    e.repartition(6, F.xxhash64("event_id", F.lit("file"))).write.parquet(f"{folder}/in")
    events = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
    runs.fold_stream(events, f"{folder}/out", f"{folder}/progress").trigger(availableNow=True).start().awaitTermination()
    return runs.current_state(spark, f"{folder}/out")


def _reads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    r = frame(spark, sf_dir, "records").select("*", F.coalesce(F.nullif("source_table", F.lit("")), F.lit("Table 0")).alias("table_id"), F.when(F.col("data_provenance") == "vision_table", "image").when(F.col("extraction_model") == "model-0", "image").otherwise("text").alias("read"))
    t = r.groupBy("paper_uid", "paper_id", "table_id").agg((F.count("*") / 2).cast("bigint").alias("n_rows")).groupBy("paper_uid", "table_id").agg(F.sum("n_rows").alias("n_rows"))
    return r, t.select("*", (F.col("n_rows") % 3 == 0).alias("damaged"), (F.col("n_rows") % 5 == 0).alias("missing"), (F.col("table_id") == "Table 5").alias("is_equation"))


READS = """r AS (SELECT *, coalesce(nullif(source_table, ''), 'Table 0') AS table_id, CASE WHEN data_provenance = 'vision_table' OR extraction_model = 'model-0' THEN 'image' ELSE 'text' END AS read FROM records),
t AS (SELECT paper_uid, table_id, sum(n)::BIGINT AS n_rows FROM (SELECT paper_uid, paper_id, table_id, count(*) // 2 AS n FROM r GROUP BY ALL) GROUP BY 1, 2),
c AS (SELECT t.*, count(*) FILTER (read = 'text' AND (t.table_id = 'Table 5' OR (dielectric_constant IS NOT NULL AND loss_factor IS NOT NULL))) AS ut, count(*) FILTER (read = 'image' AND (t.table_id = 'Table 5' OR (dielectric_constant IS NOT NULL AND loss_factor IS NOT NULL))) AS ui, count(*) FILTER (read = 'text') AS nt
  FROM t JOIN r USING (paper_uid, table_id) GROUP BY ALL),
w AS (SELECT paper_uid, table_id, CASE WHEN ui > ut AND (table_id = 'Table 5' OR (n_rows >= 3 AND (ut < 0.5 * n_rows OR nt = 0 OR n_rows % 3 = 0 OR n_rows % 5 = 0))) THEN 'image' ELSE 'text' END AS read FROM c)"""


def _with(job, *names, **more):
    return lambda spark, sf_dir: job(*[frame(spark, sf_dir, n) for n in names], **more)


def _artifact_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of artifacts, and what is read from them; every fifth year's are of no artifact, and every seventh's uids in capitals."""
    m = frame(spark, sf_dir, "manifest")
    name = F.when(F.col("year") % 5 != 0, artifact_name("paper_uid", "pdf_path")).otherwise(slugify(F.concat("title", F.lit(" – __"), "pdf_path", F.lit("!")), 20))
    d = m.select("paper_uid", name.alias("name"), F.when(F.col("year") % 7 == 0, F.upper("paper_uid")).otherwise(F.col("paper_uid")).alias("shown"))
    parts = split_artifact_name("name")
    return d.select("paper_uid", "name", parts["uid"].alias("uid"), parts["slug"].alias("slug"), is_uid("shown").alias("known"))


def _slug_sql(c: str, most: int) -> str:
    return f"coalesce(nullif(trim(substr(regexp_replace(regexp_replace(regexp_replace({c}, '[^a-zA-Z0-9_-]+', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g'), 1, {most})), ''), 'paper')"


def _told(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The papers with a text that names frequencies; a third of those that list frequencies don't any more."""
    none = F.array().cast("array<double>")
    year = F.col("year") % 3
    text = F.when(year == 1, "Measured at 2450 MHz and 5 MHz.").otherwise("Measured in the field.")
    return frame(spark, sf_dir, "papers").withColumns({"measurement_frequencies_mhz": F.when(year == 0, none).otherwise(F.col("measurement_frequencies_mhz")), "full_text": text})


def _headed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for every second year's papers, with frequencies in its headers."""
    headers = F.array(F.array(F.lit("ε' 27.12 MHz"), F.lit("x")), F.array(F.lit("915MHz"), F.lit("n")))
    return frame(spark, sf_dir, "papers").select(F.when(F.col("year") % 2 == 0, F.col("paper_uid")).otherwise(F.concat(F.lit("x"), F.col("paper_uid"))).alias("paper_uid"), headers.alias("headers"))


TOLD = """SELECT r.*, p.f FROM records r LEFT JOIN (SELECT paper_uid, any_value(CASE WHEN year % 3 <> 0 AND len(measurement_frequencies_mhz) > 0 THEN measurement_frequencies_mhz WHEN year % 2 = 0 AND paper_uid <> '' THEN [27.12::DOUBLE, 915::DOUBLE]
  WHEN year % 3 = 1 THEN [2450::DOUBLE] ELSE [] END) AS f FROM papers WHERE paper_uid <> '' GROUP BY 1) p USING (paper_uid)"""
TEXT = "lower(trim(coalesce({},'')))"
FREQ_OK = "(len(coalesce(f, [])) = 0 OR frequency_mhz IS NULL OR len(list_filter({k}, lambda x: x > 0 AND abs(frequency_mhz - x) / x < 0.05::DOUBLE)) > 0)"
MAT = "len(list_filter(m, lambda x: contains(lower(material_name), lower(x)) OR contains(lower(x), lower(material_name)) OR split_part(trim(lower(x)), ' ', 1) = split_part(trim(lower(material_name)), ' ', 1))) > 0"
JOINED = "SELECT r.*, p.f, p.m FROM records r LEFT JOIN (SELECT paper_uid, any_value(measurement_frequencies_mhz) AS f, any_value(primary_materials) AS m FROM papers GROUP BY 1) p USING (paper_uid)"
FOREIGN = f"(len(coalesce(m, [])) > 0 AND NOT {MAT})"
SAN = "WHERE coalesce(dielectric_constant BETWEEN 0.1 AND 120, TRUE) AND coalesce(loss_factor BETWEEN 0 AND 2000, TRUE)"
COST = "CASE model WHEN 'small' THEN (input_tokens * 0.25::DOUBLE + output_tokens * 1.25::DOUBLE) / 1e6 * 0.5::DOUBLE WHEN 'large' THEN (input_tokens * 3e0 + output_tokens * 15e0) / 1e6 * 0.5::DOUBLE ELSE 0 END"
FOLD = """SELECT paper, arg_max(status, (ts, event_id)) AS status, arg_max(pdf_path, (ts, event_id)) FILTER (pdf_path <> '') AS pdf_path, arg_max(screen_time, (ts, event_id)) FILTER (screen_time IS NOT NULL) AS screen_time,
  arg_max(error_message, (ts, event_id)) FILTER (error_message IS NOT NULL) AS error_message, sum(cost_cents)::BIGINT AS cost_cents FROM checkpoint_events GROUP BY paper"""
HASH = "sha256(concat_ws('|', " + ", ".join(f"coalesce({'printf(' + chr(39) + '%.6f' + chr(39) + ', ' + c + ')' if t == 'double' else f'CAST({c} AS VARCHAR)'}, '\\N')" for c, t in sorted(OUTPUT)) + "))"
SUMS = ", ".join(f"CAST(sum(CAST('0x' || substr(h, {1 + 15 * k}, 15) AS BIGINT)) AS VARCHAR)" for k in range(4))
QUERIES = {
    "corpus_dedup": lambda spark, sf_dir: corpus.corpus_dedup(frame(spark, sf_dir, "documents").select(F.concat(F.lit("Corpus/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".PDF")).alias("path"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content"))),
    "artifact_names": _artifact_names,
    "manifest_upsert": lambda spark, sf_dir: corpus.manifest_upsert(frame(spark, sf_dir, "manifest"), frame(spark, sf_dir, "updates"), frame(spark, sf_dir, "manifest").where("year % 9 <> 0").select("paper_uid").union(frame(spark, sf_dir, "updates").select("paper_uid"))),
    "load_manifest_papers": _with(corpus.load_manifest_papers, "manifest", "parsed"),
    "select_artifacts": _select,
    "pair_screening": lambda spark, sf_dir: corpus.pair_screening(frame(spark, sf_dir, "manifest"), _screenings(spark, sf_dir)),
    "route_extraction": _route,
    "load_reference": _reference,
    "load_predictions": _predictions,
    "export_dataset": _export,
    "append_assemble": lambda spark, sf_dir: tables.append_assemble(frame(spark, sf_dir, "records").where("year % 2 = 0"), frame(spark, sf_dir, "records").where("year % 2 <> 0")),
    "append_table": _append_table,
    "dataset_fingerprint": _with(tables.dataset_fingerprint, "records"),
    "filter_cited": _with(C.filter_cited, "records", "papers"),
    "filter_text_records": lambda spark, sf_dir: C.filter_text_records(frame(spark, sf_dir, "records"), _told(spark, sf_dir), _headed(spark, sf_dir)),
    "sanity_filter": _with(C.sanity_filter, "records"),
    "merge_split_extraction": _with(C.merge_split_extraction, "records"),
    "cost_ledger": _costs,
    "cost_rollup": lambda spark, sf_dir: S.cost_rollup(_costs(spark, sf_dir)),
    "checkpoint_fold": _with(S.checkpoint_fold, "checkpoint_events"),
    "checkpoint_stream": _fold_stream,
    "checkpoint_summary": lambda spark, sf_dir: S.checkpoint_summary(S.checkpoint_fold(frame(spark, sf_dir, "checkpoint_events"))),
    "cost_estimate": _with(S.cost_estimate, "orders", unit_costs={"screen": 0.005, "text": 0.1, "table": 0.15}, discount=0.5),
    "route_responses": _with(S.route_responses, "requests", "responses"),
    "better_read": lambda spark, sf_dir: S.better_read(*_reads(spark, sf_dir)).select(*COLUMNS, "table_id", "read"),
}
REC, RP = f"WITH {ctes('records')}", f"WITH {ctes('records', 'papers')}"
ORACLES = {
    "corpus_dedup": "SELECT substr(sha256(coalesce(text, '')), 1, 12) AS paper_uid, arg_min('Corpus/' || source || '/' || doc_id || '.PDF', (lower('Corpus/' || source || '/' || doc_id || '.PDF'), 'Corpus/' || source || '/' || doc_id || '.PDF')) AS path FROM documents GROUP BY 1",
    "artifact_names": f"""WITH {ctes('manifest')}, n AS (SELECT paper_uid, CASE WHEN year % 5 <> 0 THEN paper_uid || '__' || {_slug_sql('pdf_path', 60)} ELSE {_slug_sql("title || ' – __' || pdf_path || '!'", 20)} END AS name,
  CASE WHEN year % 7 = 0 THEN upper(paper_uid) ELSE paper_uid END AS shown FROM manifest)
SELECT paper_uid, name, CASE WHEN regexp_full_match(name, '[0-9a-f]{{12}}__.+') THEN left(name, 12) END AS uid, CASE WHEN regexp_full_match(name, '[0-9a-f]{{12}}__.+') THEN substr(name, 15) END AS slug, regexp_full_match(shown, '[0-9a-f]{{12}}') AS known FROM n""",
    "manifest_upsert": f"WITH {ctes('manifest', 'updates')} SELECT * FROM (SELECT coalesce(m.paper_uid, u.paper_uid) AS paper_uid, "
    + ", ".join(f"coalesce(nullif(CASE WHEN trim(u.{c}) <> '' THEN u.{c} END, ''), m.{c}) AS {c}" for c in ("pdf_path", "slug", "doi", "title"))
    + ", coalesce(u.year, m.year) AS year FROM manifest m FULL JOIN updates u ON m.paper_uid = u.paper_uid) WHERE paper_uid IN (SELECT paper_uid FROM manifest WHERE year % 9 <> 0 UNION SELECT paper_uid FROM updates)",
    "load_manifest_papers": f"WITH {ctes('manifest', 'parsed')} SELECT m.paper_uid, m.pdf_path, m.slug, coalesce(nullif(p.doi, ''), m.doi) AS doi, coalesce(nullif(p.title, ''), m.title) AS title, m.year, p.tables_found, p.paper_uid IS NOT NULL AS parse_complete FROM manifest m LEFT JOIN parsed p ON m.paper_uid = p.paper_uid",
    "select_artifacts": f"""WITH {ctes('papers', 'artifact_rows')}, f AS (SELECT DISTINCT artifact, artifact_uid, artifact_doi, kind FROM artifact_rows),
x AS (SELECT f.artifact AS file_name, f.kind, artifact_doi, coalesce(nullif(artifact_uid, ''), d.uid) AS paper_uid, CASE WHEN artifact_uid <> '' THEN 2 WHEN d.uid IS NOT NULL THEN 1 ELSE 0 END AS score FROM f
  LEFT JOIN (SELECT lower(doi) AS k, min(paper_uid) AS uid FROM papers WHERE doi <> '' AND paper_uid <> '' GROUP BY 1 HAVING count(*) = 1) d ON d.k = lower(artifact_doi))
SELECT file_name, paper_uid, kind, score FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY paper_uid, kind ORDER BY score DESC, file_name DESC) AS nth FROM x WHERE paper_uid IN (SELECT paper_uid FROM papers WHERE parse_complete)) WHERE nth = 1""",
    "pair_screening": f"WITH {ctes('manifest')}, {SCREEN} SELECT * FROM x",
    "route_extraction": f"WITH {ctes('manifest')}, {SCREEN}, {ARTIFACTS} SELECT paper_uid, kind FROM (SELECT paper_uid, CASE WHEN year % 2 = 0 THEN 'table' ELSE 'text' END AS kind FROM x WHERE extraction_priority <> 'skip') w WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.complete AND a.paper_uid = w.paper_uid AND a.kind = w.kind)",
    "load_reference": f"WITH {ctes('gold')} SELECT paper_key, frequency_mhz, temperature_c, -dielectric_constant AS dielectric_constant, CASE WHEN loss_factor > 5 THEN loss_factor END AS loss_factor FROM gold",
    "load_predictions": f"WITH {ctes('pred')} SELECT pred_id, paper_key, CASE WHEN salt_content = '0.5 S/m' THEN NULL ELSE salt_content END AS salt_content, CASE WHEN salt_content = '0.5 S/m' THEN 0.5 ELSE electrical_conductivity_s_m END AS electrical_conductivity_s_m FROM pred",
    "export_dataset": f"{REC} SELECT {', '.join(('' + chr(39) * 2 if c == 'journal' else f'coalesce({c}, ' + chr(39) * 2 + ')') + f' AS {c}' if t == 'string' else c for c, t in OUTPUT)}, 2 * count(*) AS n FROM records GROUP BY ALL",
    "append_assemble": f"{REC} {dedup('records')}",
    "append_table": f"{REC} {dedup('records')}",
    "dataset_fingerprint": f"{REC} SELECT paper_uid, count(*) AS n, count(DISTINCT extraction_model) AS models, sha256(concat_ws(',', {SUMS})) AS sha256 FROM (SELECT *, {HASH} AS h FROM records) GROUP BY 1",
    "filter_cited": f"{RP}, j AS ({JOINED}) SELECT CASE WHEN NOT contains(lower(source_table), 'regression') AND {FOREIGN} THEN m[1] ELSE material_name END AS material_name, {', '.join(COLUMNS[1:])} FROM j WHERE (dielectric_constant IS NOT NULL OR loss_factor IS NOT NULL) AND source_table <> '' AND (contains(lower(source_table), 'regression') OR ({FREQ_OK.format(k='list_concat(f, [915e0, 2450e0])')} AND (NOT {FOREIGN} OR len(m) <= 2)))",
    "filter_text_records": f"{RP}, j AS ({TOLD}) SELECT {COLS} FROM j WHERE dielectric_constant IS NOT NULL AND loss_factor IS NOT NULL AND {FREQ_OK.format(k='f')}",
    "sanity_filter": f"{REC} SELECT * FROM records {SAN}",
    "merge_split_extraction": f"{REC}, q AS (SELECT * FROM records) " + merge("q", 1, 4, key="paper_uid", extra=f", {TEXT.format('data_provenance')} AS k9").replace("coalesce(frequency_mhz, -999)", "frequency_mhz").replace("coalesce(temperature_c, -999)", "temperature_c").replace("coalesce(moisture_content_pct, -1)", "moisture_content_pct").replace("coalesce(electrical_conductivity_s_m, -1)", "electrical_conductivity_s_m").replace("IN ('wet','wet basis','wet-basis','wb','w.b.','w.b')", "IN ('wet','wet basis')"),
    "cost_ledger": f"WITH {ctes('usage')} SELECT *, {COST} AS cost_usd FROM usage",
    "cost_rollup": f"WITH {ctes('usage')} SELECT paper, stage, sum(input_tokens)::BIGINT AS input_tokens, sum(output_tokens)::BIGINT AS output_tokens, round(sum({COST}), 6) AS cost_usd FROM usage GROUP BY GROUPING SETS ((paper), (stage), ())",
    "checkpoint_fold": f"WITH {ctes('checkpoint_events')} {FOLD}",
    "checkpoint_stream": f"WITH {ctes('checkpoint_events')} {FOLD}",
    "checkpoint_summary": f"WITH {ctes('checkpoint_events')}, f AS ({FOLD}) SELECT status, count(*) AS cnt FROM f GROUP BY 1",
    "cost_estimate": "SELECT stage, round(n * unit * 0.5, 6)::DOUBLE AS cost FROM (SELECT count(*) AS n FROM orders), (VALUES ('screen', 0.005), ('text', 0.1), ('table', 0.15)) v(stage, unit)",
    "route_responses": f"""WITH {ctes('requests', 'responses')}, j AS (SELECT q.*, r.n_records, CASE WHEN r.custom_id IS NULL THEN 'unit ' || unit_no || ': no response' WHEN trim(text) = '' THEN 'unit ' || unit_no || ': empty response' WHEN NOT response_complete THEN 'unit ' || unit_no || ': incomplete response' END AS reason
  FROM requests q LEFT JOIN (SELECT * FROM responses QUALIFY ROW_NUMBER() OVER (PARTITION BY custom_id ORDER BY NOT coalesce(response_complete, FALSE), -coalesce(n_records, 0), text NULLS FIRST) = 1) r USING (custom_id))
SELECT paper_uid, kind, count(*) AS units, coalesce(sum(CASE WHEN reason IS NULL OR reason LIKE '%incomplete response' THEN n_records END), 0)::BIGINT AS n_records, count(reason) = 0 AS complete, coalesce(string_agg(reason, '; ' ORDER BY unit_no), '') AS incomplete_reason FROM j GROUP BY 1, 2""",
    "better_read": f"{REC}, {READS} SELECT {', '.join('r.' + c for c in COLUMNS)}, r.table_id, r.read FROM r JOIN w ON r.paper_uid = w.paper_uid AND r.table_id = w.table_id AND r.read = w.read",
}
