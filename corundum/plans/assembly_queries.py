"""Assembly and source jobs over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corundum.functions.lineage import scratch
from corundum.functions.scalars import moisture_basis_norm
from corundum.operators import assembly as A
from corundum.plans.fixtures import ctes, frame
from corundum.schema import COLUMNS

COLS = ", ".join(COLUMNS)
KEY = "CASE WHEN trim(coalesce(paper_uid,'')) <> '' THEN trim(paper_uid) WHEN trim(coalesce(doi,'')) <> '' THEN 'doi:' || lower(trim(doi)) ELSE 'name:' || lower(trim(coalesce(paper_id,''))) END"
LOWER = "lower(trim(coalesce({},'')))"


def basis(c: str) -> str:
    x = LOWER.format(c)
    return f"CASE WHEN {x} IN ('','none','nan','unknown','unspecified') THEN 'unknown' WHEN {x} IN ('wet','wet basis','wet-basis','wb','w.b.','w.b') THEN 'wet' WHEN {x} IN ('dry','dry basis','dry-basis','db','d.b.','d.b') THEN 'dry' ELSE {x} END"


def canonical(src: str) -> str:
    lab = "trim(regexp_replace(material_name, '\\s+', ' ', 'g'))"
    return f"""
SELECT coalesce(b.label, {lab}) AS material_name, {", ".join(c for c in COLUMNS[1:])} FROM {src} LEFT JOIN (
  SELECT k, label FROM (SELECT lower({lab}) AS k, {lab} AS label, ROW_NUMBER() OVER (PARTITION BY lower({lab}) ORDER BY COUNT(*) DESC, {lab}) AS nth
    FROM {src} WHERE {lab} <> '' GROUP BY 1, 2) WHERE nth = 1) b ON lower({lab}) = b.k"""


def resolve(src: str) -> str:
    name = lambda c: f"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({c}), '^.*[/\\\\]', ''), '\\.pdf$', ''), '^\\s*[0-9]+\\s*[.)-]\\s*', ''), '[_\\s]+', ' ', 'g'))"
    d = "lower(trim(coalesce(doi,'')))"
    fill = lambda c, t: f"coalesce(CASE WHEN trim(coalesce(CAST(r.{c} AS VARCHAR),'')) NOT IN ('','None') THEN r.{c} END, nullif(u.{c}, {t}), nullif(m.{c}, {t}), r.{c}) AS {c}" if t else f"coalesce(r.{c}, u.{c}, m.{c}) AS {c}"
    meta = {"title": "''", "authors": "''", "year": "", "journal": "''", "measurement_method": "''"}
    return f"""
SELECT {", ".join(fill(c, meta[c]) if c in meta else f"r.{c}" for c in COLUMNS)} FROM (
  SELECT s.* REPLACE (coalesce(nullif(trim(coalesce(s.paper_uid,'')),''), x.uid, y.uid, s.paper_uid) AS paper_uid) FROM {src} s
  LEFT JOIN (SELECT {d} AS k, min(paper_uid) AS uid FROM papers WHERE paper_uid <> '' AND {d} <> '' GROUP BY 1 HAVING count(DISTINCT paper_uid) = 1) x ON lower(coalesce(s.doi,'')) = x.k
  LEFT JOIN (SELECT {name("pdf_path")} AS k, min(paper_uid) AS uid FROM papers WHERE paper_uid <> '' GROUP BY 1 HAVING count(DISTINCT paper_uid) = 1) y ON {name("s.paper_id")} = y.k) r
LEFT JOIN (SELECT * REPLACE (array_to_string(authors, '; ') AS authors) FROM papers WHERE paper_uid <> '') u ON r.paper_uid = u.paper_uid
LEFT JOIN (SELECT {d} AS k, any_value(title) AS title, any_value(array_to_string(authors,'; ')) AS authors, any_value(year) AS year, any_value(journal) AS journal, any_value(measurement_method) AS measurement_method
  FROM papers WHERE {d} <> '' GROUP BY 1 HAVING count(*) = 1) m ON lower(coalesce(r.doi,'')) = m.k"""


JOINED = ["source_table", "source_location", "model_expression", "data_provenance", "extraction_source", "extraction_model"]


def merge(src: str, rnd: int = 0, cond: int = 4, sentinel: bool = True, key: str = KEY, extra: str = "") -> str:
    r = lambda c, m, n: f"round_even(coalesce({c}, {m}) * {10**n}, 0) / {10**n}"
    k = f"{key} AS k1, {LOWER.format('material_name')} AS k2, {r('frequency_mhz', -999, rnd)} AS k3, {r('temperature_c', -999, rnd)} AS k4, {r('moisture_content_pct', -1, rnd)} AS k5, {basis('moisture_basis')} AS k6, {LOWER.format('salt_content')} AS k7, {r('electrical_conductivity_s_m', -1, cond)} AS k8{extra}"
    keys = ", ".join(f"k{i}" for i in range(1, 9 + bool(extra)))
    one = "dielectric_constant IS NOT NULL AND loss_factor IS NULL"
    two = "loss_factor IS NOT NULL AND dielectric_constant IS NULL"
    joined = JOINED if not extra else [c for c in JOINED if c != "data_provenance"]
    cat = lambda c: f"CASE WHEN is_m THEN nullif(CASE WHEN trim(coalesce({c},'')) = '' THEN trim(coalesce(o.{c},'')) WHEN trim(coalesce(o.{c},'')) IN ('', trim({c})) THEN trim({c}) ELSE trim({c}) || '; ' || trim(o.{c}) END, '') ELSE {c} END AS {c}"

    def pick(c: str) -> str:
        if c == "loss_factor":
            return "CASE WHEN is_m THEN o.loss_factor ELSE loss_factor END AS loss_factor"
        if c in ("loss_tangent", "model_r_squared"):
            return f"CASE WHEN is_m THEN coalesce({c}, o.{c}) ELSE {c} END AS {c}"
        return cat(c) if c in joined else c

    return f"""
SELECT {", ".join(pick(c) for c in COLUMNS)} FROM (
  SELECT *, nc = 0 AND nd = 1 AND nl = 1 AND dielectric_constant IS NOT NULL AS is_m FROM (
    SELECT *, count(*) FILTER (dielectric_constant IS NOT NULL AND loss_factor IS NOT NULL) OVER w AS nc,
      count(*) FILTER ({one}) OVER w AS nd, count(*) FILTER ({two}) OVER w AS nl,
      max(CASE WHEN {two} THEN struct_pack({", ".join(f"{c} := {c}" for c in ["loss_factor", "loss_tangent", "model_r_squared", *JOINED])}) END) OVER w AS o
    FROM (SELECT *, {k} FROM {src}) WINDOW w AS (PARTITION BY {keys}))
  WHERE NOT (nc = 0 AND nd = 1 AND nl = 1 AND {two}))"""


def tangent(src: str) -> str:
    return f"SELECT * REPLACE (CASE WHEN loss_tangent IS NULL AND dielectric_constant > 0 AND loss_factor IS NOT NULL THEN round_even(loss_factor / dielectric_constant * 10000, 0) / 10000 ELSE loss_tangent END AS loss_tangent) FROM {src}"


BAD = {
    "frequency_mhz": "NOT frequency_mhz BETWEEN 1 AND 100000",
    "temperature_c": "NOT temperature_c BETWEEN -80 AND 200",
    "dielectric_constant": "CASE WHEN frequency_mhz <= 100 THEN NOT dielectric_constant BETWEEN 1 AND 300 ELSE NOT dielectric_constant BETWEEN 1 AND 200 END",
    "loss_factor": "CASE WHEN frequency_mhz <= 100 THEN NOT loss_factor BETWEEN 0.001 AND 5000 ELSE NOT loss_factor BETWEEN 0.001 AND 200 END",
    "moisture_content_pct": "NOT moisture_content_pct BETWEEN 0 AND 100",
    "loss_tangent": "NOT coalesce(frequency_mhz <= 100, FALSE) AND loss_tangent > 10",
}


def valid(src: str) -> str:
    return f"SELECT * FROM {src} WHERE NOT ({' OR '.join(f'coalesce({v}, FALSE)' for v in BAD.values())})"


def dedup(src: str) -> str:
    p, s = LOWER.format("data_provenance"), LOWER.format("extraction_source")
    r = lambda c, n: f"round_even({c} * {10**n}, 0) / {10**n}"
    pri = f"CASE {p} WHEN 'measured_table' THEN 0 WHEN 'vision_table' THEN 1 WHEN 'measured_text' THEN 2 WHEN 'equation_derived' THEN 3 ELSE CASE {s} WHEN 'table' THEN 0 WHEN 'text' THEN 2 WHEN 'equation' THEN 3 ELSE 4 END END"
    done = "dielectric_constant IS NOT NULL AND loss_factor IS NOT NULL"
    return f"""
SELECT {COLS} FROM (
  WITH q AS (SELECT *, {KEY} AS k1, {LOWER.format('material_name')} AS k2, {r('frequency_mhz', 0)} AS k3, {r('temperature_c', 0)} AS k4,
      {r("coalesce(moisture_content_pct, -1)", 1)} AS k5, {basis('moisture_basis')} AS k6, {LOWER.format('salt_content')} AS k7, {r("coalesce(electrical_conductivity_s_m, -1)", 4)} AS k8,
      {r('dielectric_constant', 1)} AS k9, {r('loss_factor', 1)} AS k10, {pri} AS pri FROM {src}),
  f AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k1,k2,k3,k4,k5,k6,k7,k8,k9,k10 ORDER BY pri, {", ".join(c + " NULLS LAST" for c in COLUMNS)}) AS nth FROM q) WHERE nth = 1),
  g AS (SELECT * FROM f WHERE ({done}) OR NOT EXISTS (SELECT 1 FROM f o WHERE o.dielectric_constant IS NOT NULL AND o.loss_factor IS NOT NULL
      AND o.k1=f.k1 AND o.k2=f.k2 AND o.k3=f.k3 AND o.k4=f.k4 AND o.k5=f.k5 AND o.k6=f.k6 AND o.k7=f.k7 AND o.k8=f.k8))
  SELECT * FROM g WHERE k5 <> -1 OR NOT EXISTS (SELECT 1 FROM g o WHERE o.dielectric_constant IS NOT NULL AND o.loss_factor IS NOT NULL AND o.k5 <> -1
      AND o.k1=g.k1 AND o.k2=g.k2 AND o.k3=g.k3 AND o.k4=g.k4 AND o.k6=g.k6 AND o.k7=g.k7 AND o.k8=g.k8))"""


def steps(src: str) -> str:
    """All steps of assemble as CTEs over flat records, ending in `a6`."""
    made = [(1, canonical, src), (2, resolve, "a1"), (3, merge, "a2"), (4, tangent, "a3"), (5, valid, "a4"), (6, dedup, "a5")]
    return "".join(f",\na{i} AS ({step(x)})" for i, step, x in made)


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The artifact table of the fixtures: rows grouped into records."""
    from corundum.schema import OUTPUT

    rows = frame(spark, sf_dir, "artifact_rows")
    record = F.struct(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in OUTPUT])
    return rows.groupBy("artifact").agg(
        F.first("artifact_uid").alias("paper_uid"), F.first("artifact_doi").alias("doi"), F.first("kind").alias("kind"), F.first("timed_out").alias("timed_out"), F.first("done").alias("complete"),
        F.array_compact(F.array(F.first("processed"))).alias("tables_processed"), F.collect_list(record).alias("records"),
    ).withColumnRenamed("artifact", "file_name")


NAME = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({}), '^.*[/\\\\]', ''), '\\.pdf$', ''), '^\\s*[0-9]+\\s*[.)-]\\s*', ''), '[_\\s]+', ' ', 'g'))"
FLAT = f"""
SELECT r.material_name, r.frequency_mhz, NULL::DOUBLE AS temperature_c, r.dielectric_constant, r.loss_factor, NULL::DOUBLE AS loss_tangent, r.moisture_content_pct,
  CASE WHEN r.moisture_content_pct IS NOT NULL AND {basis('r.moisture_basis')} = 'unknown' AND {basis('p.moisture_basis')} <> 'unknown' THEN p.moisture_basis ELSE r.moisture_basis END AS moisture_basis,
  NULL::VARCHAR AS salt_content, NULL::DOUBLE AS electrical_conductivity_s_m, coalesce({NAME.format('p.pdf_path')}, '') AS paper_id,
  coalesce(nullif(r.artifact_uid, ''), p.paper_uid, '') AS paper_uid, coalesce(nullif(p.doi, ''), r.artifact_doi) AS doi,
  CASE WHEN r.source_table <> '' THEN r.source_table WHEN r.data_provenance = 'measured_text' THEN 'Narrative text' WHEN r.data_provenance = 'equation_derived' THEN 'Regression equation'
       WHEN r.processed IS NOT NULL THEN 'Table 1' WHEN r.extraction_source = 'table' OR r.kind = 'table' THEN 'Table (unspecified)' ELSE '' END AS source_table,
  NULL::VARCHAR AS source_location, r.data_provenance, NULL::VARCHAR AS model_expression, NULL::DOUBLE AS model_r_squared, r.extraction_source, NULL::VARCHAR AS extraction_model,
  coalesce(p.title, '') AS title, coalesce(array_to_string(p.authors, '; '), '') AS authors, p.year, p.journal, p.measurement_method
FROM artifact_rows r LEFT JOIN (
  SELECT r2.artifact AS art, coalesce(min(u.pdf_path), min(d.pdf_path)) AS path FROM (SELECT DISTINCT artifact, artifact_uid, artifact_doi FROM artifact_rows) r2
  LEFT JOIN papers u ON u.paper_uid = nullif(r2.artifact_uid, '')
  LEFT JOIN (SELECT lower(doi) AS k, min(pdf_path) AS pdf_path FROM papers WHERE doi <> '' GROUP BY 1 HAVING count(*) = 1 AND min(paper_uid) <> '') d ON d.k = lower(r2.artifact_doi) GROUP BY 1) x ON x.art = r.artifact
LEFT JOIN papers p ON p.pdf_path = x.path"""
LEDGER = f"""
SELECT p.paper_uid, {NAME.format('p.pdf_path')} AS paper_id, lower(p.doi) AS doi, p.title, coalesce(a.n, 0) AS extraction_artifacts, coalesce(a.records, 0) AS extracted_records,
  coalesce(a.complete, 0) AS complete_extracted_records, coalesce(m.n, 0) AS assembled_records,
  CASE WHEN NOT p.parse_complete THEN 'no_parse_artifact' WHEN a.n IS NULL THEN 'no_extraction_artifact' WHEN a.timed_out THEN 'extraction_timed_out' WHEN NOT a.done THEN 'extraction_incomplete'
       WHEN m.n > 0 THEN 'contributed' WHEN a.records = 0 THEN 'extraction_zero_records' WHEN a.complete = 0 THEN 'incomplete_records_only' ELSE 'lost_during_assembly' END AS outcome
FROM papers p LEFT JOIN (
  SELECT p2.pdf_path, count(DISTINCT r.artifact) AS n, count(*) AS records, count(*) FILTER (r.dielectric_constant IS NOT NULL AND r.loss_factor IS NOT NULL) AS complete, bool_or(r.timed_out) AS timed_out, bool_and(r.done) AS done
  FROM papers p2 JOIN artifact_rows r ON (p2.paper_uid <> '' AND r.artifact_uid = p2.paper_uid) OR (lower(r.artifact_doi) = lower(p2.doi) AND NOT EXISTS (SELECT 1 FROM artifact_rows o WHERE o.artifact_uid = p2.paper_uid AND p2.paper_uid <> ''))
  GROUP BY 1) a ON a.pdf_path = p.pdf_path
LEFT JOIN (SELECT paper_uid, count(*) AS n FROM records WHERE paper_uid <> '' GROUP BY 1) m ON m.paper_uid = p.paper_uid"""
RULES = [{"where": {"paper_id": ["3. supplier_3.pdf", "4. supplier_4.pdf"], "salt_content": None}, "set": {"salt_content": "none", "year": 1999}}, {"where": {"source_table": "Table 3", "extraction_source": "equation"}, "drop": True}]


def _records(job):
    return lambda spark, sf_dir: job(frame(spark, sf_dir, "records"))


def _with_papers(job):
    return lambda spark, sf_dir: job(frame(spark, sf_dir, "records"), frame(spark, sf_dir, "papers"))


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.coverage_ledger(frame(spark, sf_dir, "records"), artifacts(spark, sf_dir), frame(spark, sf_dir, "papers"))


def _assembled_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: artifacts to the exported table and back, with the ledger and fingerprint of every paper."""
    from corundum.sources.tables import assembly_job

    made = assembly_job(artifacts(spark, sf_dir), frame(spark, sf_dir, "papers"), scratch(spark), csv_codec="gzip")
    prints = made["fingerprint"].select("paper_uid", F.col("n").alias("exported_records"))
    return made["ledger"].join(prints, "paper_uid", "left").select("paper_uid", "paper_id", "assembled_records", "outcome", F.coalesce("exported_records", F.lit(0)).alias("exported_records"))


LEDGER_OF_A6 = f"""ledger AS ({LEDGER.replace("FROM records WHERE", "FROM a6 WHERE")}), prints AS (SELECT paper_uid, count(*) AS n FROM a6 GROUP BY 1)
SELECT l.paper_uid, paper_id, assembled_records, outcome, coalesce(n, 0) AS exported_records FROM ledger l LEFT JOIN prints p ON p.paper_uid = l.paper_uid"""
R, RP = f"WITH {ctes('records')}\n", f"WITH {ctes('records', 'papers')}\n"
QUERIES = {
    "paper_identity": _records(lambda r: A.with_paper_key(r).groupBy("paper_key").agg(F.count("*").alias("n"))),
    "flatten_records": lambda spark, sf_dir: A.flatten_records(artifacts(spark, sf_dir), frame(spark, sf_dir, "papers")),
    "apply_overrides": _records(lambda r: A.apply_overrides(r, {"10.1000/S5": "10.9999/fixed"}, RULES)),
    "canonical_materials": _records(A.canonical_materials),
    "resolve_metadata": _with_papers(A.resolve_metadata),
    "moisture_basis_norm": _records(lambda r: r.select(moisture_basis_norm("moisture_basis").alias("basis")).groupBy("basis").agg(F.count("*").alias("n"))),
    "stable_order": _records(A.stable_order),
    "merge_split": _records(A.merge_split),
    "loss_tangent": _records(A.loss_tangent),
    "validate_bounds": _records(A.validate_bounds),
    "bound_violations": _records(A.bound_violations),
    "dedup_records": _records(A.dedup_records),
    "coverage_ledger": _ledger,
    "coverage_summary": lambda spark, sf_dir: A.coverage_summary(_ledger(spark, sf_dir)),
    "manifest_yield": lambda spark, sf_dir: A.manifest_yield(frame(spark, sf_dir, "papers"), frame(spark, sf_dir, "records")),
    "postprocess_hooks": _records(lambda r: A.postprocess_hooks(r, [lambda d: d.where("frequency_mhz > 100"), lambda d: d.withColumn("journal", F.upper("journal"))])),
    "assemble": _with_papers(A.assemble_records),
    "assemble_artifacts": lambda spark, sf_dir: A.assemble(artifacts(spark, sf_dir), frame(spark, sf_dir, "papers")),
    "assemble_ledger": _assembled_ledger,
}
ORACLES = {
    "paper_identity": f"{R} SELECT {KEY} AS paper_key, count(*) AS n FROM records GROUP BY 1",
    "flatten_records": f"WITH {ctes('artifact_rows', 'papers')} {FLAT}",
    "apply_overrides": f"{R} SELECT * REPLACE (CASE WHEN doi = '10.1000/S5' THEN '10.9999/fixed' ELSE doi END AS doi, CASE WHEN paper_id IN ('3. supplier_3.pdf','4. supplier_4.pdf') AND salt_content IS NULL THEN 'none' ELSE salt_content END AS salt_content, CASE WHEN paper_id IN ('3. supplier_3.pdf','4. supplier_4.pdf') AND salt_content IS NULL THEN 1999 ELSE year END AS year) FROM records WHERE NOT (source_table = 'Table 3' AND extraction_source = 'equation')",
    "canonical_materials": f"{R} {canonical('records')}",
    "resolve_metadata": f"{RP} {resolve('records')}",
    "moisture_basis_norm": f"{R} SELECT {basis('moisture_basis')} AS basis, count(*) AS n FROM records GROUP BY 1",
    "stable_order": f"{R} SELECT * FROM records",
    "merge_split": f"{R} {merge('records')}",
    "loss_tangent": f"{R} {tangent('records')}",
    "validate_bounds": f"{R} {valid('records')}",
    "bound_violations": f"{R} " + " UNION ALL ".join(f"SELECT {KEY} AS paper_key, material_name, '{c}' AS field, {c} AS value FROM records WHERE coalesce({v}, FALSE)" for c, v in BAD.items()),
    "dedup_records": f"{R} {dedup('records')}",
    "coverage_ledger": f"WITH {ctes('records', 'papers', 'artifact_rows')} {LEDGER}",
    "coverage_summary": f"WITH {ctes('records', 'papers', 'artifact_rows')}, l AS ({LEDGER}) SELECT count(*) AS selected_papers, count(*) FILTER (outcome = 'contributed') AS contributing_papers, count(*) FILTER (assembled_records = 0) AS zero_yield_papers, count(*) FILTER (outcome IN ('no_parse_artifact','extraction_timed_out','extraction_incomplete')) AS incomplete_papers, coalesce(sum(assembled_records), 0)::BIGINT AS assembled_records, {', '.join(f"count(*) FILTER (outcome = '{x}') AS n_{x}" for x in A.OUTCOMES)} FROM l",
    "manifest_yield": f"{RP} SELECT p.paper_uid, coalesce(n, 0) AS n FROM papers p LEFT JOIN (SELECT paper_uid, count(*) AS n FROM records WHERE paper_uid <> '' GROUP BY 1) m USING (paper_uid)",
    "postprocess_hooks": f"{R} SELECT * REPLACE (upper(journal) AS journal) FROM records WHERE frequency_mhz > 100",
    "assemble": f"WITH {ctes('records', 'papers')}{steps('records')}\nSELECT * FROM a6",
    "assemble_artifacts": f"WITH {ctes('artifact_rows', 'papers')},\nflat AS ({FLAT}){steps('flat')}\nSELECT * FROM a6",
    "assemble_ledger": f"WITH {ctes('artifact_rows', 'papers')},\nflat AS ({FLAT}){steps('flat')}, {LEDGER_OF_A6}",
}
