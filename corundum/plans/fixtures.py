"""The domain tables as deterministic projections of the driver tables, in SQL that Spark and DuckDB share.

``frame(spark, sf_dir, name)`` gives a table to a job; ``ctes(names)`` the same table to its SQL counterpart."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

RECORDS = """
SELECT CASE l_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) ELSE '  ' || p_name || ' ' END AS material_name,
  CASE WHEN l_partkey % 50 = 1 THEN NULL WHEN l_orderkey % 4 = 0 THEN 27e0 WHEN l_orderkey % 4 = 1 THEN 40e0
       WHEN l_orderkey % 4 = 2 THEN 915e0 ELSE 2450e0 END AS frequency_mhz,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE 20e0 + 10e0 * (CAST(l_quantity AS BIGINT) % 3) END AS temperature_c,
  CASE WHEN l_returnflag = 'R' THEN NULL
       ELSE floor(l_extendedprice / 1e2) / 1e1 + CASE WHEN l_partkey % 97 = 0 THEN 100e0 ELSE 0e0 END END AS dielectric_constant,
  CASE WHEN l_returnflag = 'A' THEN NULL
       ELSE floor(l_discount * 4e3 + 5e-1) / 1e1 + CASE WHEN l_partkey % 89 = 0 THEN 100e0 ELSE 0e0 END END AS loss_factor,
  CAST(NULL AS DOUBLE) AS loss_tangent,
  CASE WHEN l_tax < 3e-2 THEN NULL WHEN l_tax < 6e-2 THEN 20e0 ELSE 60e0 END AS moisture_content_pct,
  CASE WHEN l_linestatus = 'O' THEN 'wet' ELSE 'W.B.' END AS moisture_basis,
  CASE WHEN l_partkey % 16 = 0 THEN 'salt 1%' END AS salt_content,
  CASE WHEN l_partkey % 16 = 1 THEN 5e-1 END AS electrical_conductivity_s_m,
  l_suppkey || '. supplier_' || l_suppkey || '.pdf' AS paper_id,
  CASE WHEN l_suppkey % 10 = 9 THEN '' ELSE substr(SHA256(CAST(l_suppkey AS STRING)), 1, 12) END AS paper_uid,
  CASE WHEN l_suppkey % 20 = 19 THEN '' ELSE '10.1000/S' || l_suppkey END AS doi,
  CASE WHEN l_linenumber % 5 = 4 THEN '' ELSE 'Table ' || l_linenumber END AS source_table,
  CASE WHEN l_linenumber % 2 = 0 THEN 'page ' || l_linenumber END AS source_location,
  CASE l_linenumber % 5 WHEN 0 THEN 'equation_derived' WHEN 1 THEN 'measured_table' WHEN 2 THEN 'vision_table' WHEN 3 THEN 'measured_text' ELSE '' END AS data_provenance,
  CASE WHEN l_linenumber % 5 = 0 THEN 'a + b T' END AS model_expression,
  CASE WHEN l_linenumber % 5 = 0 THEN 9e-1 END AS model_r_squared,
  CASE l_linenumber % 3 WHEN 0 THEN 'equation' WHEN 1 THEN 'table' ELSE 'text' END AS extraction_source,
  'model-' || (l_linenumber % 2) AS extraction_model,
  CASE WHEN l_suppkey % 7 = 0 THEN '' ELSE 'Paper ' || l_suppkey END AS title,
  CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE 'A. Author' END AS authors,
  CAST(2000 + l_suppkey % 20 AS INT) AS year,
  CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE 'Journal ' || (l_suppkey % 5) END AS journal,
  CASE WHEN l_suppkey % 6 = 0 THEN '' ELSE 'probe' END AS measurement_method
FROM lineitem JOIN part ON l_partkey = p_partkey
"""
PAPERS = """
SELECT CASE WHEN s_suppkey % 25 = 24 THEN '' ELSE substr(SHA256(CAST(s_suppkey AS STRING)), 1, 12) END AS paper_uid,
  CASE WHEN s_suppkey % 30 = 29 THEN '' WHEN s_suppkey % 30 = 28 THEN '10.1000/shared' ELSE '10.1000/S' || s_suppkey END AS doi,
  'corpus/' || s_suppkey || '. supplier_' || s_suppkey || '.pdf' AS pdf_path,
  s_suppkey % 13 <> 12 AS parse_complete,
  'Title of ' || s_name AS title,
  CASE WHEN s_suppkey % 5 = 0 THEN ARRAY() ELSE ARRAY('A. Author', 'B. ' || s_name) END AS authors,
  CAST(1990 + s_nationkey AS INT) AS year,
  CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE 'Journal of ' || (s_nationkey % 4) END AS journal,
  CASE WHEN s_suppkey % 8 = 0 THEN NULL ELSE 'coaxial probe' END AS measurement_method,
  CASE s_suppkey % 3 WHEN 0 THEN 'wet' WHEN 1 THEN 'dry basis' ELSE NULL END AS moisture_basis,
  CASE WHEN s_suppkey % 4 = 0 THEN ARRAY() ELSE ARRAY(CASE WHEN s_suppkey % 2 = 0 THEN 915e0 ELSE 2450e0 END, 27e0) END AS measurement_frequencies_mhz,
  CASE WHEN s_suppkey % 6 = 0 THEN ARRAY() WHEN s_suppkey % 6 = 1 THEN ARRAY('part') ELSE ARRAY('part_' || s_suppkey, 'apple', 'ripe pear') END AS primary_materials
FROM supplier
"""
GOLD = """
SELECT l_orderkey * 1009 + ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) - 1 AS gold_id,
  l_suppkey || CASE WHEN l_orderkey % 3 = 0 THEN '. supplier_' ELSE '. reference_' END || l_suppkey AS paper_id,
  CASE WHEN l_orderkey % 3 = 0 THEN 'supplier ' ELSE 'reference ' END || l_suppkey AS paper_key,
  p_name || CASE WHEN l_partkey % 2 = 0 THEN ' samples' ELSE '' END AS material_name,
  CASE WHEN l_orderkey % 4 = 0 THEN 27e0 WHEN l_orderkey % 4 = 1 THEN 40e0 WHEN l_orderkey % 4 = 2 THEN 915e0 ELSE 2450e0 END AS frequency_mhz,
  20e0 + 10e0 * (CAST(l_quantity AS BIGINT) % 3) + (l_partkey % 3 - 1) AS temperature_c,
  CASE WHEN l_tax < 3e-2 THEN NULL WHEN l_tax < 6e-2 THEN 20e0 ELSE 60e0 END AS moisture_content_pct,
  CASE WHEN l_linestatus = 'O' THEN 'wet' ELSE 'dry' END AS moisture_basis,
  CASE WHEN l_partkey % 16 = 0 THEN 'salt 1.05%' END AS salt_content,
  CASE WHEN l_partkey % 16 = 1 THEN 505e-3 END AS electrical_conductivity_s_m,
  floor(l_extendedprice / 1e2) / 1e1 AS dielectric_constant, floor(l_discount * 4e3 + 5e-1) / 1e1 AS loss_factor
FROM lineitem JOIN part ON l_partkey = p_partkey
"""
PRED = """
SELECT l_orderkey * 1009 + ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) - 1 AS pred_id,
  l_suppkey || CASE WHEN l_orderkey % 3 <> 1 THEN '. supplier_' ELSE '. prediction_' END || l_suppkey AS paper_id,
  CASE WHEN l_orderkey % 3 <> 1 THEN 'supplier ' ELSE 'prediction ' END || l_suppkey AS paper_key,
  CASE WHEN l_partkey % 7 = 0 THEN upper(p_name) ELSE p_name END AS material_name,
  CASE WHEN l_partkey % 50 = 1 THEN NULL WHEN l_orderkey % 4 = 0 THEN 27.12e0 WHEN l_orderkey % 4 = 1 THEN 40e0 WHEN l_orderkey % 4 = 2 THEN 915e0 ELSE 2400e0 END AS frequency_mhz,
  20e0 + 10e0 * (CAST(l_quantity AS BIGINT) % 3) AS temperature_c,
  CASE WHEN l_tax < 3e-2 THEN NULL WHEN l_tax < 6e-2 THEN 21e0 ELSE 60e0 END AS moisture_content_pct,
  CASE WHEN l_linestatus = 'O' THEN 'wet' ELSE 'dry' END AS moisture_basis,
  CASE WHEN l_partkey % 16 = 0 THEN 'salt 1%' WHEN l_partkey % 16 = 2 THEN '0.5 S/m' END AS salt_content,
  CASE WHEN l_partkey % 16 = 1 THEN 5e-1 END AS electrical_conductivity_s_m,
  CASE WHEN l_returnflag = 'R' THEN NULL ELSE floor(l_extendedprice / 1e2) / 1e1 * (1e0 + (l_partkey % 4) * 3e-2) END AS dielectric_constant,
  floor(l_discount * 4e3 + 5e-1) / 1e1 AS loss_factor
FROM lineitem JOIN part ON l_partkey = p_partkey
"""
ARTIFACT_ROWS = """
SELECT 'a' || l_suppkey || '_' || (l_linenumber % 2) AS artifact,
  CASE WHEN l_suppkey % 14 = 13 THEN 'of no paper' WHEN l_suppkey % 12 = 11 THEN '' ELSE substr(SHA256(CAST(l_suppkey AS STRING)), 1, 12) END AS artifact_uid,
  CASE WHEN l_suppkey % 14 = 13 THEN '10.1000/X' ELSE '10.1000/S' END || l_suppkey AS artifact_doi,
  CASE l_linenumber % 2 WHEN 0 THEN 'text' ELSE 'table' END AS kind,
  l_suppkey % 17 = 16 AS timed_out, l_suppkey % 19 <> 18 AS done,
  CASE WHEN l_suppkey % 2 = 0 THEN 'table_1' END AS processed,
  'part ' || l_partkey AS material_name, CASE WHEN l_orderkey % 2 = 0 THEN 915e0 ELSE 2450e0 END AS frequency_mhz,
  CASE WHEN l_returnflag = 'R' OR l_suppkey % 23 = 22 THEN NULL ELSE floor(l_extendedprice / 1e2) / 1e1 END AS dielectric_constant,
  CASE WHEN l_returnflag = 'A' THEN NULL ELSE floor(l_discount * 4e3 + 5e-1) / 1e1 END AS loss_factor,
  CASE WHEN l_tax < 3e-2 THEN NULL ELSE 60e0 END AS moisture_content_pct,
  CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN 'dry' ELSE 'unknown' END AS moisture_basis,
  CASE WHEN l_partkey % 2 = 0 THEN 'T' || l_linenumber ELSE '' END AS source_table,
  CASE l_partkey % 4 WHEN 0 THEN 'measured_table' WHEN 1 THEN 'measured_text' WHEN 2 THEN 'equation_derived' ELSE '' END AS data_provenance,
  CASE l_partkey % 3 WHEN 0 THEN 'table' ELSE '' END AS extraction_source
FROM lineitem
"""
MANIFEST = """
SELECT substr(SHA256(CASE WHEN c_custkey % 4 = 3 THEN 'm' ELSE 'c' END || c_custkey), 1, 12) AS paper_uid, 'corpus/' || c_name || '.pdf' AS pdf_path, lower(c_name) AS slug,
  CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '10.2000/C' || c_custkey END AS doi, c_mktsegment AS title,
  CAST(1990 + c_nationkey AS INT) AS year
FROM customer
"""
UPDATES = """
SELECT substr(SHA256(CASE WHEN c_custkey % 4 >= 2 THEN 'c' ELSE 'u' END || c_custkey), 1, 12) AS paper_uid, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'new/' || c_name || '.pdf' END AS pdf_path,
  CAST(NULL AS STRING) AS slug, CASE WHEN c_custkey % 2 = 0 THEN '10.3000/N' || c_custkey END AS doi,
  CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE 'Title ' || c_custkey END AS title, CASE WHEN c_custkey % 2 = 1 THEN 2024 END AS year
FROM customer
"""
PARSED = """
SELECT substr(SHA256(CASE WHEN o_custkey % 3 <> 0 THEN 'c' ELSE 'p' END || o_custkey), 1, 12) AS paper_uid, MIN('10.4000/P' || o_custkey) AS doi, MAX(o_orderpriority) AS title,
  CAST(COUNT(*) AS BIGINT) AS tables_found
FROM orders GROUP BY o_custkey
"""
EVENTS = """
SELECT event_id, 'p' || (user_id % 500) AS paper, ts,
  CASE event_type WHEN 'click' THEN 'parsed' WHEN 'view' THEN 'screened' WHEN 'purchase' THEN 'extracted' ELSE 'error' END AS status,
  CASE WHEN event_id % 3 = 0 THEN '' ELSE 'corpus/' || user_id || '.pdf' END AS pdf_path,
  CASE WHEN event_type = 'view' THEN ts END AS screen_time, CASE WHEN event_id % 5 = 0 THEN 'error ' || event_id END AS error_message,
  CAST(floor(value) AS BIGINT) AS cost_cents
FROM events
"""
USAGE = """
SELECT CAST(conv_id AS STRING) AS paper, CASE role WHEN 'user' THEN 'screen' WHEN 'assistant' THEN 'extract' ELSE 'parse' END AS stage,
  CASE turn % 3 WHEN 0 THEN 'small' WHEN 1 THEN 'large' ELSE 'unlisted' END AS model,
  CAST(length(coalesce(text, '')) AS BIGINT) AS input_tokens, CAST(turn * 10 AS BIGINT) AS output_tokens
FROM conversations
"""
REQUESTS = """
SELECT 'c' || conv_id || '_' || turn AS custom_id, 'p' || conv_id AS paper_uid, CAST(turn AS BIGINT) AS unit_no,
  CASE WHEN turn % 4 = 0 THEN 'text' ELSE 'table' END AS kind
FROM conversations WHERE role = 'user'
"""
RESPONSES = """
SELECT CASE WHEN conv_id % 11 = 10 THEN 'x' ELSE 'c' END || conv_id || '_' || (turn - 1) AS custom_id, CASE WHEN conv_id % 9 = 8 THEN '' ELSE coalesce(text, '') END AS text,
  conv_id % 7 <> 6 AS response_complete, CAST(conv_id % 5 AS BIGINT) AS n_records
FROM conversations WHERE role = 'assistant'
"""
SECTIONS = """
SELECT doc_id, 'p' || doc_id AS paper_uid, CAST(line_no AS BIGINT) AS idx,
  CASE (doc_id + line_no) % 6 WHEN 0 THEN 'Results and discussion' WHEN 1 THEN 'Introduction' WHEN 2 THEN 'References' WHEN 3 THEN 'Dielectric properties' WHEN 4 THEN 'Results of prior review' ELSE 'Methods' END AS heading,
  line AS text
FROM LINES
"""
TEXTS = """
SELECT doc_id, 'p' || doc_id AS paper_uid, source || '/' || doc_id || '.pdf' AS pdf_path,
  CASE doc_id % 4 WHEN 0 THEN 'doi:10.1234/abc.' || doc_id || '... ' WHEN 1 THEN 'see 10.55555/X-' || doc_id || ' and 10.1/no ' ELSE '' END ||
  CASE doc_id % 3 WHEN 0 THEN 'measured at 27.12 MHz, 2.45 GHz and 5 MHz. ' WHEN 1 THEN 'at 915 MHz. ' ELSE '' END ||
  CASE doc_id % 5 WHEN 0 THEN 'moisture content 10.5 - 30 % wet basis. ' WHEN 1 THEN 'moisture (dry basis) ' ELSE '' END || coalesce(text, '') AS full_text
FROM documents
"""
TABLES = {name: globals()[name.upper()] for name in ("records", "papers", "gold", "pred", "artifact_rows", "manifest", "updates", "parsed", "usage", "requests", "responses", "sections", "texts")} | {"checkpoint_events": EVENTS}
DRIVER = "region nation customer supplier part orders lineitem events documents pages labels conversations".split()


def spark_sql(sql: str) -> str:
    sql = re.sub(r"SHA256\(((?:[^()]|\([^()]*\))*)\)", r"sha2(\1, 256)", sql)
    return sql.replace("FROM LINES", "FROM (SELECT doc_id, line_no, line FROM documents LATERAL VIEW posexplode(split(coalesce(text, ''), '\\n')) AS line_no, line)")


def duck_sql(sql: str) -> str:
    sql = sql.replace("SHA256(", "sha256(").replace("ARRAY()", "[]").replace("FROM LINES", "FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line_no FROM documents)")
    return re.sub(r"ARRAY\(((?:[^()]|\([^()]*\))*)\)", r"[\1]", sql)


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain table, or a driver table as it is."""
    if name in DRIVER:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = spark_sql(TABLES[name])
    used = {t: frame(spark, sf_dir, t) for t in DRIVER if re.search(rf"\b(?:FROM|JOIN) {t}\b", sql)}
    for t in used:
        sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", sql)
    return spark.sql(sql, **used)


def ctes(*names: str) -> str:
    """`name AS (...)` for a WITH clause of DuckDB."""
    return ",\n".join(f"{n} AS ({duck_sql(TABLES[n])})" for n in names)
