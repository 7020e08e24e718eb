"""Text, tables, responses and equations over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corundum.operators import equations as E
from corundum.operators import responses as R
from corundum.operators import tables as B
from corundum.operators import text as T
from corundum.plans.fixtures import ctes, frame

HEADS = [
    ("Dielectric properties at two frequencies", [["Temperature (°C)", "", "Dielectric constant", "Loss factor"], ["", "", "915 MHz", "915 MHz"]]),
    ("Penetration depth in mm", [["Penetration depth (mm)", "a", "b", "c"]]),
    ("Coefficients", [["Moisture (%)", "a", "b", "R2"]]),
    ("Density of samples", [["x", "", "", "note"]]),
    ("Results", [["Sample", "27 MHz", "915 MHz", "2.45 GHz"]]),
    ("Moisture content and eps regression", [["M (%, w.b.)", "v", "v", ""]]),
]


def parsed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table per supplier and line number, its rows from the line items."""
    lines = frame(spark, sf_dir, "lineitem")
    cells = F.array(
        F.when(F.col("l_quantity").cast("bigint") % 3 == 0, "").otherwise(F.concat((F.lit(10) + F.col("l_quantity").cast("bigint") % 4 * 10).cast("string"), F.lit(" C"))),
        F.concat(F.lit("p"), (F.col("l_partkey") % 3).cast("string")), F.concat(F.floor(F.col("l_extendedprice") / 1e3).cast("string"), F.lit(".5")), F.concat(F.floor(F.col("l_discount") * 1e2 + 0.5).cast("string"), F.lit(".2 ± 0.1")),
    )
    order = F.struct("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", cells.alias("cells"))
    t = lines.groupBy("l_suppkey", "l_linenumber").agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["cells"]).alias("rows"))
    heads = F.array(*[F.struct(F.lit(c).alias("caption"), F.array(*[F.array(*[F.lit(x) for x in r]) for r in h]).alias("headers")) for c, h in HEADS])
    t = t.withColumn("h", F.element_at(heads, (F.col("l_linenumber") % len(HEADS)).cast("int") + 1))
    return t.select(F.concat(F.lit("p"), F.col("l_suppkey").cast("string")).alias("paper_uid"), F.concat(F.lit("table_"), F.col("l_suppkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string")).alias("table_id"), "h.caption", "h.headers", "rows")


_HEADS = "CASE l_linenumber % 6 " + " ".join("WHEN {} THEN {{'caption': '{}', 'headers': [{}]}}".format(k, c, ", ".join("[" + ", ".join("'" + x + "'" for x in r) + "]" for r in h)) for k, (c, h) in enumerate(HEADS)) + " END"
TABLES = f"""tabs AS (SELECT 'p' || l_suppkey AS paper_uid, 'table_' || l_suppkey || '_' || l_linenumber AS table_id, h.caption AS caption, h.headers AS headers, rows FROM (
  SELECT l_suppkey, l_linenumber, {_HEADS} AS h, list([CASE WHEN l_quantity::BIGINT % 3 = 0 THEN '' ELSE (10 + l_quantity::BIGINT % 4 * 10) || ' C' END, 'p' || (l_partkey % 3), floor(l_extendedprice / 1e3)::BIGINT || '.5', floor(l_discount * 1e2 + 0.5::DOUBLE)::BIGINT || '.2 ± 0.1']
    ORDER BY l_orderkey, l_partkey, l_quantity, l_extendedprice, l_discount) AS rows FROM lineitem GROUP BY l_suppkey, l_linenumber))"""


def paper_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers with all conditions the text and equation jobs read."""
    s = frame(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    span = lambda lo, hi: F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
    none = "struct<lo:double,hi:double>"
    return s.select(
        F.concat(F.lit("p"), k.cast("string")).alias("paper_uid"), F.concat(F.lit("10.1000/S"), k.cast("string")).alias("doi"), F.col("s_name").alias("title"), F.array(F.lit("apple")).alias("primary_materials"),
        F.concat(F.when(k % 3 == 0, "moisture content of 10 to 30 % (wet basis) at 915 MHz ").when(k % 3 == 1, "moisture d.b. and 2.45 GHz ").otherwise("none "), F.col("s_name")).alias("full_text"),
        F.when(k % 2 == 0, "wet").alias("moisture_basis"), F.when(k % 4 == 0, F.array(F.lit(12.0), F.lit(24.0))).otherwise(F.array().cast("array<double>")).alias("moisture_levels_pct"),
        F.when(k % 5 == 0, span(15.0, 75.0)).otherwise(F.lit(None).cast(none)).alias("moisture_range_pct"), F.when(k % 3 == 1, span(25.0, 65.0)).otherwise(F.lit(None).cast(none)).alias("temperature_range_c"),
        F.when(k % 2 == 1, F.array(F.lit(27.12), F.lit(915.0))).otherwise(F.array().cast("array<double>")).alias("measurement_frequencies_mhz"),
        F.when(k % 6 == 0, F.array(F.concat(F.lit("Table "), k.cast("string"), F.lit("_4")))).otherwise(F.array().cast("array<string>")).alias("data_tables"), F.array(F.concat(F.lit("table_"), k.cast("string"), F.lit("_5"))).alias("skip_tables"),
    )


def equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression models in four notations from the part table."""
    p, k = frame(spark, sf_dir, "part"), F.col("p_partkey")
    text = lambda c: c.cast("string")
    n = (k % 4).cast("int")
    terms = F.array(F.struct(F.concat(text(F.col("p_size")), F.lit(".5 *1")).alias("coef"), F.create_map().cast("map<string,int>").alias("vars")), F.struct(F.lit("− 1.2 × 10 - 1").alias("coef"), F.create_map(F.lit("temperature"), F.lit(1)).alias("vars")))
    subs = F.create_map(F.lit("alpha 0"), F.concat(text(F.col("p_size")), F.lit(" ")), F.lit("a1"), F.lit("0.2"), F.lit("a12"), F.lit("3e - 3"), F.lit("a9"), F.lit("1"))
    return p.select(
        F.concat(F.lit("p"), text(k % 100)).alias("paper_uid"), k.alias("eq_no"), F.concat(F.lit("material "), text(F.floor(k / 8))).alias("material_name"), F.when(k % 11 == 10, "colour").when(k % 2 == 0, "dielectric_constant").otherwise("loss_factor").alias("property"),
        F.when(n == 1, F.create_map(F.lit("1"), F.when(k % 13 == 12, "fat").otherwise("moisture_pct"), F.lit("2"), F.lit("Temperature"))).alias("variables"), F.when(n == 1, subs).alias("subscripts"), F.when(n == 0, terms).otherwise(F.array().cast(f"array<{'struct<coef:string,vars:map<string,int>>'}>")).alias("terms"),
        F.when(n == 2, F.concat(F.lit("eps = "), text(F.col("p_size")), F.lit(" + 0.05*T^2/10 - sqrt(M)"))).alias("expression"), F.when(n == 3, F.array(text(F.col("p_size")), F.lit("0.03"), F.when(k % 7 == 6, "n.d.").otherwise("−1e-4"))).alias("coefficients"), F.when(k % 5 == 0, "temp_c").alias("variable"),
        F.when(k % 3 == 0, F.create_map(F.lit("t"), F.array(F.lit(20.0), F.lit(60.0)))).alias("domain"), F.when(k % 3 != 1, F.when(k % 2 == 0, 27.12).otherwise(915.0)).alias("frequency_mhz"), F.when(k % 6 == 0, 0.95).alias("r_squared"), F.concat(F.lit("Table "), text(k % 3)).alias("source_table"),
    )


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = T.text_windows(frame(spark, sf_dir, "texts").select("paper_uid", F.col("full_text").alias("text")), 2000, 200)
    return w.select("paper_uid", F.lit("text").alias("kind"), F.col("window_no").alias("unit_no"), "text")


def _screened(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = frame(spark, sf_dir, "texts").select("paper_uid", "full_text", F.lit("old").alias("title"), F.lit(None).cast("string").alias("doi"), F.array().cast("array<string>").alias("authors"), F.lit(1990).alias("year"), F.lit("J").alias("journal"), F.array(F.lit("x")).alias("primary_materials"), F.array(F.lit(915.0)).alias("measurement_frequencies_mhz"), F.lit("wet").alias("moisture_basis"), "doc_id")
    meta = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('{"title": "T'), F.col("doc_id").cast("string"), F.lit('", "year": 2001, "primary_materials": [], "authors": ["A"], "moisture_basis": "dry"}'))).when(F.col("doc_id") % 3 == 1, '{"title": "", "doi": "10.7777/x", "measurement_frequencies_mhz": [27, 40], "moisture_basis": "other"}')
    cached = papers.select("paper_uid", meta.alias("metadata")).where("metadata is not null")
    return T.apply_screening(papers, cached).select("paper_uid", "title", "doi", "year", F.array_join("authors", ",").alias("authors"), F.array_join("primary_materials", ",").alias("materials"), F.size("measurement_frequencies_mhz").cast("long").alias("n_freqs"), "moisture_basis")


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, s = frame(spark, sf_dir, "nation"), frame(spark, sf_dir, "supplier")
    k = F.col("n_nationkey")
    return s.join(n, F.col("n_nationkey") >= F.col("s_nationkey")).select(
        F.concat(F.lit("t"), F.col("s_suppkey").cast("string")).alias("table_id"), k.cast("int").alias("cell_idx"), F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("text"), (k / 5).cast("int").alias("r0"), ((k / 5).cast("int") + 1 + (k % 7 == 3).cast("int")).alias("r1"), (k % 5).cast("int").alias("c0"), (k % 5 + 1 + (k % 4 == 1).cast("int")).cast("int").alias("c1"),
        ((k < 5) | (k == 17)).alias("column_header"),
    )


def _damage(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = parsed_tables(spark, sf_dir)
    r = frame(spark, sf_dir, "lineitem").select(F.concat(F.lit("table_"), F.col("l_suppkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string")).alias("table_id"), F.when(F.col("l_tax") >= 0.05, 20.0).alias("temperature_c"), F.when(F.col("l_tax") >= 0.03, 20.0).alias("moisture_content_pct"), F.lit(915.0).alias("frequency_mhz"))
    return B.header_damage(t, r)


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = frame(spark, sf_dir, "conversations").where("role = 'assistant'")
    k = F.col("conv_id")
    rec = F.concat(F.lit('{"material_name": "m'), k.cast("string"), F.lit('", "frequency_mhz": 27.12, "dielectric_constant": 3.5, "loss_tangent": "n.d.", "moisture_basis": "WET", "salt_content": "a ] } b"}'))
    body = F.concat(F.lit('{"records": ['), rec, F.lit(", "), rec)
    text = F.when(k % 5 == 0, F.concat(F.lit("Here:\n```json\n"), body, F.lit("]}\n```\nDone"))).when(k % 5 == 1, F.concat(F.lit("["), rec, F.lit("]"))).when(k % 5 == 2, body).when(k % 5 == 3, F.concat(body, F.lit(', {"material_name": "cut'))).otherwise(F.coalesce("text", F.lit("")))
    return c.select(F.concat(F.lit("c"), k.cast("string"), F.lit("_"), (F.col("turn") - 1).cast("string")).alias("custom_id"), text.alias("text"))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.parse_responses(_responses(spark, sf_dir))


def _response_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = frame(spark, sf_dir, "requests").withColumn("model", F.lit("large"))
    papers = q.select("paper_uid", F.concat(F.lit("10.5000/"), "paper_uid").alias("doi")).distinct()
    return R.records_from_responses(_parsed(spark, sf_dir), q, papers)


def _models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.build_models(equations(spark, sf_dir))


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.expand_grid(_models(spark, sf_dir), paper_frames(spark, sf_dir)).select("eq_no", "T", "M", "RHO", "F", "S")


def _coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = frame(spark, sf_dir, "part")
    n, size = F.col("p_partkey") % 7, F.col("p_size").cast("string")
    raw = F.when(n == 0, F.concat(F.lit("- "), size, F.lit(".25"))).when(n == 1, F.concat(size, F.lit(" × 10 - 3"))).when(n == 2, F.concat(F.lit("−"), size, F.lit("e − 2"))).when(n == 3, F.concat(size, F.lit(".5 *1"))).when(n == 4, F.concat(size, F.lit(" a"))).when(n == 5, "n.d.").otherwise(F.concat(F.lit("1 "), size))
    return p.select("p_partkey", F.round(E.parse_coefficients(raw), 6).alias("value"))


def _methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of every supplier, of which every second one is a paper: an introduction and two that say how it was done."""
    k = F.col("s_suppkey")
    rows = F.array(*[F.struct(F.lit(i).alias("idx"), F.lit(h).alias("heading"), F.concat(F.lit(t), "s_name").alias("text")) for i, h, t in ((2, "Experimental", "Second "), (0, "Introduction", "Once "), (1, "Materials and Methods", "Probe of "))])
    return frame(spark, sf_dir, "supplier").select(F.concat(F.when(k % 2 == 0, "p").otherwise("q"), k.cast("string")).alias("paper_uid"), F.inline(rows))


def _table_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table_requests(parsed_tables(spark, sf_dir), paper_frames(spark, sf_dir), _methods(spark, sf_dir), {"default": "small", "table": "large"})


def _screening_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.screening_requests(paper_frames(spark, sf_dir), parsed_tables(spark, sf_dir), {"default": "small"})


TX = ctes("texts")
HAVE = "'results|result|results and discussion|discussion|findings'"
SKIPS = "'introduction|literature|background|references|acknowledgment|acknowledgement'"
DOI = r"10\.[0-9]{4,}/[^\s,;\"'')]+"
FREQ = r"list_transform(range(1, len(regexp_extract_all(TEXT, '(?i)([0-9]+(?:\.[0-9]+)?)\s*(MHz|GHz)', 1)) + 1), lambda i: regexp_extract_all(TEXT, '(?i)([0-9]+(?:\.[0-9]+)?)\s*(MHz|GHz)', 1)[i]::DOUBLE * CASE WHEN lower(regexp_extract_all(TEXT, '(?i)([0-9]+(?:\.[0-9]+)?)\s*(MHz|GHz)', 2)[i]) = 'ghz' THEN 1000 ELSE 1 END)"


def find(c: str) -> str:
    return f"nullif(rtrim(regexp_extract({c}, '{DOI}'), '.'), '')"



WINDOWS = "w AS (SELECT paper_uid, i AS window_no, substr(full_text, (i * 1800 + 1)::BIGINT, 2000) AS text FROM (SELECT paper_uid, full_text, unnest(CASE WHEN length(full_text) <= 2000 THEN [0] ELSE range(0, ((length(full_text) - 1) // 1800 + 1)::BIGINT) END) AS i FROM texts))"
QUERIES = {
    "extract_doi": lambda spark, sf_dir: T.extract_doi(frame(spark, sf_dir, "texts"), spark.range(1).select(F.lit("local/8").alias("key"), F.lit("10.8888/eight").alias("doi"))).select("paper_uid", "doi"),
    "results_text": lambda spark, sf_dir: T.results_text(frame(spark, sf_dir, "sections"), frame(spark, sf_dir, "texts")),
    "text_windows": lambda spark, sf_dir: T.text_windows(frame(spark, sf_dir, "texts").select("paper_uid", F.col("full_text").alias("text")), 2000, 200),
    "detect_frequencies": lambda spark, sf_dir: T.detect_frequencies(frame(spark, sf_dir, "texts"), parsed_tables(spark, sf_dir)).select("paper_uid", F.array_join(F.transform("freqs", lambda x: F.round(x, 2).cast("decimal(12,2)").cast("string")), ",").alias("freqs")),
    "enrich_moisture": lambda spark, sf_dir: T.enrich_moisture(paper_frames(spark, sf_dir).withColumn("moisture_range_pct", F.lit(None).cast("struct<lo:double,hi:double>")).withColumn("moisture_basis", F.lit(None).cast("string")), parsed_tables(spark, sf_dir)).select("paper_uid", "moisture_basis", F.size("moisture_levels_pct").alias("n_levels"), "moisture_range_pct.lo", "moisture_range_pct.hi"),
    "apply_screening": _screened,
    "grid_from_cells": lambda spark, sf_dir: B.grid_from_cells(_cells(spark, sf_dir)).select("table_id", F.array_join(F.flatten("headers"), "|").alias("headers"), F.array_join(F.flatten("rows"), "|").alias("rows")),
    "column_labels": lambda spark, sf_dir: B.column_labels(parsed_tables(spark, sf_dir)).select("table_id", F.array_join("labels", "; ").alias("labels")),
    "classify_tables": lambda spark, sf_dir: B.classify_tables(parsed_tables(spark, sf_dir), paper_frames(spark, sf_dir)),
    "classify_equation_tables": lambda spark, sf_dir: B.classify_equation_tables(parsed_tables(spark, sf_dir)),
    "chunk_tables": lambda spark, sf_dir: B.chunk_tables(parsed_tables(spark, sf_dir)).select("table_id", "chunk_no", F.size("rows").alias("n_rows"), F.array_join(F.get("rows", F.lit(0)), "|").alias("first_row")),
    "header_damage": _damage,
    "build_requests": lambda spark, sf_dir: T.build_requests(_units(spark, sf_dir), paper_frames(spark, sf_dir), {"default": "small", "text": "large"}),
    "table_requests": _table_requests,
    "screening_requests": _screening_requests,
    "parse_responses_strict": lambda spark, sf_dir: R.text_completeness(R.parse_responses(_responses(spark, sf_dir), strict=True), frame(spark, sf_dir, "requests")),
    "parse_responses": lambda spark, sf_dir: _parsed(spark, sf_dir).select("custom_id", F.coalesce(F.size("payload.records"), F.lit(0)).cast("long").alias("n"), "response_complete"),
    "records_from_responses": _response_records,
    "parse_coefficients": _coefficients,
    "build_models": lambda spark, sf_dir: E.model_terms(_models(spark, sf_dir)).select("eq_no", "coef", F.coalesce(F.try_element_at("powers", F.lit("T")), F.lit(0)).alias("t"), F.coalesce(F.try_element_at("powers", F.lit("M")), F.lit(0)).alias("m")),
    "expand_grid": _grid,
    "evaluate_models": lambda spark, sf_dir: E.evaluate_models(_models(spark, sf_dir), paper_frames(spark, sf_dir)).withColumn("model_property", F.split("model_expression", ":")[0]).drop("model_expression"),
    "equation_report": lambda spark, sf_dir: E.equation_report(equations(spark, sf_dir), _models(spark, sf_dir), paper_frames(spark, sf_dir)),
}
def has(text: str, words) -> str:
    """Whether a text contains one of the words."""
    return "(" + " OR ".join("contains({}, '{}')".format(text, w.replace("'", "''")) for w in words) + ")"


FLAT = "array_to_string(flatten({}), ' ')"
#: The tables with their lower-cased texts, as the classification reads them.
SEEN = rf"""seen AS (SELECT *, lower(caption) || ' ' || lower({FLAT.format('headers')}) AS head, lower({FLAT.format('rows[1:5]')}) AS five, lower({FLAT.format('rows[1:12]')}) AS sample FROM tabs),
told AS (SELECT *, head || ' ' || five AS words,
  {has('head', B.EQUATION)} OR (len(list_intersect(list_transform(flatten(headers), lambda x: lower(x)), ['a','b','c','d','e','f'])) >= 2 AND {has(f"lower({FLAT.format('headers')})", B.FIT)}
    AND regexp_matches(lower({FLAT.format('headers')}) || ' ' || sample, 'eps|ε|e\s*[r0''′″]')) AS is_equation,
  list_transform(rows[1:10], lambda r: list_filter(list_transform(r[2:], lambda c: TRY_CAST(regexp_extract(c, '[0-9]+\.?[0-9]*') AS DOUBLE)), lambda x: x IS NOT NULL)) AS vals FROM seen),
ruled AS (SELECT *, list_filter(vals, lambda v: len(v) >= 3) AS checked, {has('words', B.DIELECTRIC)} AS dielectric FROM told),
sloped AS (SELECT *, len(list_filter(checked, lambda v: list_bool_and(list_transform(range(1, len(v)), lambda i: v[i] >= v[i + 1] * 0.9::DOUBLE)) AND list_max(v) < 200 AND v[1] > v[-1] * 2)) AS falls FROM ruled)"""
CLASSIFIED = rf"""SELECT table_id, CASE WHEN {has('words', B.PENETRATION)} AND NOT dielectric THEN 'penetration depth' WHEN regexp_matches(words, '\(mm\)|\(cm\)|in mm|in cm') AND NOT dielectric THEN 'length units'
  WHEN NOT dielectric AND len(rows) >= 3 AND len(list_filter(headers[1], lambda h: regexp_matches(h, '(?i)[0-9]+\s*(MHz|GHz)'))) >= 3 AND len(checked) >= 3 AND falls / len(checked) > 0.7::DOUBLE THEN 'values fall with frequency'
  WHEN is_equation THEN 'equation table' WHEN lower(data) = table_id THEN 'screened as data' WHEN skip = table_id AND dielectric THEN 'screened out, but dielectric' WHEN skip = table_id THEN 'screened out'
  WHEN {has('words', B.SKIP)} AND NOT {has('words', B.NARROW)} THEN 'skip word' WHEN {has('words', B.EXPLICIT)} THEN 'dielectric word'
  WHEN len(rows) >= 3 AND len(list_filter(flatten(list_transform(rows[1:5], lambda r: r[2:])), lambda c: len(regexp_extract_all(c, '[0-9]+\.?[0-9]*')) >= 4 OR (len(regexp_extract_all(c, '[0-9]+\.?[0-9]*')) >= 2 AND contains(c, '±')))) > 0 THEN 'paired numbers'
  ELSE 'no sign of data' END AS reason
FROM sloped LEFT JOIN (SELECT 'p' || s_suppkey AS paper_uid, CASE WHEN s_suppkey % 6 = 0 THEN 'Table_' || s_suppkey || '_4' END AS data, 'table_' || s_suppkey || '_5' AS skip FROM supplier) USING (paper_uid)"""
#: Runs of a table's first column, packed greedily into chunks of up to 12 rows; larger runs are split.
RUNS = """cells AS (SELECT table_id, rows, unnest(rows) AS r, generate_subscripts(rows, 1) AS i FROM tabs),
firsts AS (SELECT table_id, i, trim(r[1]) AS v, last_value(nullif(trim(r[1]), '') IGNORE NULLS) OVER (PARTITION BY table_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM cells),
runs AS (SELECT table_id, i, sum(CASE WHEN v <> '' AND p IS NOT NULL AND v <> p THEN 1 ELSE 0 END) OVER (PARTITION BY table_id ORDER BY i) AS nth FROM firsts),
groups AS (SELECT table_id, list(n ORDER BY nth) AS g FROM (SELECT table_id, nth, count(*) AS n FROM runs GROUP BY 1, 2) GROUP BY 1),
packed AS (SELECT table_id, list_reduce(list_transform(g, lambda n: {'done': []::BIGINT[], 'n': n}), lambda a, x: CASE WHEN a.n + x.n > 12 AND a.n > 0 THEN {'done': list_append(a.done, a.n), 'n': x.n} ELSE {'done': a.done, 'n': a.n + x.n} END) AS a FROM groups),
sizes AS (SELECT table_id, rows, CASE WHEN len(rows) <= 12 THEN [len(rows)] ELSE flatten(list_transform(list_append(a.done, a.n), lambda n: list_transform(range(0, n, 12), lambda k: least(12, n - k)))) END AS z FROM packed JOIN tabs USING (table_id)),
chunks AS (SELECT table_id, rows, z, unnest(range(0, len(z))) AS chunk_no FROM sizes)"""
LEVELS = """l AS (SELECT l_suppkey, list_sort(list(DISTINCT (10 + l_quantity::BIGINT % 4 * 10)::DOUBLE)) AS v FROM lineitem WHERE l_linenumber % 6 = 2 AND l_quantity::BIGINT % 3 <> 0 GROUP BY 1),
m AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 4 = 0 THEN [12::DOUBLE, 24::DOUBLE] WHEN len(v) >= 2 THEN v ELSE [] END AS lv FROM supplier LEFT JOIN l ON l_suppkey = s_suppkey)"""
NUMBERS = lambda xs: "[" + ", ".join(f"{x}::DOUBLE" for x in xs) + "]"
EQ = "k AS (SELECT *, p_partkey % 4 AS n FROM part WHERE p_partkey % 11 <> 10)"
GRID = f"""e AS (SELECT p_partkey AS eq_no, n, 'p' || (p_partkey % 100) AS paper_uid, p_partkey % 3 = 0 AS dom FROM k WHERE n IN (0, 2) OR (n = 1 AND p_partkey % 13 <> 12) OR (n = 3 AND p_partkey % 7 <> 6)),
j AS (SELECT e.*, s_suppkey AS s, list_max([CASE WHEN dom THEN 20::DOUBLE END, CASE WHEN s_suppkey % 3 = 1 THEN 25::DOUBLE END]) AS lo, list_min([CASE WHEN dom THEN 60::DOUBLE END, CASE WHEN s_suppkey % 3 = 1 THEN 65::DOUBLE END]) AS hi,
  CASE WHEN s_suppkey % 3 = 1 THEN {NUMBERS([25, 30, 40, 50, 60, 65])} WHEN s_suppkey IS NOT NULL THEN {NUMBERS(E.STANDARD_T)} END AS lv FROM e LEFT JOIN supplier ON paper_uid = 'p' || s_suppkey),
t AS (SELECT *, CASE WHEN lv IS NOT NULL THEN list_filter(lv, lambda x: lo IS NULL OR (x >= lo - 1e-9 AND x <= hi + 1e-9)) WHEN lo IS NOT NULL THEN list_transform(range(0, 8), lambda i: round_even((lo + i * (hi - lo) / 7) * 1e4, 0) / 1e4) ELSE {NUMBERS(E.DEFAULT_GRID['T'])} END AS ts,
  CASE WHEN n IN (0, 3) THEN [NULL::DOUBLE] WHEN s % 4 = 0 THEN list_filter({NUMBERS([12, 24])}, lambda x: s % 5 <> 0 OR x >= 15) WHEN s % 5 = 0 THEN {NUMBERS([15, 30, 45, 60, 75])} ELSE {NUMBERS(E.DEFAULT_GRID['M'])} END AS ms FROM j)"""
#: Every grid point of every model with its value, for moisture as it is (v1) and as a fraction (v2); each model is a group of its own.
POINTS = f"""pt AS (SELECT t.eq_no, t.n, t.paper_uid, t.s, tt, unnest(ms) AS mm FROM (SELECT *, unnest(ts) AS tt FROM t) t),
pv AS (SELECT pt.*, p_size::DOUBLE AS size, p_partkey % 2 = 0 AS is_dc, CASE WHEN p_partkey % 3 <> 1 THEN CASE WHEN p_partkey % 2 = 0 THEN 27::DOUBLE ELSE 915 END END AS mhz FROM pt JOIN part ON p_partkey = eq_no),
px AS (SELECT *, {{value}} AS v1, {{part}} AS v2 FROM pv),
pl AS (SELECT *, coalesce(v1 BETWEEN 0 AND top, FALSE) AS ok1, coalesce(v2 BETWEEN 0 AND top, FALSE) AS ok2 FROM (SELECT *, CASE WHEN coalesce(mhz <= 100, FALSE) THEN CASE WHEN is_dc THEN 300 ELSE 5000 END ELSE 200 END AS top FROM px)),
pd AS (SELECT *, n IN (1, 2) AND max(mm) OVER w > 1 AND count(*) FILTER (ok1) OVER w = 0 AND count(*) FILTER (ok2) OVER w >= 2 AS as_part FROM pl WINDOW w AS (PARTITION BY eq_no)),
pk AS (SELECT *, CASE WHEN as_part THEN v2 ELSE v1 END AS v, CASE WHEN as_part THEN ok2 ELSE ok1 END AS ok FROM pd)"""


def _value(m: str) -> str:
    return f"CASE n WHEN 0 THEN size + 0.5::DOUBLE + (-1.2::DOUBLE * pow(10::DOUBLE, -1::DOUBLE)) * tt WHEN 1 THEN size + 0.2::DOUBLE * {m} + 3e-3 * {m} * tt WHEN 2 THEN size + 0.05::DOUBLE * tt ** 2 / 10 - sqrt({m}) ELSE size + 0.03::DOUBLE * tt - 1e-4 * tt ** 2 END"


POINTS = POINTS.format(value=_value("mm"), part=_value("(mm * 0.01::DOUBLE)"))
LABELS = "CASE caption " + " ".join(f"WHEN '{c}' THEN {x}" for c, x in (
    (HEADS[0][0], "['Temperature (°C)', 'col2', 'Dielectric constant / 915 MHz', 'Loss factor / 915 MHz']"), (HEADS[1][0], "['Penetration depth (mm)', 'a', 'b', 'c']"), (HEADS[2][0], "['Moisture (%)', 'a', 'b', 'R2']"),
    (HEADS[3][0], "['x', 'col2', 'col3', 'note']"), (HEADS[4][0], "['Sample', '27 MHz', '915 MHz', '2.45 GHz']"), (HEADS[5][0], "['M (%, w.b.)', 'v [col 2]', 'v [col 3]', 'col4']"),
)) + " END"
NL = "chr(10)"
PAPER = f"""paper AS (SELECT 'p' || s_suppkey AS paper_uid, s_suppkey AS k, s_name, '10.1000/S' || s_suppkey AS doi,
  CASE s_suppkey % 3 WHEN 0 THEN 'moisture content of 10 to 30 % (wet basis) at 915 MHz ' WHEN 1 THEN 'moisture d.b. and 2.45 GHz ' ELSE 'none ' END || s_name AS full_text FROM supplier),
about AS (SELECT *, 'DOI: ' || doi || {NL} || 'Title: ' || s_name || {NL} || 'Materials: apple' || {NL} || CASE WHEN k % 2 = 1 THEN 'Frequencies, MHz: 27.12, 915.0' || {NL} ELSE '' END
  || 'Only what the authors measured themselves counts, not what they cite.' || {NL} || 'How it was measured:' || {NL} || CASE WHEN k % 2 = 0 THEN 'Probe of ' || s_name ELSE full_text END AS about FROM paper)"""
HEADER = "array_to_string(list_transform(headers, lambda r: array_to_string(r, ' | ')), ' // ')"
PARTS = f"""parts AS (SELECT c.*, len(z) AS n, rows[(coalesce(list_sum(z[1:chunk_no]), 0) + 1)::BIGINT : coalesce(list_sum(z[1:chunk_no + 1]), 0)::BIGINT] AS part, t.paper_uid, t.caption, t.headers, {LABELS} AS labels FROM chunks c JOIN (SELECT table_id, paper_uid, caption, headers FROM tabs) t USING (table_id))"""
TABLE_REQUESTS = f"""SELECT left(replace(raw, '/', '_'), 54) || '_' || left(sha256(raw), 9) AS custom_id, paper_uid, 'table' AS kind, chunk_no::INT AS unit_no, 'large' AS model,
  CASE WHEN chunk_no = 0 THEN about ELSE 'DOI: ' || doi || ', continued' END || {NL} || 'Table ' || table_id || CASE WHEN n > 1 THEN ', part ' || (chunk_no + 1) || ' of ' || n ELSE '' END || {NL} || 'Caption: ' || caption || {NL} || 'Header: ' || {HEADER} || {NL}
  || CASE WHEN n > 1 THEN 'This part is about: ' || array_to_string(list_sort(list_distinct(list_transform(part, lambda r: trim(r[1])))), ', ') || {NL} ELSE '' END || len(part) || ' rows:' || {NL}
  || array_to_string(list_transform(range(1, len(part) + 1), lambda i: i || '. ' || array_to_string(list_transform(range(1, len(labels) + 1), lambda j: labels[j] || '=' || part[i][j]), '; ')), {NL})
  || {NL} || 'Give one record for each of these ' || len(part) || ' rows.' AS prompt
FROM (SELECT *, paper_uid || '/' || table_id || '/' || chunk_no AS raw FROM parts) JOIN about USING (paper_uid)"""
SCREENINGS = f"""SELECT left(replace(raw, '/', '_'), 54) || '_' || left(sha256(raw), 9) AS custom_id, paper_uid, 'screen' AS kind, 0::INT AS unit_no, 'small' AS model,
  'DOI: ' || doi || {NL} || 'Title: ' || s_name || {NL} || 'The text begins:' || {NL} || full_text || CASE WHEN n > 0 THEN {NL} || 'It has ' || n || ' tables:' || {NL} || told ELSE '' END AS prompt
FROM (SELECT *, paper_uid || '/screen' AS raw FROM paper) LEFT JOIN (SELECT paper_uid, count(*) AS n, string_agg('- ' || table_id || ': ' || caption || '; header ' || array_to_string(headers[1], ' | ') || '; ' || len(rows) || ' rows, first ' || array_to_string(rows[1], ' | '), {NL} ORDER BY table_id) AS told FROM tabs GROUP BY 1) USING (paper_uid)"""
ORACLES = {
    "table_requests": f"WITH {TABLES}, {RUNS}, {PAPER}, {PARTS} {TABLE_REQUESTS}",
    "screening_requests": f"WITH {TABLES}, {PAPER} {SCREENINGS}",
    "parse_responses_strict": f"WITH {ctes('requests')} SELECT paper_uid, count(*) AS windows, count(*) FILTER (conv_id % 5 <> 0) AS failed_windows, FALSE AS malformed, bool_and(conv_id % 5 = 0) AS complete FROM conversations c JOIN requests q ON q.custom_id = 'c' || conv_id || '_' || (turn - 1) WHERE c.role = 'assistant' GROUP BY 1",
    "evaluate_models": f"""WITH {EQ}, {GRID}, {POINTS} SELECT paper_uid, CASE WHEN s IS NOT NULL THEN '10.1000/S' || s END AS doi, CASE WHEN s IS NOT NULL THEN '' END AS paper_id, 'material ' || (eq_no // 8) AS material_name, mhz AS frequency_mhz, tt AS temperature_c,
  CASE WHEN is_dc THEN round_even(v * 1000, 0) / 1000 END AS dielectric_constant, CASE WHEN NOT is_dc THEN round_even(v * 1000, 0) / 1000 END AS loss_factor, NULL::DOUBLE AS loss_tangent, mm AS moisture_content_pct,
  CASE WHEN mm IS NOT NULL AND s % 2 = 0 THEN 'wet' END AS moisture_basis, NULL::VARCHAR AS salt_content, 'Table ' || (eq_no % 3) || ' (regression)' AS source_table, 'equation' AS extraction_source, NULL::VARCHAR AS extraction_model,
  'equation_derived' AS data_provenance, CASE WHEN is_dc THEN 'dielectric_constant' ELSE 'loss_factor' END AS model_property, CASE WHEN eq_no % 6 = 0 THEN 0.95::DOUBLE END AS model_r_squared FROM pk WHERE ok""",
    "equation_report": f"""WITH {EQ}, {GRID}, {POINTS} SELECT a.paper_uid, coalesce(built, 0) AS models_built, a.n - coalesce(built, 0) AS models_unparsed, coalesce(points, 0) AS points_evaluated, 0::BIGINT AS points_out_of_domain,
  coalesce(points - kept, 0) AS values_implausible, coalesce(kept, 0) AS points_kept, 0::BIGINT AS groups_without_grid, '' AS no_grid_reason FROM (SELECT 'p' || (p_partkey % 100) AS paper_uid, count(*) AS n FROM part GROUP BY 1) a
  LEFT JOIN (SELECT paper_uid, count(*) AS built FROM e GROUP BY 1) b USING (paper_uid) LEFT JOIN (SELECT paper_uid, count(*) AS points, count(*) FILTER (ok) AS kept FROM pk GROUP BY 1) c USING (paper_uid)""",
    "expand_grid": f'WITH {EQ}, {GRID} SELECT eq_no, "T", unnest(ms) AS "M", NULL::DOUBLE AS "RHO", NULL::DOUBLE AS "F", NULL::DOUBLE AS "S" FROM (SELECT eq_no, unnest(ts) AS "T", ms FROM t)',
    "enrich_moisture": f"WITH {LEVELS} SELECT 'p' || k AS paper_uid, CASE k % 3 WHEN 0 THEN 'wet' WHEN 1 THEN 'dry' END AS moisture_basis, len(lv)::INT AS n_levels, CASE WHEN len(lv) > 0 THEN list_min(lv) WHEN k % 3 = 0 THEN 10 END::DOUBLE AS lo, CASE WHEN len(lv) > 0 THEN list_max(lv) WHEN k % 3 = 0 THEN 30 END::DOUBLE AS hi FROM m",
    "classify_tables": f"WITH {TABLES}, {SEEN}, c AS ({CLASSIFIED}) SELECT table_id, reason IN ('equation table', 'screened as data', 'screened out, but dielectric', 'dielectric word', 'paired numbers') AS decision, reason FROM c",
    "chunk_tables": f"WITH {TABLES}, {RUNS} SELECT table_id, chunk_no::INT AS chunk_no, z[chunk_no + 1]::INT AS n_rows, array_to_string(rows[(coalesce(list_sum(z[1:chunk_no]), 0) + 1)::BIGINT], '|') AS first_row FROM chunks",
    "extract_doi": f"WITH {TX} SELECT paper_uid, CASE WHEN doc_id = 8 THEN '10.8888/eight' WHEN d IS NULL THEN 'local/' || doc_id ELSE d END AS doi FROM (SELECT *, coalesce({find('substr(full_text, 1, 5000)')}, {find('full_text')}) AS d FROM texts)",
    "results_text": f"WITH {ctes('texts', 'sections')} SELECT t.paper_uid, coalesce(s.x, full_text) AS text FROM texts t LEFT JOIN (SELECT paper_uid, string_agg('## ' || heading || chr(10) || text, chr(10) || chr(10) ORDER BY idx) AS x FROM sections WHERE regexp_matches(lower(heading), {HAVE}) AND NOT regexp_matches(lower(heading), {SKIPS}) GROUP BY 1) s ON s.paper_uid = t.paper_uid",
    "text_windows": f"WITH {TX}, {WINDOWS} SELECT paper_uid, window_no::INT AS window_no, text FROM w",
    "detect_frequencies": f"WITH {TX}, {TABLES}, f AS (SELECT paper_uid, unnest({FREQ.replace('TEXT', 'caption || chr(32) || array_to_string(flatten(headers), chr(32))')}) AS x FROM tabs UNION ALL SELECT paper_uid, x FROM (SELECT paper_uid, unnest({FREQ.replace('TEXT', 'substr(full_text, 1, 5000)')}) AS x FROM texts) WHERE x IN (13.56, 27, 27.12, 40, 40.68, 433, 915, 1800, 2450, 5800)) SELECT t.paper_uid, coalesce((SELECT string_agg(printf('%.2f', x), ',' ORDER BY x) FROM (SELECT DISTINCT x FROM f WHERE f.paper_uid = t.paper_uid)), '') AS freqs FROM texts t",
    "apply_screening": f"WITH {TX} SELECT paper_uid, CASE WHEN doc_id % 3 = 0 THEN 'T' || doc_id ELSE 'old' END AS title, CASE WHEN doc_id % 3 = 1 THEN '10.7777/x' ELSE {find('full_text')} END AS doi, CASE WHEN doc_id % 3 = 0 THEN 2001 ELSE 1990 END AS year, CASE WHEN doc_id % 3 = 0 THEN 'A' ELSE '' END AS authors, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'x' END AS materials, CASE WHEN doc_id % 3 = 1 THEN 2 ELSE 1 END::BIGINT AS n_freqs, CASE WHEN doc_id % 3 = 0 THEN 'dry' ELSE 'wet' END AS moisture_basis FROM texts",
    "grid_from_cells": """WITH c AS (SELECT 't' || s_suppkey AS table_id, n_nationkey AS k, n_name AS text, n_nationkey // 5 AS r0, n_nationkey // 5 + 1 + (n_nationkey % 7 = 3)::INT AS r1, n_nationkey % 5 AS c0, n_nationkey % 5 + 1 + (n_nationkey % 4 = 1)::INT AS c1, n_nationkey < 5 OR n_nationkey = 17 AS head FROM supplier JOIN nation ON n_nationkey >= s_nationkey),
z AS (SELECT table_id, max(r1) AS nr, max(c1) AS nc FROM c GROUP BY 1), g AS (SELECT table_id, r, unnest(range(0, nc)) AS q FROM (SELECT table_id, nc, unnest(range(0, nr)) AS r FROM z)),
x AS (SELECT g.table_id, r, q, coalesce(arg_max(text, k), '') AS text FROM g LEFT JOIN c ON c.table_id = g.table_id AND r >= r0 AND r < r1 AND q >= c0 AND q < c1 GROUP BY ALL),
h AS (SELECT g.table_id, r, coalesce(bool_or(head), FALSE) AS head FROM (SELECT DISTINCT table_id, r FROM g) g LEFT JOIN c ON c.table_id = g.table_id AND r >= r0 AND r < r1 GROUP BY ALL),
l AS (SELECT *, bool_and(head) OVER (PARTITION BY table_id ORDER BY r) AS lead FROM h)
SELECT table_id, coalesce(string_agg(text, '|' ORDER BY r, q) FILTER (lead), '') AS headers, coalesce(string_agg(text, '|' ORDER BY r, q) FILTER (NOT lead), '') AS rows FROM x JOIN l USING (table_id, r) GROUP BY 1""",
    "column_labels": f"WITH {TABLES} SELECT table_id, CASE caption WHEN 'Dielectric properties at two frequencies' THEN 'Temperature (°C); col2; Dielectric constant / 915 MHz; Loss factor / 915 MHz' WHEN 'Penetration depth in mm' THEN 'Penetration depth (mm); a; b; c' WHEN 'Coefficients' THEN 'Moisture (%); a; b; R2' WHEN 'Density of samples' THEN 'x; col2; col3; note' WHEN 'Results' THEN 'Sample; 27 MHz; 915 MHz; 2.45 GHz' ELSE 'M (%, w.b.); v [col 2]; v [col 3]; col4' END AS labels FROM tabs",
    "classify_equation_tables": f"WITH {TABLES}, {SEEN} SELECT table_id, is_equation FROM told",
    "header_damage": f"WITH {TABLES}, r AS (SELECT 'table_' || l_suppkey || '_' || l_linenumber AS table_id, count(*) AS n, count(*) FILTER (l_tax < 0.05::DOUBLE) AS nt, count(*) FILTER (l_tax < 0.03::DOUBLE) AS nm FROM lineitem GROUP BY 1) SELECT table_id, caption IN ('Dielectric properties at two frequencies', 'Density of samples') AS gaps, coalesce(CASE caption WHEN 'Dielectric properties at two frequencies' THEN nt / n > 0.5 WHEN 'Coefficients' THEN nm / n > 0.5 WHEN 'Moisture content and eps regression' THEN nm / n > 0.5 ELSE FALSE END, FALSE) AS missing FROM tabs LEFT JOIN r USING (table_id)",
    "build_requests": f"""WITH {TX}, {WINDOWS} SELECT left(replace(raw, '/', '_'), 54) || '_' || left(sha256(raw), 9) AS custom_id, paper_uid, 'text' AS kind, window_no::INT AS unit_no, 'large' AS model,
  CASE WHEN window_no = 0 THEN coalesce('Title: ' || s_name || chr(10) || 'Materials: apple' || chr(10) || 'Frequencies: ' || CASE WHEN s_suppkey % 2 = 1 THEN '27.12, 915.0' ELSE '' END, '') ELSE 'Part ' || (window_no + 1) END || chr(10) || chr(10) || text AS prompt
FROM (SELECT *, paper_uid || '/text/' || window_no AS raw FROM w) LEFT JOIN supplier ON paper_uid = 'p' || s_suppkey""",
    "parse_responses": "SELECT 'c' || conv_id || '_' || (turn - 1) AS custom_id, CASE conv_id % 5 WHEN 1 THEN 1 WHEN 4 THEN 0 ELSE 2 END::BIGINT AS n, conv_id % 5 < 2 AS response_complete FROM conversations WHERE role = 'assistant'",
    "records_from_responses": f"""WITH {ctes('requests')} SELECT 'm' || conv_id AS material_name, NULL::DOUBLE AS temperature_c, 3.5::DOUBLE AS dielectric_constant, NULL::DOUBLE AS loss_factor, NULL::DOUBLE AS moisture_content_pct, 'a ] }} b' AS salt_content, NULL::DOUBLE AS electrical_conductivity_s_m,
  NULL AS measurement_method, NULL AS source_location, 27::DOUBLE AS frequency_mhz, NULL::DOUBLE AS loss_tangent, 'wet' AS moisture_basis, '' AS source_table, paper_uid, '10.5000/' || paper_uid AS doi, 'table' AS extraction_source, 'large' AS extraction_model, 'measured_table' AS data_provenance
FROM (SELECT *, unnest(range(0, CASE conv_id % 5 WHEN 1 THEN 1 WHEN 4 THEN 0 ELSE 2 END)) AS k FROM conversations WHERE role = 'assistant') c JOIN requests q ON q.custom_id = 'c' || conv_id || '_' || (turn - 1)""",
    "parse_coefficients": "SELECT p_partkey, round(CASE p_partkey % 7 WHEN 0 THEN -(p_size + 0.25) WHEN 1 THEN p_size * 1e-3 WHEN 2 THEN -p_size * 1e-2 WHEN 3 THEN p_size + 0.5 WHEN 4 THEN p_size WHEN 5 THEN NULL ELSE ('1' || p_size)::DOUBLE END::DOUBLE, 6) AS value FROM part",
    "build_models": f"""WITH {EQ} SELECT p_partkey AS eq_no, p_size + 0.5::DOUBLE AS coef, 0 AS t, 0 AS m FROM k WHERE n = 0 UNION ALL SELECT p_partkey, -1.2::DOUBLE * pow(10::DOUBLE, -1::DOUBLE), 1, 0 FROM k WHERE n = 0
UNION ALL SELECT p_partkey, c, t, m FROM k, (VALUES (0, 0, 0), (1, 0, 1), (2, 1, 1)) v(i, t, m), LATERAL (SELECT CASE i WHEN 0 THEN p_size::DOUBLE WHEN 1 THEN 0.2::DOUBLE ELSE 3e-3 END AS c) WHERE n = 1 AND p_partkey % 13 <> 12
UNION ALL SELECT p_partkey, CASE i WHEN 0 THEN p_size::DOUBLE WHEN 1 THEN 0.03::DOUBLE ELSE -1e-4 END, i, 0 FROM k, (VALUES (0), (1), (2)) v(i) WHERE n = 3 AND p_partkey % 7 <> 6""",
}
