"""Audit rules and evaluation over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corundum.functions.lineage import cut, kept
from corundum.functions.scalars import material_match
from corundum.operators import audit as Q
from corundum.operators import evaluation as V
from corundum.operators.assembly import loss_tangent
from corundum.plans.assembly_queries import tangent
from corundum.plans.fixtures import ctes, frame
from corundum.schema import COLUMNS, FLAG_FROM_RECORD

CARRIED = FLAG_FROM_RECORD
RKEY = "CASE WHEN trim(coalesce(paper_uid,'')) <> '' THEN trim(paper_uid) WHEN trim(coalesce(doi,'')) <> '' THEN 'doi:' || lower(trim(doi)) WHEN trim(coalesce(paper_id,'')) <> '' THEN 'paper:' || lower(trim(paper_id)) ELSE 'title:' || lower(trim(coalesce(title,''))) END"
IN = f"WITH {ctes('records')}, t AS ({tangent('records')}), k AS (SELECT *, {RKEY} AS paper_key FROM t)"
SORTED = ", ".join(f"{c} NULLS LAST" for c in COLUMNS)
CONDITIONS = ", ".join(Q.CONDITIONS)


def flags(sql: str, severity: str, rule: str) -> str:
    return f"SELECT {', '.join(CARRIED)}, '{severity}' AS severity, '{rule}' AS rule_id FROM ({sql})"


FLAGS = {
    "audit_water_bound": [flags("SELECT * FROM k WHERE frequency_mhz > 100 AND dielectric_constant > CASE WHEN frequency_mhz >= 2000 THEN 87 ELSE 88 END", "CRITICAL", "WATER_UPPER_BOUND")],
    "audit_freq_inversion": [
        flags(
            f"SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {CONDITIONS} ORDER BY dielectric_constant, {SORTED}) AS nth FROM (SELECT *, min(dielectric_constant) FILTER (frequency_mhz <= 100) OVER w AS lo, max(dielectric_constant) FILTER (frequency_mhz > 100) OVER w AS hi FROM k WINDOW w AS (PARTITION BY {CONDITIONS})) WHERE frequency_mhz <= 100 AND dielectric_constant IS NOT NULL AND lo < hi * 0.8::DOUBLE) WHERE nth = 1",
            "CRITICAL", "FREQ_INVERSION",
        )
    ],
    "audit_negative": [flags("SELECT * FROM k WHERE dielectric_constant < 1.0", "CRITICAL", "NEGATIVE_DC"), flags("SELECT * FROM k WHERE loss_factor < 0", "CRITICAL", "NEGATIVE_LF")],
    "audit_divergence": [
        flags(
            f"SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {CONDITIONS}, frequency_mhz ORDER BY {SORTED}) AS nth, max(dielectric_constant) OVER w - min(dielectric_constant) OVER w AS span, avg(dielectric_constant) OVER w AS mean, count(dielectric_constant) OVER w AS n FROM k WINDOW w AS (PARTITION BY {CONDITIONS}, frequency_mhz)) WHERE nth = 1 AND n >= 2 AND mean > 0 AND span / mean > 0.2::DOUBLE",
            "CRITICAL", "DUPLICATE_DIVERGE",
        )
    ],
    "audit_swap": [flags("SELECT * FROM k WHERE frequency_mhz > 100 AND loss_factor > dielectric_constant AND moisture_content_pct > 50 AND trim(coalesce(salt_content,'')) = ''", "WARNING", "DC_LF_SWAP")],
    "audit_outliers": [
        flags(f"SELECT * FROM (SELECT *, count({c}) OVER w AS n, avg({c}) OVER w AS mean, stddev_samp({c}) OVER w AS sd FROM k WINDOW w AS (PARTITION BY paper_key)) WHERE n >= 5 AND sd > 0 AND abs({c} - mean) / sd > 3", "WARNING", "OUTLIER")
        for c in ("dielectric_constant", "loss_factor")
    ],
    "audit_temp_monotonic": [
        flags(
            f"SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY {{g}}) AS n, lag(dielectric_constant) OVER (PARTITION BY {{g}} ORDER BY temperature_c NULLS LAST, {SORTED}) AS p FROM k WHERE frequency_mhz BETWEEN 2400 AND 2500 AND moisture_content_pct > 50) WHERE n >= 3 AND dielectric_constant - p > 5".format(g="paper_key, material_name, frequency_mhz, moisture_content_pct, moisture_basis, salt_content"),
            "WARNING", "TEMP_MONO",
        )
    ],
    "audit_missing_pair": [flags("SELECT * FROM k WHERE dielectric_constant IS NOT NULL AND loss_factor IS NULL", "WARNING", "MISSING_LF"), flags("SELECT * FROM k WHERE loss_factor IS NOT NULL AND dielectric_constant IS NULL", "WARNING", "MISSING_DC")],
    "audit_missing_metadata": [flags(f"SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY paper_key ORDER BY {SORTED}) AS nth FROM k WHERE trim(coalesce(title,'')) IN ('','nan') OR trim(coalesce(authors,'')) IN ('','nan')) WHERE nth = 1", "INFO", "MISSING_META")],
    "audit_loss_tangent": [flags("SELECT * FROM k WHERE frequency_mhz > 100 AND loss_tangent > 10", "INFO", "HIGH_LOSS_TAN")],
}
ALL = " UNION ALL ".join(x for v in FLAGS.values() for x in v)


VERDICT = "CASE WHEN frequency_mhz = 27 THEN 'LIKELY_ERROR' WHEN frequency_mhz = 40 THEN 'POSSIBLY_OK' WHEN frequency_mhz = 915 THEN 'FALSE_ALARM' END"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loss_tangent(frame(spark, sf_dir, "records"))


def _rule(name: str):
    job = getattr(Q, name)
    return lambda spark, sf_dir: job(_records(spark, sf_dir)).select(*CARRIED, "severity", "rule_id")


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, lines = F.split("prompt", "\nROWS\n"), lambda c: F.size(F.split(c, "\n")).cast("long")
    pages = Q.audit_review(_records(spark, sf_dir)).select("paper_key", "n_flags", lines(parts[0]).alias("listed"), lines(parts[1]).alias("rows"))
    # Every page has a head and repeats the paper's rows.
    return pages.groupBy("paper_key").agg(F.sum("n_flags").alias("n_flags"), (F.sum(F.col("listed") - 1) + F.max("rows") + 2).alias("lines"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of at most 20 flags: how many each has, its first and last number, and whether its numbers follow one another."""
    pages = Q.audit_review(_records(spark, sf_dir), page=20)
    number = F.transform(F.regexp_extract_all("prompt", F.lit(r"(?m)^Flag (\d+): "), 1), lambda x: x.cast("long"))
    pages = pages.withColumn("numbers", number)
    first, last = F.col("numbers")[0], F.element_at("numbers", -1)
    return pages.select("paper_key", "page", "n_flags", first.alias("first"), last.alias("last"), (F.col("numbers") == F.sequence(first, last)).alias("in_order"))


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = Q.audit_swap(_records(spark, sf_dir)).withColumn("n", F.row_number().over(Window.partitionBy("paper_key").orderBy(*[F.col(c).asc_nulls_last() for c in CARRIED])))
    text = "Intro\n Flag 1: LIKELY_ERROR — wrong column\nFlag 2 - FALSE_ALARM: fine\nFlag 2: POSSIBLY_OK\nFlag 3 nothing\nFlag 11: possibly_ok – ok"
    replies = f.select("paper_key").distinct().withColumn("text", F.lit(text))
    return Q.audit_apply_verdicts(f.select("paper_key", "n", "material_name"), replies).groupBy("paper_key", "n", "verdict", "reason").agg(F.count("*").alias("flags"))


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Reference rows and predictions, each written once, as their numbering is a shuffle of all rows."""
    return cut(frame(spark, sf_dir, "gold")), cut(frame(spark, sf_dir, "pred"))


def _two(job):
    return lambda spark, sf_dir: job(*_sides(spark, sf_dir))


def _same_row(gold: DataFrame, pred: DataFrame) -> DataFrame:
    pairs = gold.select("gold_id", "paper_key").join(pred.select(F.col("pred_id").alias("gold_id"), "pred_id", "paper_key"), ["gold_id", "paper_key"]).select("gold_id", "pred_id")
    return V.outcome(gold, pred, pairs)


def _match_twos(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Matches where two reference rows and two predictions stand against each other: how many, and their total score."""
    two = lambda c: F.concat(F.lit("rows "), F.floor(F.col(c) / 2).cast("string"))
    gold, pred = gold.withColumn("paper_key", two("gold_id")), pred.withColumn("paper_key", two("pred_id"))
    pairs = V.match_candidates(gold, pred)
    m = V.match_records(gold, pred, pairs).join(pairs.select("gold_id", "pred_id", "score"), ["gold_id", "pred_id"], "left")
    key = F.coalesce(two("gold_id"), two("pred_id")).alias("paper_key")
    return m.groupBy(key).agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("tp", "fp", "fn")], F.round(F.coalesce(F.sum("score"), F.lit(0.0)), 6).alias("total"))


def _match_stars(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Matches of classes of which one stands against all others of its component, where the cheapest come first: how many, and their total score."""
    g, p = cut(V.classified(gold, "gold_id")), cut(V.classified(pred, "pred_id"))
    pairs = kept(g.sparkSession, lambda: V.class_candidates(g, p))
    n_of = lambda c: pairs.groupBy(c).agg(F.count("*").alias(f"many_{c}"))
    known = pairs.join(n_of("left"), "left").join(n_of("right"), "right")
    centre = lambda c, other: known.groupBy(c).agg((F.max(f"many_{other}") == 1).alias(f"star_{c}"))
    stars = known.join(centre("left", "right"), "left").join(centre("right", "left"), "right").where("star_left or star_right").select("left", "right", "cost")
    m = V.match_records(gold, pred).where("kind = 'tp'").join(g.select("gold_id", "paper_key", F.col("class").alias("right")), "gold_id").join(p.select("pred_id", F.col("class").alias("left")), "pred_id")
    return m.join(stars, ["left", "right"]).groupBy("paper_key").agg(F.count("*").alias("tp"), F.round(F.sum("cost"), 6).alias("total"))


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = frame(spark, sf_dir, "part")
    return p.select(material_match("p_name", "p_type").alias("name_type"), material_match("p_name", F.concat("p_name", F.lit(" samples, 5% dried"))).alias("same")).groupBy("name_type", "same").agg(F.count("*").alias("n"))


def _compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold, pred = _sides(spark, sf_dir)
    pred = pred.withColumn("model", F.concat(F.lit("m"), (F.col("pred_id") % 3).cast("string")))
    pairs = gold.select("gold_id", "paper_key").join(pred.select(F.col("pred_id").alias("gold_id"), "pred_id", "paper_key", "model"), ["gold_id", "paper_key"])
    tp = pairs.select(F.lit("tp").alias("kind"), "gold_id", "pred_id", "model")
    fp = pred.join(pairs.select("pred_id"), "pred_id", "left_anti").select(F.lit("fp").alias("kind"), F.lit(None).cast("bigint").alias("gold_id"), "pred_id", "model")
    costs = frame(spark, sf_dir, "usage").select(F.concat(F.lit("m"), (F.col("input_tokens") % 3).cast("string")).alias("model"), "paper", (F.col("output_tokens") / 1e3).alias("cost_usd"), F.col("output_tokens").cast("double").alias("seconds"), F.col("input_tokens").alias("tokens"))
    return V.compare_models(gold, pred, tp.unionByName(fp), costs)


def tokens(c: str) -> str:
    words = f"list_filter(regexp_extract_all(lower(coalesce({c},'')), '[a-z]+|[0-9]+(?:\\.[0-9]+)?%?'), lambda w: NOT regexp_matches(w, '^[0-9]') AND w NOT IN ('percent','pct','wb','db','salt'))"
    stem = "CASE WHEN regexp_full_match(w, '.+ies') THEN left(w, -3) || 'y' WHEN regexp_full_match(w, '.+oes') THEN left(w, -2) WHEN regexp_full_match(w, '.{2,}[^s]s') THEN left(w, -1) ELSE w END"
    return f"list_sort(list_distinct(list_filter(list_transform({words}, lambda w: {stem}), lambda w: w NOT IN ('dried','fresh','kernel','kernels','sample','slice','slices'))))"


def tokens_ok(a: str, b: str) -> str:
    return f"(len({a}) = 0 OR len({b}) = 0 OR list_has_all({a}, {b}) OR list_has_all({b}, {a}))"


GP = f"WITH {ctes('gold', 'pred')}"
SALT = "lower(trim(coalesce({}.salt_content,'')))"
NUM = "TRY_CAST(nullif(regexp_extract(" + SALT + ", '[0-9.]+'), '') AS DOUBLE)"
CANDIDATES = f"""
SELECT g.paper_key, gold_id, pred_id, abs(p.frequency_mhz - g.frequency_mhz) + abs(p.temperature_c - g.temperature_c) * 10
  + CASE WHEN p.moisture_content_pct IS NOT NULL AND g.moisture_content_pct IS NOT NULL THEN abs(p.moisture_content_pct - g.moisture_content_pct) * 5
         WHEN (p.moisture_content_pct IS NULL) <> (g.moisture_content_pct IS NULL) THEN 50 ELSE 0 END
  + CASE WHEN ({SALT.format('p')} <> '') <> ({SALT.format('g')} <> '') THEN 100 ELSE 0 END
  + CASE WHEN p.electrical_conductivity_s_m IS NOT NULL AND g.electrical_conductivity_s_m IS NOT NULL THEN abs(p.electrical_conductivity_s_m - g.electrical_conductivity_s_m) * 10
         WHEN (p.electrical_conductivity_s_m IS NULL) <> (g.electrical_conductivity_s_m IS NULL) THEN 100 ELSE 0 END
  + CASE WHEN p.tok <> g.tok THEN 10 ELSE 0 END AS score
FROM (SELECT *, {tokens('material_name')} AS tok FROM gold) g JOIN (SELECT *, {tokens('material_name')} AS tok FROM pred) p ON g.paper_key = p.paper_key
WHERE (g.frequency_mhz <= 0 OR abs(p.frequency_mhz - g.frequency_mhz) / g.frequency_mhz <= 0.05::DOUBLE) AND abs(p.temperature_c - g.temperature_c) <= 2 AND {tokens_ok('p.tok', 'g.tok')}
  AND (p.moisture_content_pct IS NULL OR g.moisture_content_pct IS NULL OR abs(p.moisture_content_pct - g.moisture_content_pct) <= 2)
  AND coalesce(abs({NUM.format('p')} - {NUM.format('g')}) <= 0.1::DOUBLE, TRUE)
  AND (p.electrical_conductivity_s_m IS NULL OR g.electrical_conductivity_s_m IS NULL OR abs(p.electrical_conductivity_s_m - g.electrical_conductivity_s_m) <= 0.01::DOUBLE)"""
#: Classes of rows that matching can't tell apart, pairs of them, and stars among those.
CLASS = "class AS (SELECT {row}, min({row}) OVER w AS class, count(*) OVER w AS n FROM (SELECT *, {tok} AS tok FROM {side}) {side} WINDOW w AS (PARTITION BY paper_key, frequency_mhz, temperature_c, moisture_content_pct, lower(coalesce(moisture_basis, '')), {salt}, electrical_conductivity_s_m, tok))"
CLASSES = ", ".join(side[0] + CLASS.format(row=f"{side}_id", side=side, tok=tokens("material_name"), salt=SALT.format(side)) for side in ("gold", "pred"))
STARS = f"""c AS ({CANDIDATES}), {CLASSES},
e AS (SELECT DISTINCT paper_key, g.class AS r, p.class AS l, g.n AS n_r, p.n AS n_l, score FROM c JOIN gclass g USING (gold_id) JOIN pclass p USING (pred_id)),
d AS (SELECT *, count(*) OVER (PARTITION BY r) AS many_r, count(*) OVER (PARTITION BY l) AS many_l FROM e),
s AS (SELECT *, max(many_l) OVER (PARTITION BY r) = 1 AS star_r, max(many_r) OVER (PARTITION BY l) = 1 AS star_l FROM d),
f AS (
  SELECT *, CASE WHEN star_r
    THEN least(n_l, greatest(0, n_r - coalesce(sum(n_l) OVER (PARTITION BY r ORDER BY score, l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)))
    ELSE least(n_r, greatest(0, n_l - coalesce(sum(n_r) OVER (PARTITION BY l ORDER BY score, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) END AS flow
  FROM s WHERE star_r OR star_l)
SELECT paper_key, sum(flow)::BIGINT AS tp, round(sum(flow * score), 6)::DOUBLE AS total FROM f GROUP BY 1"""
WRONG = " OR ".join(f"coalesce(g.{c} IS NOT NULL AND (p.{c} IS NULL OR (g.{c} <> 0 AND abs(p.{c} - g.{c}) / abs(g.{c}) > 0.05::DOUBLE)), FALSE)" for c in ("dielectric_constant", "loss_factor"))


SAME = "g.gold_id = p.pred_id AND g.paper_key = p.paper_key"


def counted(model: str = "") -> str:
    on = f"AND p.pred_id % 3 = {model}" if model else ""
    return f"(SELECT count(*) AS tp, (SELECT count(*) FROM pred p WHERE NOT EXISTS (SELECT 1 FROM gold g WHERE {SAME}) {on}) AS fp, {'0' if model else f'(SELECT count(*) FROM gold g WHERE NOT EXISTS (SELECT 1 FROM pred p WHERE {SAME}))'} AS fn, count(*) FILTER ({WRONG}) AS ve FROM gold g JOIN pred p ON {SAME} {on})"


METRICS = "tp, fp, fn, CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END AS recall"
F1 = "CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END"
RND = "round_even({} * 10000, 0) / 10000"
TWOS = ctes("gold", "pred").replace("gold AS (", "gold0 AS (").replace("pred AS (", "pred0 AS (") + """, gold AS (SELECT * REPLACE ('rows ' || (gold_id // 2) AS paper_key) FROM gold0),
pred AS (SELECT * REPLACE ('rows ' || (pred_id // 2) AS paper_key) FROM pred0)"""
AWARE = {"require_reported_moisture": True, "require_reported_salt": True, "require_matching_moisture_basis": True, "require_reported_conductivity": True}
#: Predictions that leave out what the reference reports, here and there.
LEFT_OUT = {
    "moisture_content_pct": "CASE WHEN pred_id % 5 <> 0 THEN moisture_content_pct END",
    "moisture_basis": "CASE pred_id % 3 WHEN 0 THEN 'unknown' WHEN 1 THEN 'Wet' ELSE moisture_basis END",
    "salt_content": "CASE WHEN pred_id % 7 <> 0 THEN salt_content END",
    "electrical_conductivity_s_m": "CASE WHEN pred_id % 4 <> 0 THEN electrical_conductivity_s_m END",
}
UNREPORTED = ", ".join(f"{v} AS {k}" for k, v in LEFT_OUT.items())
REPORTED = f"""
  AND (g.moisture_content_pct IS NULL OR p.moisture_content_pct IS NOT NULL) AND ({SALT.format('g')} = '' OR {SALT.format('p')} <> '')
  AND (g.electrical_conductivity_s_m IS NULL OR p.electrical_conductivity_s_m IS NOT NULL)
  AND (g.moisture_content_pct IS NULL OR p.moisture_content_pct IS NULL OR lower(coalesce(p.moisture_basis, '')) NOT IN ('wet', 'dry') OR lower(coalesce(g.moisture_basis, '')) NOT IN ('wet', 'dry')
       OR lower(p.moisture_basis) = lower(g.moisture_basis))"""


def _unreported(pred: DataFrame) -> DataFrame:
    return pred.withColumns({k: F.expr(v) for k, v in LEFT_OUT.items()})


QUERIES = {name: _rule(name) for name in FLAGS} | {
    "audit_report": lambda spark, sf_dir: Q.audit_report(_records(spark, sf_dir)).select(*CARRIED, "severity", "rule_id"),
    "audit_summary": lambda spark, sf_dir: Q.audit_summary(Q.audit_report(_records(spark, sf_dir)).withColumn("verdict", F.expr(VERDICT))),
    "audit_review_requests": _requests,
    "audit_review_pages": _pages,
    "audit_apply_verdicts": _verdicts,
    "filter_to_reference_papers": _two(lambda g, p: V.filter_to_reference_papers(g, p).groupBy("paper_key").agg(F.count("*").alias("n"))),
    "filter_to_reference_frequencies": _two(lambda g, p: V.filter_to_reference_frequencies(g, p).groupBy("paper_key", "frequency_mhz").agg(F.count("*").alias("n"))),
    "material_match": _tokens,
    "match_candidates": _two(lambda g, p: V.match_candidates(g, p)),
    "match_candidates_aware": _two(lambda g, p: V.match_candidates(g, _unreported(p), **AWARE)),
    "match_records": _two(lambda g, p: V.match_records(g, p, V.match_candidates(g, p))),
    "match_records_twos": _two(_match_twos),
    "match_records_stars": _two(_match_stars),
    "match_metrics": _two(lambda g, p: V.match_metrics(g, p, _same_row(g, p))),
    "per_paper_metrics": _two(lambda g, p: V.per_paper_metrics(g, p, _same_row(g, p))),
    "compare_models": _compare,
    "reference_paper_map": lambda spark, sf_dir: V.reference_paper_map(frame(spark, sf_dir, "gold"), frame(spark, sf_dir, "records"), frame(spark, sf_dir, "papers")),
}
ORACLES = {name: f"{IN} " + " UNION ALL ".join(v) for name, v in FLAGS.items()} | {
    "audit_report": f"{IN} {ALL}",
    "audit_summary": f"{IN} SELECT severity, rule_id, count(*) AS flags, count(DISTINCT title) AS titles, count(*) FILTER (v = 'LIKELY_ERROR') AS likely_error, count(*) FILTER (v = 'POSSIBLY_OK') AS possibly_ok, count(*) FILTER (v = 'FALSE_ALARM') AS false_alarm FROM (SELECT *, {VERDICT} AS v FROM ({ALL})) GROUP BY 1, 2",
    "audit_review_requests": f"{IN} SELECT paper_key, f.n AS n_flags, 2 + f.n + least(30, r.n) AS lines FROM (SELECT paper_key, count(*) AS n FROM ({ALL}) WHERE severity <> 'INFO' GROUP BY 1) f JOIN (SELECT paper_key, count(*) AS n FROM k GROUP BY 1) r USING (paper_key)",
    "audit_review_pages": f"""{IN}, f AS (SELECT paper_key, count(*) AS n FROM ({ALL}) WHERE severity <> 'INFO' GROUP BY 1), p AS (SELECT paper_key, n, unnest(range(0, (n + 19) // 20)) AS page FROM f)
SELECT paper_key, page, least(20, n - 20 * page) AS n_flags, 20 * page + 1 AS first, least(n, 20 * page + 20) AS last, TRUE AS in_order FROM p""",
    "audit_apply_verdicts": f"{IN} SELECT paper_key, q::INT AS n, CASE q WHEN 1 THEN 'LIKELY_ERROR' WHEN 2 THEN 'FALSE_ALARM' WHEN 11 THEN 'POSSIBLY_OK' END AS verdict, CASE q WHEN 1 THEN 'wrong column' WHEN 2 THEN 'fine' WHEN 11 THEN 'ok' END AS reason, count(*) AS flags FROM (SELECT paper_key, ROW_NUMBER() OVER (PARTITION BY paper_key) AS q FROM ({' UNION ALL '.join(FLAGS['audit_swap'])})) GROUP BY paper_key, q",
    "filter_to_reference_papers": f"{GP} SELECT paper_key, count(*) AS n FROM pred WHERE paper_key IN (SELECT paper_key FROM gold) GROUP BY 1",
    "filter_to_reference_frequencies": f"{GP}, a AS (SELECT DISTINCT paper_key, frequency_mhz AS f FROM gold) SELECT paper_key, frequency_mhz, count(*) AS n FROM pred p WHERE frequency_mhz IS NULL OR NOT EXISTS (SELECT 1 FROM a WHERE a.paper_key = p.paper_key) OR EXISTS (SELECT 1 FROM a WHERE a.paper_key = p.paper_key AND abs(p.frequency_mhz - f) / f <= 0.05::DOUBLE) GROUP BY 1, 2",
    "material_match": f"WITH x AS (SELECT {tokens('p_name')} AS a, {tokens('p_type')} AS b, {tokens(chr(40) + 'p_name || ' + chr(39) + ' samples, 5% dried' + chr(39) + chr(41))} AS c FROM part) SELECT {tokens_ok('a', 'b')} AS name_type, {tokens_ok('a', 'c')} AS same, count(*) AS n FROM x GROUP BY 1, 2",
    "match_candidates": f"{GP} {CANDIDATES}",
    "match_candidates_aware": f"WITH {ctes('gold', 'pred').replace('pred AS (', 'pred0 AS (')}, pred AS (SELECT * REPLACE ({UNREPORTED}) FROM pred0) {CANDIDATES} {REPORTED}",
    "match_records_twos": f"""WITH {TWOS}, c AS ({CANDIDATES}),
m AS (SELECT paper_key, 1 AS n, score AS total FROM c UNION ALL SELECT a.paper_key, 2, a.score + b.score FROM c a JOIN c b ON a.paper_key = b.paper_key AND a.gold_id < b.gold_id AND a.pred_id <> b.pred_id),
best AS (SELECT paper_key, arg_min(n, (-n, total)) AS n, arg_min(total, (-n, total)) AS total FROM m GROUP BY 1)
SELECT paper_key, coalesce(n, 0)::BIGINT AS tp, preds - coalesce(n, 0)::BIGINT AS fp, golds - coalesce(n, 0)::BIGINT AS fn, round(coalesce(total, 0), 6)::DOUBLE AS total
FROM (SELECT paper_key, count(*) AS golds FROM gold GROUP BY 1) JOIN (SELECT paper_key, count(*) AS preds FROM pred GROUP BY 1) USING (paper_key) LEFT JOIN best USING (paper_key)""",
    "match_records_stars": f"{GP}, {STARS}",
    "match_metrics": f"{GP} SELECT tp, fp, fn, precision, recall, {F1} AS f1, ve AS value_errors, CASE WHEN tp = 0 THEN 0 ELSE (tp - ve)::DOUBLE / tp END AS value_accuracy FROM (SELECT {METRICS}, ve FROM {counted()})",
    "per_paper_metrics": f"{GP}, g AS (SELECT paper_key, count(*) AS gold FROM gold GROUP BY 1), p AS (SELECT paper_key, count(*) AS pred FROM pred GROUP BY 1), m AS (SELECT paper_key, count(*) FILTER (kind = 'tp') AS tp, count(*) FILTER (kind = 'fp') AS fp, count(*) FILTER (kind = 'fn') AS fn FROM (SELECT 'tp' AS kind, g.paper_key FROM gold g JOIN pred p ON {SAME} UNION ALL SELECT 'fp', paper_key FROM pred p WHERE NOT EXISTS (SELECT 1 FROM gold g WHERE {SAME}) UNION ALL SELECT 'fn', paper_key FROM gold g WHERE NOT EXISTS (SELECT 1 FROM pred p WHERE {SAME})) GROUP BY 1) SELECT paper_key, gold, pred, {METRICS} FROM (SELECT paper_key, coalesce(gold, 0) AS gold, coalesce(pred, 0) AS pred, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn FROM g FULL JOIN p USING (paper_key) LEFT JOIN m USING (paper_key))",
    "compare_models": f"WITH {ctes('gold', 'pred', 'usage')} SELECT model, tp, fp, fn, {RND.format('precision')} AS precision, {RND.format('recall')} AS recall, {RND.format(F1)} AS f1, {RND.format('CASE WHEN tp = 0 THEN 0 ELSE (tp - ve)::DOUBLE / tp END')} AS value_accuracy, {RND.format('cost')} AS cost, {RND.format('cost / papers')} AS cost_per_paper, round_even(seconds / papers * 10, 0) / 10 AS seconds_per_paper, tokens FROM (SELECT {METRICS}, ve, model FROM (" + " UNION ALL ".join(f"SELECT *, 'm{k}' AS model FROM {counted(str(k))}" for k in range(3)) + ")) JOIN (SELECT 'm' || (input_tokens % 3) AS model, sum(output_tokens)::DOUBLE / 1e3 AS cost, sum(output_tokens)::DOUBLE AS seconds, sum(input_tokens)::BIGINT AS tokens, count(DISTINCT paper) AS papers FROM usage GROUP BY 1) USING (model)",
    "reference_paper_map": f"WITH {ctes('gold', 'records', 'papers')}, r AS (SELECT 'supplier ' || regexp_extract(paper_id, '^[0-9]+') AS paper_key, min(doi) AS doi FROM records WHERE doi <> '' GROUP BY 1), n AS (SELECT 'supplier ' || regexp_extract(pdf_path, '[0-9]+') AS paper_key, min(doi) AS doi FROM papers WHERE doi <> '' GROUP BY 1) SELECT g.paper_key, coalesce(r.doi, n.doi) AS doi FROM (SELECT DISTINCT paper_key FROM gold) g LEFT JOIN r USING (paper_key) LEFT JOIN n USING (paper_key)",
}
