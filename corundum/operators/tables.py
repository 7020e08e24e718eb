"""Parsed tables: grids, labels, classification and chunks. Everything is an expression over one table's arrays, so no table moves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words of captions, headers and cells (fixed values).
DIELECTRIC = ("dielectric", "ε", "𝛜", "loss factor", "permittivity", "loss tangent", "tan δ", "epsilon", "e 0", "e 00", "e'", "e''", "e′", "e″", "dps")
PENETRATION = ("penetration depth", "penetration depths", "dp (m", "dp(m", "dp (mm", "dp(mm", "dp (cm", "dp(cm", "power penetration")
SKIP = ("penetration depth", "coefficient", "reference", "literature", "comparison with", "density", "proximate", "compositional", "author", "source")
EXPLICIT = ("dielectric", "ε'", "ε''", "epsilon", "loss factor", "permittivity", "tan δ", "loss tangent")
NARROW = ("dielectric", "ε'", "ε''", "loss factor", "permittivity")
EQUATION = ("correlation", "regression", "polynomial", "equation", "r²", "coefficient of determination")
FIT = ("r 2", "r2", "r²", "adjusted", "std. error", "standard error")
CHECKS = ((("t (", "°c", "temperature"), "temperature_c"), (("m (%", "moisture", "w.b.", "wet basis"), "moisture_content_pct"), (("mhz", "ghz", "frequency"), "frequency_mhz"))


def contains_any(text: Column, words) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def _bind(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def grid_from_cells(cells: DataFrame) -> DataFrame:
    """(table_id, headers, rows) from cells with spans: a later cell overwrites, the leading header rows are the headers."""
    c = cells.select("table_id", "cell_idx", F.trim(F.coalesce("text", F.lit(""))).alias("text"), "column_header", F.greatest("r0", F.lit(0)).alias("r0"), F.col("r1"), F.greatest("c0", F.lit(0)).alias("c0"), F.col("c1")).where("r1 > r0 and c1 > c0")
    c = c.withColumn("r", F.explode(F.sequence(F.col("r0"), F.col("r1") - 1))).withColumn("c", F.explode(F.sequence(F.col("c0"), F.col("c1") - 1)))
    size = cells.groupBy("table_id").agg(F.max("r1").alias("n_rows"), F.max("c1").alias("n_cols"))
    spot = c.groupBy("table_id", "r", "c").agg(F.max_by("text", "cell_idx").alias("text"), F.max(F.coalesce("column_header", F.lit(False))).alias("head"))
    line = spot.groupBy("table_id", "r").agg(F.map_from_entries(F.collect_list(F.struct("c", "text"))).alias("cells"), F.max("head").alias("head"))
    full = size.where("n_rows > 0 and n_cols > 0").withColumn("r", F.explode(F.sequence(F.lit(0), F.col("n_rows") - 1))).join(line, ["table_id", "r"], "left")
    full = full.select("table_id", "r", F.coalesce("head", F.lit(False)).alias("head"), F.transform(F.sequence(F.lit(0), F.col("n_cols") - 1), lambda k: F.coalesce(F.try_element_at("cells", k), F.lit(""))).alias("row"))
    lead = F.min("head").over(Window.partitionBy("table_id").orderBy("r"))
    full = full.withColumn("lead", lead)
    pick = lambda keep: F.transform(F.array_sort(F.collect_list(F.when(keep, F.struct("r", "row")))), lambda x: x["row"])
    return full.groupBy("table_id").agg(pick(F.col("lead")).alias("headers"), pick(~F.col("lead")).alias("rows"))


def labels(headers: str = "headers") -> Column:
    h = F.col(headers)
    width = F.coalesce(F.array_max(F.transform(h, F.size)), F.lit(0))
    part = lambda k: F.array_distinct(F.filter(F.transform(h, lambda r: F.trim(F.coalesce(F.get(r, k), F.lit("")))), lambda x: x != ""))
    raw = F.when(width > 0, F.transform(F.sequence(F.lit(0), width - 1), lambda k: F.when(F.size(part(k)) > 0, F.array_join(part(k), " / ")).otherwise(F.concat(F.lit("col"), (k + 1).cast("string"))))).otherwise(F.array().cast("array<string>"))
    return _bind(raw, lambda a: F.transform(a, lambda x, k: F.when(F.size(F.filter(a, lambda y: y == x)) > 1, F.concat(x, F.lit(" [col "), (k + 1).cast("string"), F.lit("]"))).otherwise(x)))


def column_labels(tables: DataFrame) -> DataFrame:
    """(table_id, labels): one unique label per column from all its header cells."""
    return tables.select("table_id", labels().alias("labels"))


def _texts(tables: DataFrame) -> DataFrame:
    flat = lambda a: F.coalesce(F.array_join(F.flatten(a), " "), F.lit(""))
    return tables.withColumns({"_head": F.lower(flat(F.col("headers"))), "_cap": F.lower(F.coalesce("caption", F.lit(""))), "_sample": F.lower(flat(F.slice("rows", 1, 12))), "_five": F.lower(flat(F.slice("rows", 1, 5)))})


def is_equation() -> Column:
    """Words of regression, a coefficient matrix, or a printed equation (the patterns are fixed values)."""
    text = F.concat_ws(" ", "_cap", "_head")
    tokens = F.array_distinct(F.transform(F.flatten("headers"), lambda x: F.lower(F.trim(x))))
    matrix = (F.size(F.array_intersect(tokens, F.array(*[F.lit(x) for x in "abcdef"]))) >= 2) & F.concat_ws(" ", "_head", "_sample").rlike(r"eps|ε|e\s*[r0'′″]") & contains_any(F.col("_head"), FIT)
    explicit = F.col("_sample").rlike(r"(?:eps|ε|e\s*[r0'′″]).{0,20}(?:=|¼).{0,160}(?:[tmf]\s*(?:[²2-9]|\b)|×\s*10|\x02\s*10)")
    syntax = F.col("_sample").rlike(r"[−\-+]\s*[\d.]+\s*t|t[²2]|×\s*10|[×x]\s*10[−⁻]")
    return contains_any(text, EQUATION) | matrix | explicit | syntax


def classify_equation_tables(tables: DataFrame) -> DataFrame:
    """(table_id, is_equation): regression models rather than measurements."""
    return _texts(tables).select("table_id", is_equation().alias("is_equation"))


def _numbers(cell: Column) -> Column:
    return F.regexp_extract_all(cell, F.lit(r"([\d]+\.?\d*)"))


def classify_tables(tables: DataFrame, papers: DataFrame) -> DataFrame:
    """(table_id, decision, reason): whether a table holds dielectric data, by the first rule that speaks."""
    t = _texts(tables).join(papers.groupBy("paper_uid").agg(F.min(F.struct("data_tables", "skip_tables")).alias("_p")).select("paper_uid", F.col("_p.data_tables").alias("_data"), F.col("_p.skip_tables").alias("_skip")), "paper_uid", "left")
    text = F.concat_ws(" ", "_cap", "_head", "_five")
    t = t.withColumn("_all", text)
    all_ = F.col("_all")
    dielectric, penetration = contains_any(all_, DIELECTRIC), contains_any(all_, PENETRATION)
    head0 = F.coalesce(F.get("headers", F.lit(0)), F.array().cast("array<string>"))
    many = F.size(F.filter(head0, lambda h: h.rlike(r"(?i)\d+\s*(?:MHz|GHz)"))) >= 3
    values = F.transform(F.slice("rows", 1, 10), lambda r: F.filter(F.transform(F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))), lambda c: F.get(_numbers(c), F.lit(0)).try_cast("double")), lambda x: x.isNotNull()))
    checked = F.filter(values, lambda v: F.size(v) >= 3)
    falls = lambda v: F.forall(F.transform(v, lambda x, k: F.coalesce(x >= F.get(v, k + 1) * 0.9, F.lit(True))), lambda b: b) & (F.array_max(v) < 200) & (F.get(v, F.lit(0)) > F.element_at(v, -1) * 2)
    dropping = (F.size(checked) >= 3) & (F.size(F.filter(checked, falls)) / F.size(checked) > 0.7)
    norm = lambda c: F.regexp_replace(F.lower(c), " ", "_")
    me = norm(F.col("table_id"))
    listed = lambda c: F.coalesce(F.exists(c, lambda x: (norm(x) == me) | (F.regexp_replace(norm(x), "table_", "table") == me)), F.lit(False))
    paired = (F.size("rows") >= 3) & F.exists(F.slice("rows", 1, 5), lambda r: F.exists(F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))), lambda c: (F.size(_numbers(c)) >= 4) | ((F.size(_numbers(c)) >= 2) & c.contains("±"))))
    rules = [
        (penetration & ~dielectric, False, "penetration depth"),
        (all_.rlike(r"\(mm\)|\(cm\)|in mm|in cm") & ~dielectric, False, "length units"),
        (~dielectric & (F.size("rows") >= 3) & many & dropping, False, "values fall with frequency"),
        (is_equation(), True, "equation table"),
        (listed("_data"), True, "screened as data"),
        (listed("_skip") & dielectric, True, "screened out, but dielectric"),
        (listed("_skip"), False, "screened out"),
        (contains_any(all_, SKIP) & ~contains_any(all_, NARROW), False, "skip word"),
        (contains_any(all_, EXPLICIT), True, "dielectric word"),
        (paired, True, "paired numbers"),
    ]
    answer = F.struct(F.lit(False).alias("decision"), F.lit("no sign of data").alias("reason"))
    for test, yes, why in reversed(rules):
        answer = F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(yes).alias("decision"), F.lit(why).alias("reason"))).otherwise(answer)
    return t.select("table_id", answer.alias("a")).select("table_id", "a.decision", "a.reason")


def group_sizes(values: Column) -> Column:
    """Sizes of the runs that a change of the value that isn't blank begins; blanks belong to the run before."""
    start = F.struct(F.array().cast("array<int>").alias("done"), F.lit(0).alias("n"), F.lit(None).cast("string").alias("v"))

    def step(a, x):
        new = (x != "") & a["v"].isNotNull() & (x != a["v"]) & (a["n"] > 0)
        return F.struct(F.when(new, F.concat(a["done"], F.array(a["n"]))).otherwise(a["done"]).alias("done"), F.when(new, 1).otherwise(a["n"] + 1).alias("n"), F.when(x != "", x).otherwise(a["v"]).alias("v"))

    return F.aggregate(values, start, step, lambda a: F.when(a["n"] > 0, F.concat(a["done"], F.array(a["n"]))).otherwise(a["done"]))


def chunk_sizes(max_rows: int) -> Column:
    rows = F.col("rows")
    column = lambda k: F.transform(rows, lambda r: F.trim(F.coalesce(F.get(r, k), F.lit(""))))
    first = group_sizes(column(F.lit(0)))
    width = F.size(F.get(rows, F.lit(0)))
    other = F.filter(F.transform(F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0))), lambda k: group_sizes(column(k))), lambda g: (F.size(g) >= 2) & (F.array_max(g) <= max_rows))
    best = F.aggregate(other, F.array().cast("array<int>"), lambda a, g: F.when(F.size(g) > F.size(a), g).otherwise(a))
    groups = _bind(first, lambda g: F.when(F.size(g) > 1, g).otherwise(_bind(best, lambda b: F.when(F.size(b) > 0, b).otherwise(g))))
    start = F.struct(F.array().cast("array<int>").alias("done"), F.lit(0).alias("n"))
    pack = F.aggregate(groups, start, lambda a, g: F.when((a["n"] + g > max_rows) & (a["n"] > 0), F.struct(F.concat(a["done"], F.array(a["n"])).alias("done"), g.alias("n"))).otherwise(F.struct(a["done"].alias("done"), (a["n"] + g).alias("n"))), lambda a: F.when(a["n"] > 0, F.concat(a["done"], F.array(a["n"]))).otherwise(a["done"]))
    split = F.flatten(F.transform(pack, lambda n: F.transform(F.sequence(F.lit(0), n - 1, F.lit(max_rows)), lambda k: F.least(F.lit(max_rows), n - k))))
    return F.when(F.size(rows) <= 0, F.array().cast("array<int>")).when(F.size(rows) <= max_rows, F.array(F.size(rows))).otherwise(split)


def chunk_tables(tables: DataFrame, max_rows: int = 12) -> DataFrame:
    """(table_id, chunk_no, rows): whole condition groups packed up to max_rows rows, larger groups split."""
    t = tables.withColumn("_sizes", chunk_sizes(max_rows))
    ends = F.transform("_sizes", lambda n, k: F.struct(F.aggregate(F.slice("_sizes", 1, k), F.lit(0), lambda a, x: a + x).alias("at"), n.alias("n")))
    return t.select("table_id", "rows", F.posexplode(ends).alias("chunk_no", "c")).select("table_id", "chunk_no", F.expr("slice(rows, c.at + 1, c.n)").alias("rows"))


def header_damage(tables: DataFrame, records: DataFrame) -> DataFrame:
    """(table_id, gaps, missing): header rows with holes, and conditions the header names but most of the table's records lack."""
    gaps = F.coalesce(F.exists("headers", lambda r: (F.size(r) >= 4) & (F.size(F.filter(r, lambda c: F.trim(F.coalesce(c, F.lit(""))) == "")) >= 2)), F.lit(False))
    n = records.groupBy("table_id").agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"no_{c}") for _, c in CHECKS])
    t = _texts(tables).join(n, "table_id", "left")
    text = F.concat_ws(" ", "_cap", "_head")
    missing = F.lit(False)
    for words, c in CHECKS:
        missing = missing | (contains_any(text, words) & F.coalesce(F.col(f"no_{c}") / F.col("n") > 0.5, F.lit(False)))
    return t.select("table_id", gaps.alias("gaps"), missing.alias("missing"))
