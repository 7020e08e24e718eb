"""Reported regression models evaluated into records.

A model is one row with its terms as an array (coef, powers), so polynomials are evaluated by built-in expressions
without moving a point. A written formula is compiled once, by a helper over the distinct ones, to the steps of a stack machine that is a fold over them."""

from __future__ import annotations

import ast

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corundum.functions.lineage import cut
from corundum.functions.scalars import barrier, blank, col, filled, ism_normalize, normalize_paper_path, plausible, rounded

#: Names of the five variables and unit suffixes they may carry (fixed values).
ALIASES = {
    "T": ("t", "temp", "temperature", "temperature_c", "temperature_deg_c", "temp_c", "theta"),
    "M": ("m", "mc", "moisture", "moisture_content", "moisture_pct", "moisture_content_pct", "w", "x", "moisture_wb", "moisture_db"),
    "RHO": ("rho", "density", "bulk_density", "d"),
    "F": ("f", "freq", "frequency", "frequency_mhz"),
    "S": ("s", "salt", "salt_content", "nacl"),
}
SUFFIXES = {
    "T": ("c", "deg_c", "degc", "celsius", "k", "kelvin"),
    "M": ("pct", "percent", "percentage", "fraction", "wb", "wet_basis", "db", "dry_basis"),
    "RHO": ("kg_m3", "kg_m_3", "kgm3", "g_cm3", "g_cm_3", "gcm3"),
    "F": ("hz", "khz", "mhz", "ghz"),
    "S": ("pct", "percent", "percentage", "fraction", "wt_pct"),
}
#: How free expressions may spell a variable (fixed values).
SPELLINGS = {
    "T": ("temperature_c", "temperature", "temp", "t"),
    "M": ("moisture_content_pct", "moisture_content", "moisture", "mc", "w", "m"),
    "RHO": ("bulk_density", "density", "rho"),
    "F": ("frequency_mhz", "frequency", "freq", "f"),
    "S": ("salt_content", "salt", "s"),
}
#: Grids of variables that nothing bounds, and numbers of steps between bounds (fixed values).
DEFAULT_GRID = {"T": [20.0, 30.0, 40.0, 50.0, 60.0, 70.0, 80.0, 90.0], "M": [10.0, 15.0, 20.0, 25.0, 30.0]}
STANDARD_T = [10.0, 20.0, 30.0, 40.0, 50.0, 60.0, 70.0, 80.0, 90.0]
STEPS = {"T": 8, "M": 5, "RHO": 4, "F": 0, "S": 3}
PROPERTIES = ("dielectric_constant", "loss_factor", "loss_tangent")
NO_DOUBLES = "array<double>"


def canonical_variable(c: str | Column) -> Column:
    """T, M, RHO, F or S of a variable's name, NULL for an unknown one."""
    key = F.regexp_replace(F.lower(F.trim(col(c).cast("string"))), r"[ -]", "_")
    key = F.regexp_replace(F.regexp_replace(F.regexp_replace(key, "[^a-z0-9_]", ""), "_+", "_"), "^_|_$", "")
    out = F.lit(None).cast("string")
    for sym in reversed(list(ALIASES)):
        base = F.regexp_extract(key, "^(.*)_(?:" + "|".join(sorted(SUFFIXES[sym], key=len, reverse=True)) + ")$", 1)
        out = F.when(base.isin(*ALIASES[sym]), sym).otherwise(out)
    for sym in reversed(list(ALIASES)):
        out = F.when(key.isin(*ALIASES[sym]), sym).otherwise(out)
    return out


def parse_coefficients(c: str | Column) -> Column:
    """The number in damaged print: unicode minus and superscripts, `a × 10 - b`, marks of significance, stray blanks."""
    s = F.trim(F.translate(col(c).cast("string"), "⁰¹²³⁴⁵⁶⁷⁸⁹⁻−–—  ", "0123456789----  "))
    s = F.trim(F.regexp_replace(s, r"[*†‡]+\s*[0-9]*\s*$", ""))
    s = F.trim(F.regexp_replace(s, r"\s+[a-z]$", ""))
    power = r"^([+-]?\s*[0-9]*\.?[0-9]+)\s*[×xX*]\s*10\s*([+-]?)\s*([0-9]+)$"
    part = lambda k: F.regexp_extract(s, power, k)
    scaled = F.replace(part(1), F.lit(" "), F.lit("")).try_cast("double") * F.pow(F.lit(10.0), part(3).try_cast("double") * F.when(part(2) == "-", -1.0).otherwise(1.0))
    plain = F.replace(F.regexp_replace(s, r"\s*([eE])\s*([+-]?)\s*([0-9]+)", "$1$2$3"), F.lit(" "), F.lit(""))
    return F.when(s.rlike(power), scaled).otherwise(plain.try_cast("double"))


def _entry(coef: Column, powers: Column) -> Column:
    return F.struct(coef.alias("coef"), powers.alias("powers"))


def _map(entries: Column) -> Column:
    """A map of (key, value) entries; of equal keys the last one counts."""
    keys = F.array_distinct(F.transform(entries, lambda x: x["key"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(entries, lambda x: x["key"] == k), -1)["value"].alias("value"))))


def build_models(equations: DataFrame) -> DataFrame:
    """One row per usable model: terms (coef, powers) or a cleaned expression, its variables and domain.

    Notations in order of preference: terms, subscripts, expression, coefficients; bad terms, coefficients, unknown or doubled variables reject the model."""
    e = equations.where(F.col("property").isin(*PROPERTIES))
    names = F.transform(F.array_sort(F.map_entries("variables")), lambda x: canonical_variable(x["value"]))
    e = e.withColumn("_order", F.coalesce(names, F.array().cast("array<string>")))
    e = e.where(~F.exists("_order", lambda x: x.isNull()) & (F.size(F.array_distinct("_order")) == F.size("_order")))
    e = barrier(e)
    pair = "array<struct<coef:double,powers:map<string,int>>>"
    terms = F.transform("terms", lambda t: _entry(parse_coefficients(t["coef"]), _map(F.transform(F.map_entries(t["vars"]), lambda v: F.struct(F.coalesce(canonical_variable(v["key"]), F.lit("?")).alias("key"), v["value"].alias("value"))))))
    digits = lambda k: F.regexp_extract(F.trim(k), r"^[a-zA-Zα-ωΑ-Ω_\s]*?[_\s]*([0-9]+)$", 1)
    count = lambda k: _map(F.filter(F.transform("_order", lambda v, i: F.struct(F.coalesce(v, F.lit("?")).alias("key"), F.size(F.filter(F.split(digits(k), ""), lambda d: d == (i + 1).cast("string"))).alias("value"))), lambda x: x["value"] > 0))
    inside = lambda k: (digits(k) == "0") | ((digits(k) != "") & F.forall(F.filter(F.split(digits(k), ""), lambda d: d != ""), lambda d: d.cast("int").between(1, F.size("_order"))))
    empty = F.map_from_entries(F.array().cast("array<struct<key:string,value:int>>"))
    subs = F.filter(F.transform(F.filter(F.map_entries("subscripts"), lambda x: inside(x["key"])), lambda x: _entry(parse_coefficients(x["value"]), F.when(digits(x["key"]) == "0", empty).otherwise(count(x["key"])))), lambda t: t["coef"].isNotNull())
    single = F.when(blank("variable"), "T").otherwise(canonical_variable("variable"))
    coefs = F.transform("coefficients", lambda c, i: _entry(parse_coefficients(c), F.when(i == 0, empty).otherwise(F.map_from_entries(F.array(F.struct(F.coalesce(single, F.lit("?")).alias("key"), i.alias("value")))))))
    body = F.trim(F.regexp_replace("expression", "^[^=]*=", ""))
    found = F.filter(F.array(*[F.lit(v) for v in ALIASES]), lambda v: F.regexp_like(body, F.concat(F.lit(r"\b"), v, F.lit(r"\b"))))
    used = F.when(F.size("_order") > 0, F.col("_order")).otherwise(found)
    clean = F.replace(F.replace(body, F.lit("^"), F.lit("**")), F.lit("×"), F.lit("*"))
    for sym, words in SPELLINGS.items():
        clean = F.when(F.array_contains(used, sym), F.regexp_replace(clean, r"(?i)\b(?:" + "|".join(words) + r")\b", sym)).otherwise(clean)
    some = lambda x: F.coalesce(F.size(x), F.lit(0)) > 0
    e = e.withColumns({"_t": terms.cast(pair), "_s": F.when(some("_order"), subs).cast(pair), "_c": coefs.cast(pair), "_x": F.when(~blank("expression") & some(used), clean), "_u": used, "_v": single})
    e = barrier(e)
    kind = F.when(some("terms"), "terms").when(some("_s"), "subscripts").when(F.col("_x").isNotNull(), "expression").when(some("coefficients"), "coefficients")
    e = e.withColumn("kind", kind).where("kind is not null")
    chosen = F.when(F.col("kind") == "terms", F.col("_t")).when(F.col("kind") == "subscripts", F.col("_s")).when(F.col("kind") == "coefficients", F.col("_c"))
    e = e.withColumn("terms", chosen)
    bad = F.exists("terms", lambda t: t["coef"].isNull() | F.map_contains_key(t["powers"], "?") | F.exists(F.map_values(t["powers"]), lambda p: p.isNull() | (p < 0)))
    nameless = (F.col("kind") == "coefficients") & F.col("_v").isNull()
    sound = (F.col("kind") == "expression") | ~(bad | nameless)
    e = e.where(sound)
    seen = F.array_sort(F.array_distinct(F.flatten(F.transform("terms", lambda t: F.map_keys(t["powers"])))))
    e = e.withColumn("names", F.when(F.col("kind") == "expression", F.array_distinct("_u")).when(F.col("kind") == "coefficients", F.array(F.col("_v"))).otherwise(seen))
    span = F.filter(F.transform(F.map_entries("domain"), lambda d: F.struct(canonical_variable(d["key"]).alias("key"), F.struct(F.array_min(d["value"]).alias("lo"), F.array_max(d["value"]).alias("hi")).alias("value"))), lambda x: x["key"].isNotNull() & x["value"]["lo"].isNotNull())
    return barrier(e.select(
        "paper_uid", "eq_no", F.coalesce(filled(F.trim("material_name")), F.lit("unknown")).alias("material_name"), "property", "kind", ism_normalize("frequency_mhz").alias("frequency_mhz"), "r_squared", F.coalesce("source_table", F.lit("")).alias("source_table"),
        "terms", F.when(F.col("kind") == "expression", F.col("_x")).alias("expression"), "names", F.coalesce(_map(span), F.map_from_entries(F.array().cast("array<struct<key:string,value:struct<lo:double,hi:double>>>"))).alias("domain"),
    ))


def model_terms(models: DataFrame) -> DataFrame:
    """(paper_uid, eq_no, coef, powers): one row per additive term."""
    return models.select("paper_uid", "eq_no", F.explode("terms").alias("t")).select("paper_uid", "eq_no", "t.coef", "t.powers")


def paper_grids(papers: DataFrame) -> DataFrame:
    """Reported ranges and levels of each paper, as the axes of its models use them."""
    t, m = F.col("temperature_range_c"), F.col("moisture_range_pct")
    both = lambda r: r["lo"].isNotNull() & r["hi"].isNotNull()
    standard = F.array(*[F.lit(x) for x in STANDARD_T])
    lo, hi = F.least(t["lo"], t["hi"]), F.greatest(t["lo"], t["hi"])
    levels = F.when(both(t), F.array_sort(F.array_distinct(F.concat(F.array(lo, hi), F.filter(standard, lambda x: x.between(lo, hi)))))).otherwise(standard)
    some = lambda c: F.when(F.size(c) > 0, F.col(c))
    return papers.select(
        "paper_uid", F.when(both(t), F.struct(lo.alias("lo"), hi.alias("hi"))).alias("range_T"), levels.alias("levels_T"), F.when(both(m), m).alias("range_M"), some("moisture_levels_pct").alias("levels_M"),
        F.transform(some("measurement_frequencies_mhz"), ism_normalize).alias("levels_F"), "moisture_basis",
    ).groupBy("paper_uid").agg(F.min(F.struct("range_T", "levels_T", "range_M", "levels_M", "levels_F", "moisture_basis")).alias("g")).select("paper_uid", "g.*")


def _axis(sym: str) -> Column:
    """Values of one variable: reported levels inside the usable span, else evenly spaced, else the default; NULL where there is no grid."""
    own = F.try_element_at("domain", F.lit(sym))
    unit = F.lit(1.0)
    given = F.col(f"range_{sym}") if sym in "TM" else F.lit(None).cast("struct<lo:double,hi:double>")
    levels = F.col(f"levels_{sym}") if sym in "TMF" else F.lit(None).cast(NO_DOUBLES)
    if sym == "M":
        scale = lambda top: F.when((own["hi"] <= 1.0) & (top > 1.0), 100.0).otherwise(unit)
    elif sym == "F":
        scale = lambda top: F.when((own["hi"] < 100.0) & (top >= 1000.0), 1000.0).otherwise(unit)
    else:
        scale = lambda top: unit
    g = F.when(given.isNotNull(), F.struct((given["lo"] / scale(given["hi"])).alias("lo"), (given["hi"] / scale(given["hi"])).alias("hi")))
    lo, hi = F.greatest(own["lo"], g["lo"]), F.least(own["hi"], g["hi"])
    eps = 1e-9
    at = F.transform(levels, lambda x: x / scale(F.array_max(levels)))
    inside = F.filter(at, lambda x: F.coalesce((x >= lo - eps) & (x <= hi + eps), F.lit(True)))
    n = STEPS.get(sym, 5)
    spaced = F.when((hi <= lo) | F.lit(n <= 1), F.array(rounded(lo, 4))).otherwise(F.transform(F.sequence(F.lit(0), F.lit(max(n, 2) - 1)), lambda i: rounded(lo + i * (hi - lo) / float(max(n, 2) - 1), 4)))
    default = F.array(*[F.lit(x) for x in DEFAULT_GRID[sym]]) if sym in DEFAULT_GRID else F.lit(None).cast(NO_DOUBLES)
    values = F.when(F.size(levels) > 0, F.when(F.size(inside) > 0, F.array_sort(F.array_distinct(F.transform(inside, lambda x: rounded(x, 4)))))).when(lo.isNotNull(), spaced).otherwise(default)
    return F.when(~F.array_contains("names", sym), F.array(F.lit(None).cast("double"))).otherwise(F.when(F.coalesce(lo <= hi + eps, F.lit(True)), values))


def expand_grid(models: DataFrame, papers: DataFrame) -> DataFrame:
    """The models with one row per grid point: columns T, M, RHO, F, S (NULL for variables a model doesn't have); models without a grid are left out."""
    d = models.join(paper_grids(papers), "paper_uid", "left").where(F.size("names") > 0)
    for sym in ALIASES:
        d = d.withColumn(sym, F.explode(_axis(sym)))
    return d


#: What a compiled formula may hold: a number, the variables, operations on the top of the stack, and on the two values on top of it.
VARIABLES, ON_ONE, ON_TWO = ("T", "M", "RHO", "F", "S"), ("neg", "exp", "log", "log10", "sqrt", "abs"), ("+", "-", "*", "/", "**")
STEPS_OF = {name: k for k, name in enumerate(("number", *VARIABLES, *ON_ONE, *ON_TWO))}


def compile_formula(text: str | None) -> list[tuple[int, float]] | None:
    """A written formula as steps (op, x) of a stack machine, in postfix order; None where it holds anything but arithmetic on the variables."""
    two = {ast.Add: "+", ast.Sub: "-", ast.Mult: "*", ast.Div: "/", ast.Pow: "**"}
    out: list[tuple[int, float]] = []

    def emit(name: str, x: float = 0.0) -> None:
        out.append((STEPS_OF[name], x))

    def walk(node: ast.AST) -> None:
        if isinstance(node, ast.Constant) and type(node.value) in (int, float):
            emit("number", float(node.value))
        elif isinstance(node, ast.Name) and node.id in VARIABLES:
            emit(node.id)
        elif isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.USub, ast.UAdd)):
            walk(node.operand)
            if isinstance(node.op, ast.USub):
                emit("neg")
        elif isinstance(node, ast.BinOp) and type(node.op) in two:
            walk(node.left)
            walk(node.right)
            emit(two[type(node.op)])
        elif isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and not node.keywords:
            for a in node.args:
                walk(a)
            name, n = node.func.id, len(node.args)
            if n == 1 and name in ON_ONE[1:]:
                emit(name)
            elif (n, name) == (2, "pow"):
                emit("**")
            elif (n, name) == (2, "log"):  # of a base: the logarithms' ratio
                base = out[-1:] if out[-1][0] == 0 else None
                if base is None:
                    raise ValueError("the base must be a number")
                out.pop()
                emit("log")
                out.extend(base)
                emit("log")
                emit("/")
            else:
                raise ValueError(f"{name} of {n}")
        else:
            raise ValueError("not arithmetic")

    try:
        walk(ast.parse(text.strip(), mode="eval").body)
    except (ValueError, SyntaxError, TypeError, RecursionError, MemoryError, OverflowError, AttributeError):
        return None
    return out


def compiled(models: DataFrame) -> DataFrame:
    """The models with the `code` of their expression; each distinct formula is compiled once."""
    steps = F.pandas_udf(lambda texts: texts.map(lambda t: None if (code := compile_formula(t)) is None else [{"op": op, "x": x} for op, x in code]), "array<struct<op:int,x:double>>")
    formulas = models.where("expression is not null").select("expression").distinct()
    return models.join(formulas.withColumn("code", steps("expression")), "expression", "left").select(*models.columns, "code")


def run_formula(code: Column, at: dict[str, Column]) -> Column:
    """Value of a compiled formula: a fold over its steps with a stack of numbers. NULL where any step has no finite real value."""
    stack = F.array().cast(NO_DOUBLES)

    def step(s: Column, t: Column) -> Column:
        op, top, below = t["op"], F.try_element_at(s, F.lit(-1)), F.try_element_at(s, F.lit(-2))
        first_one, first_two = STEPS_OF[ON_ONE[0]], STEPS_OF[ON_TWO[0]]
        values = {"+": below + top, "-": below - top, "*": below * top, "/": F.try_divide(below, top), "**": F.pow(below, top)}
        values |= {v: at[v] for v in VARIABLES}
        values |= {"neg": -top, "exp": F.exp(top), "log": F.log(top), "log10": F.log10(top), "sqrt": F.sqrt(top), "abs": F.abs(top)}
        value = F.when(op == 0, t["x"])
        for name in ("*", "M", "T", "+", *(v for v in values if v not in "*MT+")):
            value = value.when(op == STEPS_OF[name], values[name])
        left = F.when(op < first_one, s).when(op < first_two, F.slice(s, F.lit(1), F.size(s) - 1)).otherwise(F.slice(s, F.lit(1), F.size(s) - 2))
        # An infinite or missing value is none from here on, as it would be an error where formulas are run one by one.
        return F.concat(left, F.array(F.when(F.abs(value) < float("inf"), value)))

    return F.aggregate(code, stack, step, lambda s: F.try_element_at(s, F.lit(-1)))


def polynomial(terms: Column, at: dict[str, Column]) -> Column:
    """Sum of coef times the product of variable powers."""
    binding = F.create_map(*[x for k, v in at.items() for x in (F.lit(k), v)])
    product = lambda powers: F.aggregate(F.map_entries(powers), F.lit(1.0), lambda p, e: p * F.pow(F.element_at(binding, e["key"]), e["value"]))
    return F.aggregate(terms, F.lit(0.0), lambda a, t: a + t["coef"] * product(t["powers"]))


def _groups(models: DataFrame, papers: DataFrame) -> DataFrame:
    """Models of one material and frequency side by side: dc, lf, lt, and the driver whose grid all share."""
    # Of rows that repeat a paper, the least value, here and in the grids.
    freqs = papers.select("paper_uid", F.transform(F.when(F.size("measurement_frequencies_mhz") > 0, F.col("measurement_frequencies_mhz")), ism_normalize).alias("_f")).groupBy("paper_uid").agg(F.min("_f").alias("_f"))
    whole = models.groupBy("paper_uid").agg((F.count("frequency_mhz") == 0).alias("_free"), F.max(F.array_contains("names", "F")).alias("_usesF"))
    m = models.join(whole, "paper_uid").join(freqs, "paper_uid", "left")
    spread = F.when(F.col("_free") & ~F.col("_usesF") & F.col("_f").isNotNull(), F.col("_f")).otherwise(F.array("frequency_mhz"))
    m = m.withColumn("frequency_mhz", F.explode(spread))
    one = F.struct(*[c for c in ("eq_no", "property", "source_table", "terms", "expression", "code", "names", "domain", "r_squared") if c in models.columns])
    g = m.groupBy("paper_uid", "material_name", "frequency_mhz", "_f").agg(F.collect_list(one).alias("ms"))
    g = g.withColumn("ms", F.array_sort("ms", lambda a, b: F.when(a["eq_no"] < b["eq_no"], -1).when(a["eq_no"] > b["eq_no"], 1).otherwise(0)))
    doubled = F.size("ms") > F.size(F.array_distinct(F.transform("ms", lambda x: x["property"])))
    split = F.transform(F.array_distinct(F.transform("ms", lambda x: x["source_table"])), lambda s: F.filter("ms", lambda x: x["source_table"] == s))
    g = g.withColumn("ms", F.explode(F.when(doubled, split).otherwise(F.array("ms"))))
    last = lambda p: F.try_element_at(F.filter("ms", lambda x: x["property"] == p), F.lit(-1))
    g = g.withColumns({"dc": last("dielectric_constant"), "lf": last("loss_factor"), "lt": last("loss_tangent")})
    g = g.withColumn("src", F.array_join(F.array_sort(F.array_distinct(F.filter(F.transform("ms", lambda x: x["source_table"]), lambda x: x != ""))), "; "))
    return g.withColumn("driver", F.coalesce("dc", "lf", "lt"))


def _with_values(points: DataFrame, scales: dict[str, Column | float]) -> DataFrame:
    """The points with `<name>_dc`, `<name>_lf` and `<name>_lt`, the values of their models with moisture times the scale of that name."""
    names = [f"{n}_{c}" for n in scales for c in ("dc", "lf", "lt")]
    cases = [F.struct(F.col(f"{c}.terms").alias("terms"), F.col(f"{c}.code").alias("code"), (F.col("M") * x).alias("M")) for x in scales.values() for c in ("dc", "lf", "lt")]
    at = lambda x: {v: x["M"] if v == "M" else F.col(v) for v in ALIASES}
    value = lambda x: F.when(x["code"].isNotNull(), run_formula(x["code"], at(x))).when(x["terms"].isNotNull(), polynomial(x["terms"], at(x)))
    points = barrier(points.withColumn("_at", F.transform(F.array(*cases), lambda x: F.nanvl(value(x), F.lit(None).cast("double")))))
    return points.withColumns({n: F.get("_at", F.lit(k)) for k, n in enumerate(names)}).drop("_at")


def _moisture_parts(groups: DataFrame, papers: DataFrame) -> DataFrame:
    """(gid, part) of the groups in which moisture is a fraction: nothing bounds it, no value is plausible with it as it is, and two are as a fraction.

    Only groups without bounds are evaluated, and only counts by group are shuffled."""
    open_ = F.array_contains("names", "M") & F.try_element_at("domain", F.lit("M")).isNull()
    pts = _with_values(barrier(expand_grid(groups.where(open_), papers)), {"pct": 1.0, "part": 0.01})
    fine = lambda k: sum((plausible(F.lit(p), f"{k}_{c}", "frequency_mhz").cast("int") for c, p in zip(("dc", "lf", "lt"), PROPERTIES, strict=True)), F.lit(0))
    n = pts.groupBy("gid").agg(F.sum(fine("pct")).alias("as_pct"), F.sum(fine("part")).alias("as_part"), F.max("M").alias("above"))
    return n.where("above > 1 and as_pct = 0 and as_part >= 2").select("gid", F.lit(True).alias("part"))


def evaluate_points(models: DataFrame, papers: DataFrame) -> DataFrame:
    """Every grid point of every group with its values before rounding, and what happened to it (state: domain, dropped, kept)."""
    g = _groups(compiled(models), papers).withColumns({"names": F.col("driver.names"), "domain": F.col("driver.domain"), "gid": F.xxhash64("paper_uid", "material_name", "frequency_mhz", "src")})
    # A group is a short row but a few hundred points to evaluate, so groups are dealt to all tasks and not by their size.
    n = int(g.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    g = cut(g).repartition(n, "gid")
    parts = _moisture_parts(g, papers)
    g = g.join(parts, "gid", "left").repartition(n, "gid").withColumn("part", F.coalesce("part", F.lit(False)))
    pts = barrier(_with_values(barrier(expand_grid(g, papers)), {"v": F.when(F.col("part"), 0.01).otherwise(1.0)}))
    out = F.lit(False)
    for sym in ALIASES:
        d, x = F.try_element_at("domain", F.lit(sym)), F.col(sym) * (F.when(F.col("part"), 0.01).otherwise(1.0) if sym == "M" else 1.0)
        out = out | F.coalesce((x < d["lo"] - 1e-9) | (x > d["hi"] + 1e-9), F.lit(False))
    ghz = (F.try_element_at("domain", F.lit("F"))["hi"] < 100) & (F.array_max("_f") >= 1000)
    mhz = F.coalesce("frequency_mhz", F.col("F") * F.when(F.coalesce(ghz, F.lit(False)), 1000.0).otherwise(1.0))
    pts = pts.withColumns({"outside": out, "mhz": mhz})
    pts = barrier(pts)
    ok = {c: plausible(F.lit(p), f"v_{c}", "mhz") for c, p in zip(("dc", "lf", "lt"), PROPERTIES, strict=True)}
    bad = (F.col("v_dc").isNotNull() & ~ok["dc"]).cast("int") + (F.col("v_lf").isNotNull() & ~ok["lf"]).cast("int")
    pts = pts.withColumns({"implausible": F.when(F.col("outside"), 0).otherwise(bad)} | {"k_" + c: F.when(ok[c], F.col("v_" + c)) for c in ok})
    kept = F.col("k_dc").isNotNull() | F.col("k_lf").isNotNull()
    return pts.withColumn("state", F.when(F.col("outside"), "domain").when(kept, "kept").otherwise("dropped"))


def _as_text(model: Column) -> Column:
    """A model as `property: terms` or `property: expression`."""
    powers = lambda t: F.array_join(F.transform(F.array_sort(F.map_entries(t["powers"])), lambda e: F.concat(e["key"], F.lit("^"), e["value"].cast("string"))), "*")
    terms = F.array_join(F.transform(model["terms"], lambda t: F.concat_ws("*", t["coef"].cast("string"), powers(t))), " + ")
    return F.concat(model["property"], F.lit(": "), F.coalesce(model["expression"], terms))


def evaluate_models(models: DataFrame, papers: DataFrame, extraction_model: str | None = None) -> DataFrame:
    """Records of all plausible grid points, with doi and paper_id of their paper and the model that read the equations."""
    p = evaluate_points(cut(models), papers).where("state = 'kept'")
    name = normalize_paper_path("pdf_path") if "pdf_path" in papers.columns else F.lit("")
    doi = F.coalesce("doi", F.lit("")) if "doi" in papers.columns else F.lit("")
    facts = papers.select("paper_uid", F.struct(doi.alias("doi"), name.alias("paper_id")).alias("_p")).groupBy("paper_uid").agg(F.min("_p").alias("_p"))
    p = p.join(facts, "paper_uid", "left")
    percent = F.when(F.try_element_at("domain", F.lit("M"))["hi"] <= 1.0, F.col("M") * 100).otherwise(F.col("M"))
    return p.select(
        "paper_uid",
        F.col("_p.doi").alias("doi"),
        F.col("_p.paper_id").alias("paper_id"),
        "material_name",
        F.col("mhz").alias("frequency_mhz"),
        F.col("T").alias("temperature_c"),
        rounded("k_dc", 3).alias("dielectric_constant"),
        rounded("k_lf", 3).alias("loss_factor"),
        rounded("k_lt", 4).alias("loss_tangent"),
        percent.alias("moisture_content_pct"),
        F.when(F.col("M").isNotNull(), F.col("moisture_basis")).alias("moisture_basis"),
        F.col("S").cast("string").alias("salt_content"),
        F.when(F.col("src") != "", F.concat("src", F.lit(" (regression)"))).otherwise("regression").alias("source_table"),
        F.lit("equation").alias("extraction_source"),
        F.lit(extraction_model).cast("string").alias("extraction_model"),
        F.lit("equation_derived").alias("data_provenance"),
        F.substring(F.array_join(F.transform("ms", _as_text), "; "), 1, 500).alias("model_expression"),
        F.get(F.filter(F.transform("ms", lambda x: x["r_squared"]), lambda x: x.isNotNull()), F.lit(0)).alias("model_r_squared"),
    )


def groups_without_grid(models: DataFrame, papers: DataFrame) -> DataFrame:
    """(paper_uid, material_name, frequency_mhz, src, reason) of the groups of models for which no grid can be made, and why."""
    g = _groups(models, papers).withColumns({"names": F.col("driver.names"), "domain": F.col("driver.domain")})
    g = barrier(g).join(paper_grids(papers), "paper_uid", "left")
    axes = [F.when(F.array_contains("names", s) & (F.coalesce(F.size(_axis(s)), F.lit(0)) <= 0), F.lit(s)) for s in ALIASES]
    without = F.array_compact(F.array(*axes))
    g = g.withColumn("_axes", without)
    reason = F.when(F.coalesce(F.size("names"), F.lit(0)) <= 0, F.lit("the model has no variables")).when(F.size("_axes") > 0, F.concat(F.lit("no values of "), F.array_join("_axes", ", ")))
    return g.select("paper_uid", "material_name", "frequency_mhz", "src", reason.alias("reason")).where("reason is not null")


def equation_report(equations: DataFrame, models: DataFrame, papers: DataFrame) -> DataFrame:
    """Per paper: equations, models built and not parsed, points evaluated, outside the domain, implausible values, points kept,
    and how many groups of models had no grid, with the reasons."""
    models = cut(models)
    e = equations.groupBy("paper_uid").agg(F.count("*").alias("equations"))
    m = models.groupBy("paper_uid").agg(F.count("*").alias("models_built"))
    p = evaluate_points(models, papers).groupBy("paper_uid").agg(
        F.count("*").alias("points_evaluated"),
        F.count_if(F.col("state") == "domain").alias("points_out_of_domain"),
        F.sum("implausible").alias("values_implausible"),
        F.count_if(F.col("state") == "kept").alias("points_kept"),
    )
    n = groups_without_grid(models, papers).groupBy("paper_uid").agg(F.count("*").alias("groups_without_grid"), F.array_join(F.array_sort(F.collect_set("reason")), "; ").alias("no_grid_reason"))
    j = e.join(m, "paper_uid", "left").join(p, "paper_uid", "left").join(n, "paper_uid", "left").na.fill(0).na.fill("", ["no_grid_reason"])
    unparsed = (F.col("equations") - F.col("models_built")).alias("models_unparsed")
    return j.select("paper_uid", "models_built", unparsed, "points_evaluated", "points_out_of_domain", "values_implausible", "points_kept", "groups_without_grid", "no_grid_reason")
