"""From extraction artifacts to one validated, deduplicated measurement table."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corundum.functions.lineage import by_parts, cut
from corundum.functions.scalars import blank, filled, moisture_basis_norm, normalize_paper_path, paper_identity, rounded
from corundum.schema import COLUMNS, OUTPUT

METADATA = ["title", "authors", "year", "journal", "measurement_method"]
#: Priority of a row's source, smaller first (fixed values).
PROVENANCE = {"measured_table": 0, "vision_table": 1, "measured_text": 2, "equation_derived": 3}
SOURCE = {"table": 0, "text": 2, "equation": 3}
#: Physical bounds (fixed values).
BOUNDS = {
    "frequency_mhz": (1.0, 100000.0),
    "temperature_c": (-80.0, 200.0),
    "moisture_content_pct": (0.0, 100.0),
    "dielectric_constant": (1.0, 200.0),
    "loss_factor": (0.001, 200.0),
    "rf_dielectric_constant": (1.0, 300.0),
    "rf_loss_factor": (0.001, 5000.0),
    "radio_up_to_mhz": 100.0,
    "loss_tangent": 10.0,
}


def with_paper_key(df: DataFrame) -> DataFrame:
    """The rows with paper_key, the identity of their source."""
    return df.withColumn("paper_key", paper_identity())


def unique_only(papers: DataFrame, key: Column, *values: str) -> DataFrame:
    """(key, values...) of the keys that exactly one paper has."""
    return papers.select(key.alias("key"), *values).where(~blank("key")).groupBy("key").agg(F.count("*").alias("n"), *[F.first(v).alias(v) for v in values]).where("n = 1").drop("n")


def flatten_records(artifacts: DataFrame, papers: DataFrame) -> DataFrame:
    """One row per record of every artifact, with the facts of its paper.

    The paper is found by the artifact's uid, else by that of its first record, else by a DOI that only one paper has."""
    doi = F.lower(F.trim(F.coalesce("doi", F.lit(""))))
    facts = papers.select(F.col("paper_uid").alias("p_uid"), "pdf_path", F.col("doi").alias("p_doi"), F.col("title").alias("p_title"), F.concat_ws("; ", "authors").alias("p_authors"), F.col("year").alias("p_year"), F.col("journal").alias("p_journal"), F.col("measurement_method").alias("p_method"), F.col("moisture_basis").alias("p_basis"))
    # Of papers that repeat a uid the first by path counts.
    rest = [c for c in facts.columns if c != "p_uid"]
    by_uid = facts.where(~blank("p_uid")).groupBy("p_uid").agg(F.min_by(F.struct(*rest), F.struct("pdf_path", "p_doi", "p_title", "p_authors", "p_year")).alias("f")).select("p_uid", "f.*")
    by_doi = unique_only(papers, doi, "paper_uid").select(F.col("key").alias("d_doi"), F.col("paper_uid").alias("d_uid"))
    known = by_uid.select(F.col("p_uid").alias("k_uid"))
    a = artifacts.withColumns({"a_uid": filled("paper_uid"), "r_uid": filled(F.get("records", F.lit(0))["paper_uid"]), "a_doi": doi})
    a = a.join(known, F.col("a_uid") == F.col("k_uid"), "left").withColumnRenamed("k_uid", "u1").join(known, F.col("r_uid") == F.col("k_uid"), "left").withColumnRenamed("k_uid", "u2")
    a = a.join(by_doi, F.col("a_doi") == F.col("d_doi"), "left").withColumn("u", F.coalesce("u1", "u2", "d_uid")).join(by_uid, F.col("u") == F.col("p_uid"), "left")
    a = a.select("*", F.explode("records").alias("r"))
    r = lambda c: F.col(f"r.{c}")
    source = filled(F.trim(r("source_table")))
    label = (
        F.when(source.isNotNull(), source)
        .when((r("data_provenance") == "measured_text") | (r("extraction_source") == "text"), "Narrative text")
        .when((r("data_provenance") == "equation_derived") | (r("extraction_source") == "equation"), "Regression equation")
        .when(F.size("tables_processed") == 1, F.regexp_replace(F.get("tables_processed", F.lit(0)), "table_", "Table "))
        .when((r("extraction_source") == "table") | (F.col("kind") == "table"), "Table (unspecified)")
        .otherwise("")
    )
    inherit = r("moisture_content_pct").isNotNull() & (moisture_basis_norm(r("moisture_basis")) == "unknown") & (moisture_basis_norm("p_basis") != "unknown")
    own = {
        "paper_id": normalize_paper_path(F.coalesce(filled(r("paper_id")), F.col("pdf_path"))),
        "paper_uid": F.coalesce(filled(r("paper_uid")), F.col("a_uid"), F.col("p_uid"), F.lit("")),
        "moisture_basis": F.when(inherit, F.col("p_basis")).otherwise(r("moisture_basis")),
        "source_table": label,
        "doi": F.coalesce(filled("p_doi"), F.col("doi")),
        "title": F.coalesce("p_title", F.lit("")),
        "authors": F.coalesce("p_authors", F.lit("")),
        "year": F.col("p_year"),
        "journal": F.col("p_journal"),
        "measurement_method": F.coalesce(filled(r("measurement_method")), F.col("p_method")),
    }
    return a.select(*[own.get(c, r(c)).cast(t).alias(c) for c, t in OUTPUT])


def _matches(column: str, expected) -> Column:
    if expected is None:
        return F.col(column).isNull()
    if isinstance(expected, (list, tuple, set)):
        return F.coalesce(F.col(column).isin(*expected), F.lit(False))
    return F.coalesce(F.col(column) == F.lit(expected), F.lit(False))


def apply_overrides(records: DataFrame, doi_map: dict[str, str] | None = None, rules: Iterable[dict] = ()) -> DataFrame:
    """Replace DOIs, then apply rules in order: {where: {column: value, None or list}, set: {...}} or {where, drop: True}."""
    if doi_map:
        doi = F.col("doi")
        for old, new in doi_map.items():
            doi = F.when(F.col("doi") == old, new).otherwise(doi)
        records = records.withColumn("doi", doi)
    for rule in rules:
        if not isinstance(rule, dict) or not isinstance(rule.get("where"), dict):
            raise TypeError("a rule needs a 'where' mapping")
        if unknown := (set(rule["where"]) | set(rule.get("set") or {})) - set(records.columns):
            raise ValueError(f"a rule names unknown columns: {sorted(unknown)}")
        hit = F.lit(True)
        for column, expected in rule["where"].items():
            hit = hit & _matches(column, expected)
        if rule.get("drop"):
            records = records.where(~hit)
        elif updates := rule.get("set"):
            kinds = dict(records.dtypes)
            records = records.withColumns({c: F.when(hit, F.lit(v).cast(kinds[c])).otherwise(F.col(c)) for c, v in updates.items()})
    return records


def canonical_materials(records: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Give all spellings of a material (case, white space) the most frequent one, ties to the smallest; aliases win."""
    label = F.trim(F.regexp_replace("material_name", r"\s+", " "))
    d = records.withColumn("_label", label).withColumn("_key", F.lower("_label"))
    # Counted before any row is moved; one row per key comes back.
    counts = d.where(~blank("_label")).groupBy("_key", "_label").agg(F.count("*").alias("n"))
    best = counts.groupBy("_key").agg(F.min_by("_label", F.struct(-F.col("n"), "_label")).alias("_best"))
    name = F.coalesce("_best", "_label")
    for old, new in (aliases or {}).items():
        name = F.when(F.lower(F.trim("material_name")) == old.strip().lower(), new).otherwise(name)
    return d.join(best, "_key", "left").withColumn("material_name", name).select(*records.columns)


def material_group(aliases: dict[str, str] | None = None) -> Column:
    """Equal for rows whose materials are, or may become, one: the label without case and white space; all that aliases name are one group."""
    fold = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    key = F.coalesce(fold("material_name"), F.lit(""))
    named = [key == fold(F.lit(x)) for pair in (aliases or {}).items() for x in pair]
    return F.when(reduce(Column.__or__, named), F.lit("named")).otherwise(F.concat(F.lit("label "), key)) if named else key


def resolve_metadata(records: DataFrame, papers: DataFrame) -> DataFrame:
    """Fill blank uids from a DOI or a name that only one paper has, then blank metadata by uid, then by DOI."""
    doi = F.lower(F.trim(F.coalesce("doi", F.lit(""))))
    named = papers.where(~blank("paper_uid"))
    distinct = lambda key, name: named.select(key.alias(name), "paper_uid").where(~blank(name)).groupBy(name).agg(F.min("paper_uid").alias("lo"), F.max("paper_uid").alias("hi")).where("lo = hi").select(name, F.col("lo").alias(f"u_{name}"))
    value = lambda c: F.concat_ws("; ", "authors") if c == "authors" else F.col(c)
    # Of papers that repeat a uid the first by path counts.
    facts = named.select("paper_uid", "pdf_path", F.struct(*[value(c).alias(f"u_{c}") for c in METADATA]).alias("f"))
    by_uid = facts.groupBy(F.col("paper_uid").alias("_u")).agg(F.min_by("f", F.struct("pdf_path", "f")).alias("f")).select("_u", "f.*")
    by_doi = papers.select(doi.alias("_d"), *[value(c).alias(f"d_{c}") for c in METADATA]).where(~blank("_d")).groupBy("_d").agg(F.count("*").alias("_n"), *[F.first(f"d_{c}").alias(f"d_{c}") for c in METADATA]).where("_n = 1").drop("_n")
    r = records.withColumns({"k_doi": F.lower(F.coalesce("doi", F.lit(""))), "k_name": normalize_paper_path("paper_id")})
    r = r.join(distinct(doi, "k_doi"), "k_doi", "left").join(distinct(normalize_paper_path("pdf_path"), "k_name"), "k_name", "left")
    r = r.withColumn("paper_uid", F.coalesce(filled("paper_uid"), F.col("u_k_doi"), F.col("u_k_name"), F.col("paper_uid")))
    r = r.join(by_uid, F.col("paper_uid") == F.col("_u"), "left").join(by_doi, F.col("k_doi") == F.col("_d"), "left")

    def fill(c: str) -> Column:
        own = F.when(~F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))).isin("", "None"), F.col(c))
        given = [F.col(x) if c == "year" else filled(x) for x in (f"u_{c}", f"d_{c}")]
        return F.coalesce(own, *given, F.col(c))

    return r.withColumns({c: fill(c) for c in METADATA}).select(*records.columns)


def stable_order(records: DataFrame) -> DataFrame:
    """The total order over the exported columns, NULL last."""
    return records.orderBy(*[F.col(c).asc_nulls_last() for c in COLUMNS if c in records.columns])


def _lower(c: str) -> Column:
    return F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))


def split_key() -> dict[str, Column]:
    """The condition key for merging, unknown conditions as sentinels."""
    num = lambda c, missing: F.coalesce(F.col(c), F.lit(missing))
    return {
        "k_paper": paper_identity(),
        "k_material": _lower("material_name"),
        "k_frequency": rounded(num("frequency_mhz", -999.0)),
        "k_temperature": rounded(num("temperature_c", -999.0)),
        "k_moisture": rounded(num("moisture_content_pct", -1.0)),
        "k_basis": moisture_basis_norm("moisture_basis"),
        "k_salt": _lower("salt_content"),
        "k_conductivity": rounded(num("electrical_conductivity_s_m", -1.0), 4),
    }


JOINED = ["source_table", "source_location", "model_expression", "data_provenance", "extraction_source", "extraction_model"]


def merge_pairs(records: DataFrame, key: dict[str, Column], joined: list[str] = JOINED) -> DataFrame:
    """Make one row of the only two halves of a measurement: no complete row under the key, one with only each property.

    Halves are grouped with map-side aggregation and joined back, so no group is sorted or held in one place."""
    halves = F.when(F.col("dielectric_constant").isNotNull() & F.col("loss_factor").isNotNull(), "c").when(F.col("dielectric_constant").isNotNull(), "d").when(F.col("loss_factor").isNotNull(), "l").otherwise("n")
    carried = ["loss_factor", "loss_tangent", "model_r_squared", *joined]
    d = records.withColumns(key).withColumn("_half", halves)
    groups = d.groupBy(*key).agg(
        *[F.count_if(F.col("_half") == h).alias(f"_n{h}") for h in "cdl"],
        F.max(F.when(F.col("_half") == "l", F.struct(*carried))).alias("_other"),
    ).where("_nc = 0 and _nd = 1 and _nl = 1").select(*key, "_other")
    same = F.lit(True)
    for k in key:
        same = same & d[k].eqNullSafe(groups[k])
    both = d.join(groups, same, "left").where(F.col("_other").isNull() | (F.col("_half") != "l"))
    merged = F.col("_other").isNotNull() & (F.col("_half") == "d")

    def pick(c: str) -> Column:
        other = F.col(f"_other.{c}") if c in carried else None
        if c == "loss_factor":
            return F.when(merged, other).otherwise(F.col(c))
        if c in ("loss_tangent", "model_r_squared"):
            return F.when(merged, F.coalesce(F.col(c), other)).otherwise(F.col(c))
        if c in joined:
            both_ = F.array_distinct(F.filter(F.array(F.trim(F.coalesce(F.col(c), F.lit(""))), F.trim(F.coalesce(other, F.lit("")))), lambda x: x != ""))
            return F.when(merged, F.when(F.size(both_) > 0, F.array_join(both_, "; "))).otherwise(F.col(c))
        return F.col(c)

    return both.select(*[pick(c).alias(c) for c in records.columns])


def merge_split(records: DataFrame) -> DataFrame:
    """Merge a unique complementary property pair at identical conditions."""
    return merge_pairs(records, split_key())


def loss_tangent(records: DataFrame) -> DataFrame:
    """Fill a missing loss tangent from the two properties."""
    value = rounded(F.col("loss_factor") / F.col("dielectric_constant"), 4)
    fit = F.col("loss_tangent").isNull() & (F.col("dielectric_constant") > 0) & F.col("loss_factor").isNotNull()
    return records.withColumn("loss_tangent", F.when(fit, value).otherwise(F.col("loss_tangent")))


def violations(bounds: dict = BOUNDS) -> dict[str, Column]:
    """Whether a row leaves the bounds of each property; NULL never does, an unknown frequency counts as microwave."""
    radio = F.coalesce(F.col("frequency_mhz") <= bounds["radio_up_to_mhz"], F.lit(False))

    def out(c: str) -> Column:
        low, high = bounds[c]
        wide = bounds.get(f"rf_{c}")
        beyond = ~F.col(c).between(low, high)
        if wide:
            beyond = F.when(radio, ~F.col(c).between(*wide)).otherwise(beyond)
        return F.coalesce(beyond, F.lit(False))

    found = {c: out(c) for c in ("frequency_mhz", "temperature_c", "dielectric_constant", "loss_factor", "moisture_content_pct")}
    found["loss_tangent"] = F.coalesce(~radio & (F.col("loss_tangent") > bounds["loss_tangent"]), F.lit(False))
    return found


def validate_bounds(records: DataFrame, bounds: dict = BOUNDS) -> DataFrame:
    bad = F.lit(False)
    for v in violations(bounds).values():
        bad = bad | v
    return records.where(~bad)


def bound_violations(records: DataFrame, bounds: dict = BOUNDS) -> DataFrame:
    """One row per violated bound: paper_key, material_name, field, value."""
    found = F.array(*[F.when(v, F.struct(F.lit(c).alias("field"), F.col(c).alias("value"))) for c, v in violations(bounds).items()])
    return records.select(paper_identity().alias("paper_key"), "material_name", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("v")).select("paper_key", "material_name", "v.field", "v.value")


def condition_key() -> dict[str, Column]:
    """What two rows of one measurement condition have in common."""
    return {
        "k_paper": paper_identity(),
        "k_material": _lower("material_name"),
        "k_frequency": rounded("frequency_mhz"),
        "k_temperature": rounded("temperature_c"),
        "k_moisture": rounded(F.coalesce("moisture_content_pct", F.lit(-1.0)), 1),
        "k_basis": moisture_basis_norm("moisture_basis"),
        "k_salt": _lower("salt_content"),
        "k_conductivity": rounded(F.coalesce("electrical_conductivity_s_m", F.lit(-1.0)), 4),
    }


def dedup_records(records: DataFrame) -> DataFrame:
    """Keep the best source of equal measurements, then drop incomplete rows beside complete ones and unknown-moisture rows beside known ones.

    A row without frequency or temperature is never dropped by the last two steps: NULL equals nothing there."""
    provenance, source = _lower("data_provenance"), _lower("extraction_source")
    priority = F.create_map(*[F.lit(x) for kv in PROVENANCE.items() for x in kv])[provenance]
    second = F.create_map(*[F.lit(x) for kv in SOURCE.items() for x in kv])[source]
    key = condition_key()
    exact = {"k_constant": rounded("dielectric_constant", 1), "k_loss": rounded("loss_factor", 1)}
    order = [F.coalesce(priority, second, F.lit(4)), *[F.col(c).asc_nulls_last() for c in COLUMNS if c in records.columns]]
    # All three windows lie within a hash of the coarsest key, so the rows are shuffled once, and their keys made behind the shuffle.
    rest = [k for k in key if k != "k_moisture"]
    d = records.withColumn("_hash", F.xxhash64(*[key[k] for k in rest])).repartition("_hash").withColumns(key | exact)
    by = lambda *keys: Window.partitionBy("_hash", *keys)
    d = d.withColumn("_first", F.row_number().over(by(*key, *exact).orderBy(*order)) == 1).where("_first")
    complete = F.col("dielectric_constant").isNotNull() & F.col("loss_factor").isNotNull()
    # Whether a complete row shares a row's key: a maximum over the key. No key holds a NULL that should match, since the rows with one are let through.
    loose = F.col("k_frequency").isNull() | F.col("k_temperature").isNull()
    d = d.withColumns({"_complete": complete, "_loose": loose})
    d = d.withColumn("_beside", F.max("_complete").over(by(*key))).where("_complete or _loose or not _beside")
    known = F.col("_complete") & (F.col("k_moisture") != -1.0)
    d = d.withColumn("_known", F.max(known).over(by(*rest))).where("k_moisture <> -1.0 or _loose or not _known")
    return d.select(*records.columns)


def coverage_ledger(records: DataFrame, artifacts: DataFrame, papers: DataFrame) -> DataFrame:
    """One row per paper: how many artifacts, extracted, complete and assembled records it has, and its outcome."""
    doi = F.lower(F.trim(F.coalesce("doi", F.lit(""))))
    key = F.coalesce(filled("paper_uid"), F.concat(F.lit("doi:"), doi))
    p = papers.withColumns({"_key": key, "_doi": doi}).withColumn("_nth", F.row_number().over(Window.partitionBy("_key").orderBy(F.col("pdf_path").asc_nulls_last()))).where("_nth = 1")
    complete = F.size(F.filter("records", lambda r: r["dielectric_constant"].isNotNull() & r["loss_factor"].isNotNull()))
    # The records are looked at once, and counts alone are grouped.
    flag = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    counts = cut(artifacts.select("paper_uid", doi.alias("doi"), F.size("records").alias("records"), complete.alias("n_complete"), flag("timed_out"), flag("complete")))
    sums = [F.count("*").alias("n"), F.sum("records").alias("records"), F.sum("n_complete").alias("complete"), F.max("timed_out").alias("timed_out"), F.min("complete").alias("done")]
    by_uid = counts.where(~blank("paper_uid")).groupBy(F.col("paper_uid").alias("_uid")).agg(*sums).select("_uid", F.struct("n", "records", "complete", "timed_out", "done").alias("u"))
    by_doi = counts.where(~blank("doi")).groupBy(F.col("doi").alias("_adoi")).agg(*sums).select("_adoi", F.struct("n", "records", "complete", "timed_out", "done").alias("d"))
    made = records.where(~blank("paper_uid")).groupBy(F.col("paper_uid").alias("_ruid")).agg(F.count("*").alias("assembled"))
    j = p.join(by_uid, filled("paper_uid") == F.col("_uid"), "left").join(by_doi, F.col("_doi") == F.col("_adoi"), "left").join(made, F.col("paper_uid") == F.col("_ruid"), "left")
    a = F.coalesce("u", "d")
    j = j.withColumn("a", a).withColumn("assembled", F.coalesce("assembled", F.lit(0)).cast("long"))
    outcome = (
        F.when(~F.coalesce("parse_complete", F.lit(True)), "no_parse_artifact")
        .when(F.col("a").isNull(), "no_extraction_artifact")
        .when(F.col("a.timed_out"), "extraction_timed_out")
        .when(~F.col("a.done"), "extraction_incomplete")
        .when(F.col("assembled") > 0, "contributed")
        .when(F.col("a.records") == 0, "extraction_zero_records")
        .when(F.col("a.complete") == 0, "incomplete_records_only")
        .otherwise("lost_during_assembly")
    )
    n = lambda c: F.coalesce(F.col(f"a.{c}"), F.lit(0)).cast("long")
    out = j.select("paper_uid", normalize_paper_path("pdf_path").alias("paper_id"), F.col("_doi").alias("doi"), "title", n("n").alias("extraction_artifacts"), n("records").alias("extracted_records"), n("complete").alias("complete_extracted_records"), F.col("assembled").alias("assembled_records"), outcome.alias("outcome"))
    return out.orderBy("outcome", "paper_id")


#: What may become of a paper (fixed values).
OUTCOMES = (
    "no_parse_artifact", "no_extraction_artifact", "extraction_timed_out", "extraction_incomplete", "contributed",
    "extraction_zero_records", "incomplete_records_only", "lost_during_assembly",
)


def coverage_summary(ledger: DataFrame, strict: bool = False) -> DataFrame:
    """Papers selected, contributing, without rows, incomplete, and by outcome; strict raises where any yields nothing."""
    out = ledger.agg(
        F.count("*").alias("selected_papers"),
        F.count_if(F.col("outcome") == "contributed").alias("contributing_papers"),
        F.count_if(F.col("assembled_records") == 0).alias("zero_yield_papers"),
        F.count_if(F.col("outcome").isin("no_parse_artifact", "extraction_timed_out", "extraction_incomplete")).alias("incomplete_papers"),
        F.coalesce(F.sum("assembled_records"), F.lit(0)).alias("assembled_records"),
        *[F.count_if(F.col("outcome") == x).alias(f"n_{x}") for x in OUTCOMES],
    )
    if strict and (row := out.first()) and (row["zero_yield_papers"] or row["incomplete_papers"]):
        raise RuntimeError(f"strict coverage failed: {row['zero_yield_papers']} papers without records, {row['incomplete_papers']} incomplete")
    return out


def manifest_yield(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """Records of every paper of the manifest, zeros included."""
    n = records.where(~blank("paper_uid")).groupBy("paper_uid").agg(F.count("*").alias("n"))
    return manifest.select("paper_uid").join(n, "paper_uid", "left").select("paper_uid", F.coalesce("n", F.lit(0)).alias("n"))


def postprocess_hooks(records: DataFrame, hooks: Iterable[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Apply functions from DataFrame to DataFrame in order."""
    for hook in hooks:
        records = records.transform(hook)
        if not isinstance(records, DataFrame):
            raise TypeError("a hook must return a DataFrame")
    return records


def assemble_records(records: DataFrame, papers: DataFrame | None = None, doi_map=None, rules=(), hooks=(), aliases=None, bounds: dict = BOUNDS) -> DataFrame:
    """The assembled table from flat records: overrides, hooks, names, metadata, merge, tangent, bounds, duplicates."""
    # Written before names are counted and before halves are grouped, as both read the rows twice.
    r = cut(postprocess_hooks(apply_overrides(records, doi_map, rules), hooks))

    def job(part: DataFrame) -> DataFrame:
        part = canonical_materials(part, aliases)
        if papers is not None:
            part = resolve_metadata(part, papers)
        return dedup_records(validate_bounds(loss_tangent(merge_split(cut(part))), bounds))

    return by_parts(job, (r, material_group(aliases)))


def assemble(artifacts: DataFrame, papers: DataFrame, **options) -> DataFrame:
    """The whole job from artifacts and papers."""
    return assemble_records(flatten_records(artifacts, papers), papers, **options)
