"""Preparing the text of papers: identifiers, sections, windows, conditions, requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corundum.functions.scalars import col, filled
from corundum.operators.tables import chunk_tables, labels

DOI = r"10\.[0-9]{4,}/[^\s,;\"')]+"
#: Section headings (fixed values).
RESULTS = ("results", "result", "results and discussion", "discussion", "findings")
SKIPPED = ("introduction", "literature", "background", "references", "acknowledgment", "acknowledgement")
#: Frequencies that running text may name, MHz (fixed values).
ISM = (13.56, 27.0, 27.12, 40.0, 40.68, 433.0, 915.0, 1800.0, 2450.0, 5800.0)
FREQUENCY = r"(?i)([0-9]+(?:\.[0-9]+)?)\s*(MHz|GHz)"


def find_doi(text: str | Column) -> Column:
    return filled(F.regexp_replace(F.regexp_extract(col(text), f"({DOI})", 1), r"\.+$", ""))


def extract_doi(papers: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """The papers with doi: the first in 5000 characters, else anywhere, else local/<file stem>; overrides (key, doi) replace by doi or stem."""
    stem = F.regexp_replace(F.regexp_replace("pdf_path", r"^.*[/\\]", ""), r"(?i)\.pdf$", "")
    local = F.concat(F.lit("local/"), stem)
    doi = F.coalesce(find_doi(F.substring("full_text", 1, 5000)), find_doi("full_text"), local)
    out = papers.withColumn("doi", doi)
    if overrides is None:
        return out
    fold = lambda c: F.lower(F.regexp_replace(c, "[ _]+", "_"))
    o = overrides.select(fold(F.col("key")).alias("_k"), F.col("doi").alias("_o")).dropDuplicates(["_k"])
    # Both names of a paper are looked up by equality, the DOI first.
    by_doi, by_stem = o.select(F.col("_k").alias("_k1"), F.col("_o").alias("_o1")), o.select(F.col("_k").alias("_k2"), F.col("_o").alias("_o2"))
    j = out.join(by_doi, fold(F.col("doi")) == F.col("_k1"), "left").join(by_stem, fold(local) == F.col("_k2"), "left")
    return j.withColumn("doi", F.coalesce("_o1", "_o2", "doi")).select(*out.columns)


def _has(text: Column, words) -> Column:
    return text.rlike("|".join(w.replace(".", r"\.").replace("(", r"\(") for w in words))


def results_text(sections: DataFrame, papers: DataFrame) -> DataFrame:
    """(paper_uid, text): the results sections in order, or the full text where a paper has none."""
    heading = F.lower(F.trim("heading"))
    s = sections.where(_has(heading, RESULTS) & ~_has(heading, SKIPPED)).select("paper_uid", "idx", F.concat(F.lit("## "), "heading", F.lit("\n"), "text").alias("t"))
    joined = s.groupBy("paper_uid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "t"))), lambda x: x["t"]), "\n\n").alias("_t"))
    return papers.join(joined, "paper_uid", "left").select("paper_uid", F.coalesce("_t", "full_text").alias("text"))


def text_windows(df: DataFrame, size: int = 24000, overlap: int = 2000) -> DataFrame:
    """(paper_uid, window_no, text): windows of `size` characters that overlap; a text of up to `size` is one."""
    n = F.coalesce(F.length("text"), F.lit(0))
    starts = F.when(n <= size, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), n - 1, F.lit(size - overlap)))
    return df.select("paper_uid", "text", F.posexplode(starts).alias("window_no", "at")).select("paper_uid", "window_no", F.expr(f"substring(text, at + 1, {size})").alias("text"))


def _frequencies(text: str | Column) -> Column:
    t = col(text)
    numbers, units = F.regexp_extract_all(t, F.lit(FREQUENCY), F.lit(1)), F.regexp_extract_all(t, F.lit(FREQUENCY), F.lit(2))
    return F.zip_with(numbers, units, lambda x, u: F.when(F.lower(u) == "ghz", x.cast("double") * 1000).otherwise(x.cast("double")))


def detect_frequencies(papers: DataFrame, tables: DataFrame) -> DataFrame:
    """(paper_uid, freqs): MHz values of table captions and headers, and well-known ones of the first 5000 characters."""
    head = F.concat_ws(" ", "caption", F.array_join(F.flatten("headers"), " "))
    t = tables.select("paper_uid", F.explode(F.filter(_frequencies(head), lambda x: x.between(1, 300000))).alias("f")).groupBy("paper_uid").agg(F.collect_set("f").alias("_f"))
    known = F.array(*[F.lit(x) for x in ISM])
    own = F.array_intersect(F.array_distinct(_frequencies(F.substring("full_text", 1, 5000))), known)
    return papers.join(t, "paper_uid", "left").select("paper_uid", F.array_sort(F.array_distinct(F.concat(own, F.coalesce("_f", F.array().cast("array<double>"))))).alias("freqs"))


def enrich_moisture(papers: DataFrame, tables: DataFrame) -> DataFrame:
    """Fill a missing moisture basis, levels and range from explicit statements in text and tables."""
    cell_text = F.concat_ws(" ", F.flatten("headers"), F.flatten("rows"))
    header = F.lower(F.array_join(F.flatten("headers"), " "))
    first = F.transform("rows", lambda r: F.regexp_extract(F.get(r, F.lit(0)), r"(?:^|[^\d.])(\d+(?:\.\d+)?)", 1).try_cast("double"))
    levels = F.array_sort(F.array_distinct(F.filter(first, lambda x: (x > 0) & (x <= 100))))
    t = tables.select("paper_uid", "table_id", F.when(F.lower(cell_text).contains("moisture"), cell_text).alias("_c"), F.when(header.contains("moisture"), levels).alias("_l"))
    t = t.groupBy("paper_uid").agg(F.concat_ws(" ", F.sort_array(F.collect_list("_c"))).alias("_c"), F.min_by("_l", F.when(F.size("_l") >= 2, F.col("table_id"))).alias("_l"))
    p = papers.join(t, "paper_uid", "left")
    around = F.array_join(F.regexp_extract_all(F.lower(F.concat_ws(" ", "_c", "full_text")), F.lit(r"(?s)(.{0,100}moisture.{0,100})"), F.lit(1)), " ")
    p = p.withColumn("_a", around)
    # Spellings of the two bases, and a stated span (fixed patterns).
    wet, dry = F.col("_a").rlike(r"\bw\.\s*b\.?|\bwet\s+basis\b"), F.col("_a").rlike(r"\bd\.\s*b\.?|\bdry\s+basis\b")
    basis = F.coalesce(filled("moisture_basis"), F.when(wet & ~dry, "wet").when(dry & ~wet, "dry"))
    lv = F.when(F.size("moisture_levels_pct") > 0, F.col("moisture_levels_pct")).otherwise(F.when(F.size("_l") >= 2, F.col("_l")).otherwise(F.array().cast("array<double>")))
    span = r"(?is)moisture content.{0,100}?(\d+(?:\.\d+)?)\s*%?\s*(?:-|–|—|to)\s*(\d+(?:\.\d+)?)\s*%"
    a, b = (F.regexp_extract("full_text", span, k).try_cast("double") for k in (1, 2))
    lo, hi = F.least(a, b), F.greatest(a, b)
    said = F.when((lo > 0) & (lo < hi) & (hi <= 100), F.struct(lo.alias("lo"), hi.alias("hi")))
    p = p.withColumns({"moisture_basis": basis, "moisture_levels_pct": lv})
    reach = F.when(F.size("moisture_levels_pct") > 0, F.struct(F.array_min("moisture_levels_pct").alias("lo"), F.array_max("moisture_levels_pct").alias("hi"))).otherwise(said)
    return p.withColumn("moisture_range_pct", F.coalesce("moisture_range_pct", reach)).select(*papers.columns)


SCREENED = "struct<doi:string,title:string,authors:array<string>,year:int,journal:string,primary_materials:array<string>,measurement_frequencies_mhz:array<double>,moisture_basis:string>"


def apply_screening(papers: DataFrame, screenings: DataFrame) -> DataFrame:
    """Overlay cached screening metadata, JSON in (paper_uid, metadata): values that aren't empty win, list fields wherever their key is present; then look for a DOI."""
    s = screenings.select("paper_uid", F.from_json("metadata", SCREENED).alias("_m"), F.json_object_keys("metadata").alias("_k"))
    p = papers.join(s, "paper_uid", "left")
    value = lambda c: F.col(f"_m.{c}")
    text = {c: F.coalesce(filled(value(c)), F.col(c)) for c in ("title", "journal")}
    year = F.coalesce(F.when(value("year") != 0, value("year")), F.col("year"))
    authors = F.when(F.size(value("authors")) > 0, value("authors")).otherwise(F.col("authors"))
    lists = {c: F.when(F.coalesce(F.array_contains("_k", c), F.lit(False)), F.coalesce(value(c), F.array().cast(t))).otherwise(F.col(c)) for c, t in (("primary_materials", "array<string>"), ("measurement_frequencies_mhz", "array<double>"))}
    basis = F.when(value("moisture_basis").isin("wet", "dry", "unknown"), value("moisture_basis")).otherwise(F.col("moisture_basis"))
    doi = F.coalesce(filled(value("doi")), find_doi("full_text"), F.col("doi"))
    return p.withColumns({**text, "year": year, "authors": authors, **lists, "moisture_basis": basis, "doi": doi}).select(*papers.columns)


def sanitize_custom_id(c: str | Column) -> Column:
    """A request id of at most 64 characters of A-Z a-z 0-9 _ -; whatever was lost is kept as a digest."""
    x = col(c)
    clean = F.regexp_replace(x, "[^a-zA-Z0-9_-]", "_")
    changed = (clean != x) | (F.length(clean) > 64) | (clean == "")
    return F.when(changed, F.concat(F.substring(clean, 1, 54), F.lit("_"), F.substring(F.sha2(x, 256), 1, 9))).otherwise(clean)


def build_requests(units: DataFrame, papers: DataFrame, models: dict[str, str]) -> DataFrame:
    """One request per unit (paper_uid, kind, unit_no, text): custom_id, model and prompt; first units carry the paper's context, later ones are light.

    Ids that collide raise when the plan runs, as a failed assertion on the row."""
    context = F.concat_ws("\n", F.concat(F.lit("Title: "), F.coalesce("title", F.lit(""))), F.concat(F.lit("Materials: "), F.array_join(F.coalesce("primary_materials", F.array().cast("array<string>")), ", ")), F.concat(F.lit("Frequencies: "), F.array_join(F.transform(F.coalesce("measurement_frequencies_mhz", F.array().cast("array<double>")), lambda x: x.cast("string")), ", ")))
    facts = papers.select("paper_uid", context.alias("_context")).dropDuplicates(["paper_uid"])
    model = F.lit(models.get("default"))
    for kind, name in models.items():
        model = F.when(F.col("kind") == kind, name).otherwise(model)
    cid = F.concat_ws("/", "paper_uid", "kind", F.col("unit_no").cast("string"))
    prompt = F.concat(F.when(F.col("unit_no") == 0, F.coalesce("_context", F.lit(""))).otherwise(F.concat(F.lit("Part "), (F.col("unit_no") + 1).cast("string"))), F.lit("\n\n"), F.coalesce("text", F.lit("")))
    out = units.join(facts, "paper_uid", "left").select(sanitize_custom_id(cid).alias("custom_id"), cid.alias("_raw"), "paper_uid", "kind", "unit_no", model.alias("model"), prompt.alias("prompt"))
    twice = out.groupBy("custom_id").agg(F.min("_raw").alias("_lo"), F.max("_raw").alias("_hi"))
    checked = out.join(twice, "custom_id").withColumn("custom_id", F.when(F.col("_lo") == F.col("_hi"), F.col("custom_id")).otherwise(F.raise_error(F.concat(F.lit("request ids collide: "), "custom_id"))))
    return checked.drop("_raw", "_lo", "_hi")


#: Headings of sections that say how something was measured (fixed values).
METHODS = ("method", "material", "experimental")


def methods_summary(papers: DataFrame, sections: DataFrame) -> DataFrame:
    """(paper_uid, methods): the first 1500 characters of a paper's first methods section, else the first 800 of its text."""
    found = sections.where(_has(F.lower("heading"), METHODS)).groupBy("paper_uid").agg(F.min_by("text", "idx").alias("_m"))
    return papers.join(found, "paper_uid", "left").select("paper_uid", F.coalesce(F.substring("_m", 1, 1500), F.substring("full_text", 1, 800), F.lit("")).alias("methods"))


def _listed(values: Column, glue: str = " | ") -> Column:
    return F.array_join(F.transform(values, lambda x: F.coalesce(x.cast("string"), F.lit(""))), glue)


def table_requests(tables: DataFrame, papers: DataFrame, sections: DataFrame, models: dict[str, str], max_rows: int = 12) -> DataFrame:
    """One request per chunk of each table: custom_id, paper_uid, kind, unit_no, model, prompt.

    The first chunk carries what the paper is about and how it measured, later ones only the table's own head. Rows are labelled by
    column, and a chunk is described by the values of its first column."""
    none = F.array().cast("array<string>")
    chunks = chunk_tables(tables, max_rows)
    n = chunks.groupBy("table_id").agg(F.count("*").alias("n_chunks"))
    facts = papers.join(methods_summary(papers, sections), "paper_uid").select(
        "paper_uid",
        F.concat_ws(
            "\n",
            F.concat(F.lit("DOI: "), F.coalesce("doi", F.lit(""))),
            F.concat(F.lit("Title: "), F.coalesce("title", F.lit(""))),
            F.when(F.size("primary_materials") > 0, F.concat(F.lit("Materials: "), _listed(F.col("primary_materials"), ", "))),
            F.when(F.size("measurement_frequencies_mhz") > 0, F.concat(F.lit("Frequencies, MHz: "), _listed(F.col("measurement_frequencies_mhz"), ", "))),
            F.lit("Only what the authors measured themselves counts, not what they cite."),
            F.when(F.col("methods") != "", F.concat(F.lit("How it was measured:\n"), F.col("methods"))),
        ).alias("about"),
        F.coalesce("doi", F.lit("")).alias("doi"),
    )
    facts = facts.groupBy("paper_uid").agg(F.min("about").alias("about"), F.min("doi").alias("doi"))
    own = tables.select("paper_uid", "table_id", "caption", "headers", labels().alias("labels"), (F.col("footnotes") if "footnotes" in tables.columns else none).alias("footnotes"))
    d = chunks.join(n, "table_id").join(own, "table_id").join(facts, "paper_uid", "left")
    named = lambda r: F.when(F.size(r) == F.size("labels"), _listed(F.zip_with("labels", r, lambda k, v: F.concat(k, F.lit("="), F.coalesce(v, F.lit("")))), "; ")).otherwise(_listed(r))
    rows = F.array_join(F.transform("rows", lambda r, i: F.concat((i + 1).cast("string"), F.lit(". "), named(r))), "\n")
    groups = F.array_sort(F.array_distinct(F.transform(F.filter("rows", lambda r: F.size(r) > 0), lambda r: F.trim(F.coalesce(r[0], F.lit(""))))))
    several = F.col("n_chunks") > 1
    part = F.when(several, F.concat(F.lit(", part "), (F.col("chunk_no") + 1).cast("string"), F.lit(" of "), F.col("n_chunks").cast("string"))).otherwise("")
    count = F.size("rows").cast("string")
    prompt = F.concat_ws(
        "\n",
        F.when(F.col("chunk_no") == 0, F.col("about")).otherwise(F.concat(F.lit("DOI: "), F.coalesce("doi", F.lit("")), F.lit(", continued"))),
        F.concat(F.lit("Table "), "table_id", part),
        F.concat(F.lit("Caption: "), F.coalesce("caption", F.lit(""))),
        F.when(F.size("headers") > 0, F.concat(F.lit("Header: "), F.array_join(F.transform("headers", lambda r: _listed(r)), " // "))),
        F.when(several & (F.size(groups) > 0), F.concat(F.lit("This part is about: "), F.array_join(groups, ", "))),
        F.concat(count, F.lit(" rows:")),
        rows,
        F.when(F.size("footnotes") > 0, F.concat(F.lit("Notes: "), _listed(F.col("footnotes"), " "))),
        F.concat(F.lit("Give one record for each of these "), count, F.lit(" rows.")),
    )
    cid = F.concat_ws("/", "paper_uid", "table_id", F.col("chunk_no").cast("string"))
    model = F.lit(models.get("table", models.get("default")))
    return d.select(sanitize_custom_id(cid).alias("custom_id"), "paper_uid", F.lit("table").alias("kind"), F.col("chunk_no").alias("unit_no"), model.alias("model"), prompt.alias("prompt"))


def screening_requests(papers: DataFrame, tables: DataFrame, models: dict[str, str]) -> DataFrame:
    """One request per paper: its title, abstract, first 3000 characters, and what its tables look like."""
    ten = lambda row: _listed(F.slice(row, 1, 10))
    line = F.concat(
        F.lit("- "), "table_id", F.lit(": "), F.coalesce("caption", F.lit("")),
        F.when(F.size("headers") > 0, F.concat(F.lit("; header "), ten(F.get("headers", F.lit(0))))).otherwise(""),
        F.when(F.size("rows") > 0, F.concat(F.lit("; "), F.size("rows").cast("string"), F.lit(" rows, first "), ten(F.get("rows", F.lit(0))))).otherwise(""),
    )
    t = tables.select("paper_uid", F.struct("table_id", line.alias("line")).alias("x")).groupBy("paper_uid").agg(F.array_sort(F.collect_list("x")).alias("_t"))
    abstract = F.when(F.coalesce("abstract", F.lit("")) != "", F.concat(F.lit("Abstract: "), F.col("abstract"))) if "abstract" in papers.columns else F.lit(None).cast("string")
    prompt = F.concat_ws(
        "\n",
        F.concat(F.lit("DOI: "), F.coalesce("doi", F.lit(""))),
        F.concat(F.lit("Title: "), F.coalesce("title", F.lit(""))),
        abstract,
        F.concat(F.lit("The text begins:\n"), F.substring(F.coalesce("full_text", F.lit("")), 1, 3000)),
        F.when(F.size("_t") > 0, F.concat(F.lit("It has "), F.size("_t").cast("string"), F.lit(" tables:\n"), F.array_join(F.transform("_t", lambda x: x["line"]), "\n"))),
    )
    cid = F.concat_ws("/", "paper_uid", F.lit("screen"))
    model = F.lit(models.get("screen", models.get("default")))
    return papers.join(t, "paper_uid", "left").select(sanitize_custom_id(cid).alias("custom_id"), "paper_uid", F.lit("screen").alias("kind"), F.lit(0).alias("unit_no"), model.alias("model"), prompt.alias("prompt"))
