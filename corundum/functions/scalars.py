"""Column functions that several jobs share; all are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def barrier(df):
    """The same rows behind a generator, past which the optimizer doesn't inline the columns' expressions."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def rounded(c: str | Column, digits: int = 0) -> Column:
    """Half-even rounding of the scaled double."""
    scale = float(10**digits)
    return F.rint(col(c) * scale) / scale


def blank(c: str | Column) -> Column:
    return F.coalesce(F.trim(col(c)), F.lit("")) == ""


def filled(c: str | Column) -> Column:
    """The value, or NULL where it is blank."""
    return F.when(~blank(c), col(c))


def normalize_paper_path(c: str | Column) -> Column:
    """A comparable name of a file path: no folders, no suffix, no leading number, `_` and white space as one blank, lower case."""
    name = F.regexp_replace(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"^.*[/\\]", ""), r"(?i)\.pdf$", "")
    name = F.regexp_replace(name, r"^\s*[0-9]+\s*[.)-]\s*", "")
    return F.lower(F.trim(F.regexp_replace(name, r"[_\s]+", " ")))


def normalize_paper_label(c: str | Column) -> Column:
    """A comparable source label: no leading number, separators as one blank, lower case."""
    label = F.regexp_replace(F.trim(F.coalesce(col(c), F.lit(""))), r"^\s*\d+\s*[.)-]\s*", "")
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(label, "[_-]+", " "), r"\s+", " ")))


def slugify(c: str | Column, most: int = 60) -> Column:
    """A readable part of a file name; never an identity."""
    slug = F.regexp_replace(F.regexp_replace(col(c), r"[^\w-]+", "_"), "_{2,}", "_")
    return F.coalesce(filled(F.substring(F.regexp_replace(slug, "^_+|_+$", ""), 1, most)), F.lit("paper"))


def artifact_name(uid: str | Column, slug: str | Column) -> Column:
    return F.concat(col(uid), F.lit("__"), slugify(slug))


def is_uid(c: str | Column) -> Column:
    return F.coalesce(col(c).rlike("^[0-9a-f]{12}$"), F.lit(False))


def split_artifact_name(c: str | Column) -> Column:
    """struct(uid, slug), both NULL where the name isn't one of an artifact."""
    part = lambda n: filled(F.regexp_extract(col(c), "^([0-9a-f]{12})__(.+)$", n))
    return F.struct(part(1).alias("uid"), part(2).alias("slug"))


def extract_mean(c: str | Column) -> Column:
    """The number of a cell such as `1.2`, `−1.2` or `1.2 ± 0.1`."""
    text = F.trim(F.translate(col(c).cast("string"), "−", "-"))
    return F.trim(F.regexp_replace(text, r"\s*(±|\+/-|\+-).*$", "")).try_cast("double")


def ism_normalize(c: str | Column) -> Column:
    """27.12 and 40.68 MHz as the nominal 27 and 40."""
    return F.when(F.abs(col(c) - 27.12) < 1e-9, 27.0).when(F.abs(col(c) - 40.68) < 1e-9, 40.0).otherwise(col(c))


def moisture_basis_norm(c: str | Column) -> Column:
    """wet, dry or unknown for the known spellings (fixed values); others pass through in lower case."""
    text = F.lower(F.trim(F.coalesce(col(c), F.lit(""))))
    return (
        F.when(text.isin("", "none", "nan", "unknown", "unspecified"), "unknown")
        .when(text.isin("wet", "wet basis", "wet-basis", "wb", "w.b.", "w.b"), "wet")
        .when(text.isin("dry", "dry basis", "dry-basis", "db", "d.b.", "d.b"), "dry")
        .otherwise(text)
    )


def paper_identity(uid: str = "paper_uid", doi: str = "doi", name: str = "paper_id") -> Column:
    """The uid, else the DOI, else the name of a row's source, prefixed so the kinds never meet."""
    lower = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))
    return F.when(~blank(uid), F.trim(F.col(uid))).when(~blank(doi), F.concat(F.lit("doi:"), lower(doi))).otherwise(F.concat(F.lit("name:"), lower(name)))


def plausible(prop: str | Column, value: str | Column, frequency: str | Column) -> Column:
    """Whether a computed property is physically possible (fixed bounds); up to 100 MHz they are wider."""
    radio = F.coalesce(col(frequency) <= 100, F.lit(False))
    top = (
        F.when(col(prop) == "dielectric_constant", F.when(radio, 300.0).otherwise(200.0))
        .when(col(prop) == "loss_tangent", F.when(radio, 50.0).otherwise(10.0))
        .otherwise(F.when(radio, 5000.0).otherwise(200.0))
    )
    return F.coalesce((col(value) >= 0) & (col(value) <= top) & ~F.isnan(col(value)), F.lit(False))


#: Words that say nothing about which material it is (fixed values).
GENERIC = ("dried", "fresh", "kernel", "kernels", "sample", "slice", "slices")
UNITS = ("percent", "pct", "wb", "db", "salt")


def material_tokens(c: str | Column) -> Column:
    """The identity-bearing words of a material label, singular, sorted and distinct."""
    words = F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit(r"([a-z]+|[0-9]+(?:\.[0-9]+)?%?)"))
    words = F.filter(words, lambda w: ~w.rlike("^[0-9]") & ~w.isin(*UNITS))
    stem = lambda w: (
        F.when(w.rlike("^.+ies$"), F.regexp_replace(w, "ies$", "y")).when(w.rlike("^.+oes$"), F.regexp_replace(w, "es$", "")).when(w.rlike("^.{2,}[^s]s$"), F.regexp_replace(w, "s$", "")).otherwise(w)
    )
    return F.array_sort(F.array_distinct(F.filter(F.transform(words, stem), lambda w: ~w.isin(*GENERIC))))


def tokens_match(left: Column, right: Column) -> Column:
    return (F.size(left) == 0) | (F.size(right) == 0) | (F.size(F.array_except(left, right)) == 0) | (F.size(F.array_except(right, left)) == 0)


def material_match(left: str | Column, right: str | Column) -> Column:
    """A missing label matches everything, else one set of words must contain the other."""
    return tokens_match(material_tokens(left), material_tokens(right))
