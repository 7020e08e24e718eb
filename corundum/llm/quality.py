"""Quality rules with cross-document line frequency, in DataFrame operations only.

Lines are normalised (lower case, digits to 0, white space to one blank) and hashed. For each host (`source`) and line the
distinct documents that hold it are counted; a line that more than SHARE of the host's documents hold, and more than LEAST of
them, is removed everywhere on that host. A document of which fewer than half of the words are left is depleted and rejected.

Null texts have no words and fail the base rules, as do empty and blank ones; a null source is a host of its own; rows that repeat a
doc_id count once for their lines, all rows without an id together once, and each row gets its own answer, equal rows equal ones; extra
columns are ignored; an empty table gives an empty result. The counts of one text are made by expressions over its word array, sorted, so
they cost n log n in the text's length and no shuffle. Lines are counted by rows first; only those that could be frequent are counted again by
distinct documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corundum.llm._spark import cut, small

LEAST, SHARE = 20, 0.001
BLANK = r"[\x20\x09-\x0D]+"
SOLID = r"[^\x20\x09-\x0D]"


def bind(value: F.Column, body) -> F.Column:
    """body(value), with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_repeat_words(words: F.Column) -> F.Column:
    """Words inside runs of three words that occur at least twice in the text, the first occurrence included."""

    def count(w):
        ids = F.transform(w, lambda x: F.xxhash64(x))
        return bind(ids, lambda h: bind(F.transform(F.sequence(F.lit(1), F.size(h) - 2), lambda i: F.xxhash64(F.element_at(h, i), F.element_at(h, i + 1), F.element_at(h, i + 2))), lambda r: F.when(F.size(F.array_distinct(r)) == F.size(r), F.lit(0).cast("long")).otherwise(covered(r))))

    def covered(r):
        sorted_ = F.array_sort(F.transform(r, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twins = bind(sorted_, lambda s: F.filter(s, lambda x, k: F.coalesce((x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["h"] == F.get(s, k - 1)["h"], x["h"] == F.get(s, k + 1)["h"], F.lit(False))))
        starts = F.array_sort(F.transform(twins, lambda x: x["i"]))
        # Overlapping runs count a word once: every run adds what lies before the next one starts.
        return F.aggregate(starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("at")), lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["at"])).alias("n"), i.alias("at")), lambda a: a["n"])

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(bind(words, count))


def base(docs: DataFrame) -> DataFrame:
    """doc_id, source, the base counts, and the hashed distinct lines with their words."""
    d = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("words", F.filter(F.split("text", BLANK), lambda w: w != "")).withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(SOLID))))
    line = lambda x: F.struct(F.xxhash64(F.btrim(F.regexp_replace(F.regexp_replace(F.lower(x), "[0-9]", "0"), BLANK, " "))).alias("line"), F.size(F.filter(F.split(x, BLANK), lambda w: w != "")).alias("n"))
    return d.select(
        "doc_id",
        "source",
        F.md5("text").alias("digest"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        n_repeat_words(F.col("words")).alias("n_repeat_words"),
        F.transform("lines", line).alias("lines"),
    )


def quality(docs: DataFrame, least: int = LEAST, share: float = SHARE) -> DataFrame:
    """One row per document: the base counts, removed_words, base_failed and kept."""
    d = base(docs).withColumn("host", F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), "source")))
    row = F.unhex(F.md5(F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "digest", "host")))
    d = cut(d.withColumn("row", row).drop("digest", "source"))
    lines = d.select("host", "doc_id", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
    n_host = small(cut(d.select("host", "doc_id").distinct().groupBy("host").agg(F.count("*").alias("documents"))))
    often = lines.groupBy("host", "line").agg(F.count("*").alias("n")).join(n_host, "host").where((F.col("n") > least) & (F.col("n") > share * F.col("documents")))
    held = lines.join(small(cut(often.select("host", "line", "documents"))), ["host", "line"]).distinct()
    counts = held.groupBy("host", "line", "documents").agg(F.count("*").alias("n"))
    common = cut(counts.where((F.col("n") > least) & (F.col("n") > share * F.col("documents"))).select("host", "line"))
    rows = d.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.line", "x.n")
    gone = rows.join(small(common), ["host", "line"], "left_semi").groupBy("row").agg(F.sum("n").alias("n"))
    # Equal rows share a row key: what is gone of all of them is as much for each.
    copies = d.groupBy("row").agg(F.count("*").alias("copies"))
    gone = gone.join(copies, "row").select("row", (F.col("n") / F.col("copies")).cast("long").alias("removed"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    removed = F.coalesce("removed", F.lit(0)).cast("long")
    return d.join(gone, "row", "left").select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", removed.alias("removed_words"), failed.alias("base_failed"), (~failed & (2 * removed <= F.col("n_words"))).alias("kept"))


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, COALESCE(text, '') AS text, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
p AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM d),
g AS (SELECT doc_id, i, a, lead(a, 1) OVER s AS b, lead(a, 2) OVER s AS c FROM p WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
t AS (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g WHERE c IS NOT NULL),
r AS (SELECT doc_id, COUNT(DISTINCT i + k)::BIGINT AS n FROM t, (VALUES (0), (1), (2)) AS o(k) WHERE n > 1 GROUP BY doc_id),
l AS (
  SELECT doc_id, source, x,
         trim(regexp_replace(regexp_replace(lower(x), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line,
         len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
u AS (SELECT doc_id, (COUNT(*) - COUNT(DISTINCT x))::BIGINT AS n FROM l GROUP BY doc_id),
h AS (SELECT source, COUNT(DISTINCT COALESCE(CAST(doc_id AS VARCHAR), '-')) AS documents FROM d GROUP BY source),
f AS (
  SELECT l.source, l.line FROM l JOIN h ON l.source IS NOT DISTINCT FROM h.source
  GROUP BY l.source, l.line, h.documents
  HAVING COUNT(DISTINCT COALESCE(CAST(doc_id AS VARCHAR), '-')) > {LEAST} AND COUNT(DISTINCT COALESCE(CAST(doc_id AS VARCHAR), '-')) > {SHARE} * h.documents),
m AS (
  SELECT doc_id, SUM(n)::BIGINT AS n FROM l
  WHERE EXISTS (SELECT 1 FROM f WHERE f.source IS NOT DISTINCT FROM l.source AND f.line = l.line) GROUP BY doc_id),
b AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, COALESCE(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, COALESCE(u.n, 0) AS n_dup_lines,
         COALESCE(r.n, 0) AS n_repeat_words, COALESCE(m.n, 0) AS removed_words
  FROM d LEFT JOIN u USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN m USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * removed_words <= n_words AS kept
FROM b
"""
