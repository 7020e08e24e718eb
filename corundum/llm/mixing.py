"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Every source gets a share of all words by its weight, is clamped at MAX_EPOCHS times its own words,
and what that leaves over is dealt again by weight until no source is above its clamp. A document is then taken
floor(target / source size) times whole, and once more if it falls into the fraction that is left:
documents of a source stand in the order of a seeded hash and are taken as long as their middle lies before the goal,
so a source misses its target by half a document at most, and reruns agree.

The order is cut into CELLS cells by the hash. Their sums show in which cell of each source the fraction ends; only the
documents of that cell are put in order, and the last document taken is all that a source needs: whether a document is taken once
more is then a comparison with it. So no source, however large, is sorted, and the documents are not shuffled.

Null texts have size 0 and are taken 0 words; null is a source of its own, the last; documents that repeat an id are
ordered by the MD5 of their text; rows of equal id, text and source share one place and are taken equally often, as one document of their
sizes together; an empty table gives an empty result; only doc_id, text and source are read, so other columns, also of clashing names, change
nothing, and ``repeat_rows`` hands them on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corundum.llm._spark import cut, small

MAX_EPOCHS = 3
CELLS = 4096
SEED = "mix-1"
#: Runs of anything but the ASCII white space.
BLANK = r"[\x20\x09-\x0D]+"


def n_words(text: str) -> F.Column:
    return F.coalesce(F.size(F.filter(F.split(F.col(text), BLANK), lambda w: w != "")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=(1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source; their ranks are counted by sorted partition."""
    ranged = cut(sources.select("source", "source_size").orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    # As many rows as the sorted table has partitions.
    counts = ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    offsets = counts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    ranked = ranged.withColumn("part", part).join(F.broadcast(offsets), "part")
    nth = F.pmod(F.col("offset") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)), F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int"))
    s = cut(ranked.select("source", "source_size", weight.alias("weight"), F.lit(False).alias("full")))
    cap = F.col("source_size") * F.lit(max_epochs)
    while True:
        rest = s.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(F.col("full"), cap).otherwise(0)).alias("full"),
            F.sum(F.when(~F.col("full"), F.col("weight"))).alias("weight"),
            F.count_if("full").alias("n"),
        ).first()
        level = ((rest["all"] or 0) - (rest["full"] or 0)) / rest["weight"] if rest["weight"] else 0.0
        after = s.withColumn("full", F.col("full") | (F.col("weight") * F.lit(level) > cap))
        if after.where("full").count() == rest["n"]:
            break
        s = cut(after)
    return s.select("source", "source_size", F.when(F.col("full"), cap.cast("double")).otherwise(F.col("weight") * F.lit(level)).alias("target"))


def spot(seed: str = SEED) -> F.Column:
    """A document's place in the order of its source."""
    return F.concat(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), F.md5(F.coalesce("text", F.lit(""))))


def source_key() -> F.Column:
    """One key for null and named sources alike."""
    return F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), "source"))


def plan(d: DataFrame, weights=(1, 2, 3), max_epochs: int = MAX_EPOCHS, cells: int = CELLS) -> DataFrame:
    """(key, source_size, target, whole, last) of each source, from (source, key, spot, size) of each document: how often all of it
    is taken, and the place of the last document that is taken once more."""
    cell = (F.conv(F.substring("spot", 1, 8), 16, 10).cast("long") * cells / F.lit(1 << 32)).cast("int")
    d = d.withColumn("cell", cell)
    per_cell = cut(d.groupBy("key", "source", "cell").agg(F.sum("size").alias("words"), F.max("spot").alias("end")))
    goal = targets(per_cell.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs).withColumn("key", source_key()).drop("source")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = cut(goal.withColumn("whole", whole).withColumn("part", F.col("target") - F.col("whole") * F.col("source_size")))
    before = F.coalesce(F.sum("words").over(Window.partitionBy("key").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranged = per_cell.select("key", "cell", "words", "end", before.alias("before")).join(small(goal.select("key", "part")), "key")
    # The last cell that begins before the goal holds the last document taken, or all cells before it are taken and nothing of it is.
    reached = ranged.where("before <= part").groupBy("key").agg(F.max(F.struct("cell", "before", "part")).alias("c")).select("key", "c.*")
    previous = ranged.join(small(reached.select("key", F.col("cell").alias("at"))), "key").where("cell < at").groupBy("key").agg(F.max(F.struct("cell", "end")).alias("p")).select("key", F.col("p.end").alias("end"))
    inside = d.join(small(reached), ["key", "cell"]).groupBy("key", "spot", "before", "part").agg(F.sum("size").alias("size"))
    ahead = F.coalesce(F.sum("size").over(Window.partitionBy("key").orderBy("spot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = inside.withColumn("ahead", ahead).where(2 * (F.col("before") + F.col("ahead")) + F.col("size") <= 2 * F.col("part"))
    last = taken.groupBy("key").agg(F.max("spot").alias("spot"))
    last = goal.select("key").join(last, "key", "left").join(previous, "key", "left").select("key", F.coalesce("spot", "end", F.lit("")).alias("last"))
    return cut(goal.join(last, "key").select("key", "source_size", "target", "whole", "last"))


def documents_plan(docs: DataFrame, seed: str) -> DataFrame:
    return docs.select("doc_id", "source", source_key().alias("key"), n_words("text").alias("size"), spot(seed).alias("spot"))


def mix(docs: DataFrame, weights=(1, 2, 3), max_epochs: int = MAX_EPOCHS, seed: str = SEED, cells: int = CELLS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies (how often it is taken) and taken (its words that the mix takes)."""
    d = cut(documents_plan(docs, seed))
    copies = F.col("whole") + (F.col("spot") <= F.col("last")).cast("long")
    mixed = d.join(small(plan(d, weights, max_epochs, cells)), "key")
    return mixed.select("doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def repeat_rows(docs: DataFrame, weights=(1, 2, 3), max_epochs: int = MAX_EPOCHS, seed: str = SEED, cells: int = CELLS) -> DataFrame:
    """The documents as the mix has them: each row, with all its columns, as often as it is taken."""
    goal = plan(cut(documents_plan(docs, seed)), weights, max_epochs, cells)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), source_key().alias("key"), spot(seed).alias("spot"))
    copies = F.col("whole") + (F.col("spot") <= F.col("last")).cast("long")
    return rows.join(small(goal), "key").where(copies > 0).select("doc", F.explode(F.sequence(F.lit(1).cast("long"), copies))).select("doc.*")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}:' || COALESCE(CAST(doc_id AS VARCHAR), 'null')) || md5(COALESCE(text, '')) AS spot
  FROM documents),
s AS (
  SELECT source, SUM(size)::BIGINT AS source_size,
         ((ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM d GROUP BY source),
o AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY {MAX_EPOCHS} * source_size / weight, source NULLS LAST) AS k FROM s),
l AS (
  SELECT k, weight, source_size,
         ((SELECT SUM(source_size) FROM s)
          - COALESCE(SUM({MAX_EPOCHS} * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / SUM(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM o),
f AS (SELECT k, level FROM l WHERE weight * level <= {MAX_EPOCHS} * source_size ORDER BY k LIMIT 1),
t AS (
  SELECT o.source, o.source_size, CASE WHEN o.k < f.k THEN ({MAX_EPOCHS} * o.source_size)::DOUBLE ELSE o.weight * f.level END AS target
  FROM o, f),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM t),
q AS (SELECT source, spot, SUM(size) AS size FROM d GROUP BY source, spot),
r AS (
  SELECT q.source, q.spot, q.size AS place_size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS part,
         COALESCE(SUM(q.size) OVER (PARTITION BY q.source ORDER BY q.spot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM q JOIN p ON q.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       ((whole + CASE WHEN 2 * ahead + place_size <= 2 * part THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM d JOIN r ON d.spot = r.spot AND d.source IS NOT DISTINCT FROM r.source
"""
