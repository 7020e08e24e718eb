"""Passages that repeat across documents, by MinHash banding of paragraphs and by anchors of the word sequence.

A line of LEAST words or more is a paragraph, and runs of shorter lines are joined into blocks of so many, which end where a line's own
checksum says so, wherever the run began; what is left of such a run before a long line or at the end of the text has fewer words and is in
no paragraph, only in the word sequence below. Their signatures are banded (16 bands of 5
rows: a pair of similarity 0.8 collides with probability 0.998), colliding ones are compared by exact Jaccard similarity of five-word
shingles, and links form components of which all but the first paragraph are removed.

A passage inside a longer line, or over parts of several, belongs to no repeated paragraph; for it the whole word sequence of a
document, whatever its lines and marks, is winnowed: of every SPREAD successive shingles of WIDE words the one of least hash is an
anchor. So any WIDE + SPREAD - 1 = 16 words in a row that two documents share have an anchor in common. Anchors that occur in two
documents are widened word by word as far as the other document goes along, and runs of them, with at most GAP words between two, that
together have RUN words or more are passages too. An exact copy of more than 50 words has RUN = 51 - 16 words between its first and
last anchor even where nothing is widened, as its partner may be neither the first nor the last document that has the anchors.

Positions are the number of the first word, in both kinds. Null, empty and short texts have no paragraphs; rows without an id are
compared as paragraphs like any other, but no run is looked for in them; repeated rows of one doc_id are one document for runs across
documents, their equal paragraphs are one paragraph; ties keep the smaller id; extra columns are ignored; an empty table gives an empty
result."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corundum.llm._spark import cut, remove_folder, shared_folder
from corundum.llm._words import hashed_blocks, mix, runs, text_bytes, windows
from corundum.llm.minhash import near_duplicates

LEAST, RUN, GAP = 40, 35, 8
WIDE, SPREAD = 8, 9
#: Words beside an anchor that are kept, a byte each; more than SPREAD - 1 are never needed.
BESIDE = 8
BANDS, ROWS = 16, 5


def anchors(h: np.ndarray, cuts: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Text, first word, words to the last one's first, how many more there are, key, and the words before and after (nearest in the lowest
    byte, 0 where the text ends) of each anchor, or of successive ones that have the same key and words beside them.

    h has the word hashes of successive texts, which start at `cuts`; a text of fewer than `least` words has no anchors. Successive anchors
    start at most SPREAD words apart, so what they and the words beside them cover has no gaps; a few words repeated over and over are
    some rows at each end of the place and one between."""
    length = np.diff(cuts)
    long = length >= max(least, WIDE + SPREAD - 1)
    if not long.any():
        return (np.zeros(0, np.int64),) * 7
    text = np.repeat(np.arange(len(length)), length)
    key = windows(h, WIDE, 0)
    # Of equal keys the first is the least, so the lowest bits are the place.
    place = np.uint64((1 << 20) - 1)
    rank = (key & ~place) | (np.arange(len(key), dtype=np.uint64) & place)
    n = len(rank) - SPREAD + 1
    least_of = np.minimum.reduce([rank[k : k + n] for k in range(SPREAD)])
    least_of[(text[:n] != text[WIDE + SPREAD - 2 :]) | ~long[text[:n]]] = 0
    least_of = np.pad(least_of, SPREAD - 1)
    chosen = np.maximum.reduce([least_of[k : k + len(rank)] for k in range(SPREAD)])
    first = np.flatnonzero((chosen == rank) & (chosen > 0))
    owner, of = text[first], key[first]
    sign = np.zeros(len(h) + BESIDE * (len(length) + 1), np.uint64)
    sign[np.arange(len(h)) + BESIDE * (text + 1)] = np.maximum(mix(h) >> np.uint64(56), np.uint64(1))
    at = first + BESIDE * (owner + 1)
    before, after = np.zeros(len(first), np.uint64), np.zeros(len(first), np.uint64)
    for k in range(BESIDE):
        before |= sign[at - 1 - k] << np.uint64(8 * k)
        after |= sign[at + WIDE + k] << np.uint64(8 * k)
    alike = np.logical_and.reduce([x[1:] == x[:-1] for x in (owner, of, before, after)])
    head = np.flatnonzero(np.append(True, ~alike))
    tail = np.append(head[1:], len(first)) - 1
    owner, more = owner[head], first[tail] - first[head]
    return owner, first[head] - cuts[owner], more, tail - head, *(x[head].view(np.int64) for x in (of, before, after))


def _parts(docs: DataFrame, fields: str, make: Callable[[pa.Array], tuple[Sequence[int], list[pa.Array]]]) -> DataFrame:
    """doc_id and `fields` of the rows that `make` gives for texts.

    make gets about a megabyte of whole texts at a time and returns how many rows each has and their columns, so a task holds one batch of
    texts and little more."""
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))])
            for lo, hi in runs(at):
                counts, columns = make(texts.slice(lo, hi - lo))
                owner = pa.array(np.repeat(np.arange(lo, hi), counts))
                yield pa.RecordBatch.from_arrays([ids.take(owner), *columns], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _anchor_rows(run: int) -> Callable[[pa.Array], tuple[np.ndarray, list[pa.Array]]]:
    def make(texts: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
        counts, found = [], []
        for h, cuts in hashed_blocks(texts):
            owner, *rest = anchors(h, cuts, run)
            counts.append(np.bincount(owner, minlength=len(cuts) - 1))
            found.append(rest)
        columns = [np.concatenate([x[i] for x in found]) for i in range(6)]
        return np.concatenate(counts), [pa.array(x, pa.int32() if i < 3 else pa.int64()) for i, x in enumerate(columns)]

    return make


def _along(a: str, b: str) -> Column:
    """How many words beside an anchor are the same in both, from the nearest on."""
    signed = lambda x: F.lit(x - (1 << 64) if x >> 63 else x).cast("long")
    apart = F.col(a).bitwiseXOR(F.col(b))
    return sum(((apart.bitwiseAND(signed((1 << 8 * k + 8) - 1)) == 0) & (F.col(a).bitwiseAND(signed(0xFF << 8 * k)) != 0)).cast("int") for k in range(BESIDE))


def paragraphs(text: bytes, least: int) -> list[tuple[int, int, bytes]]:
    """First word, number of words and text of each paragraph."""
    out, at, block, start, n = [], 0, [], 0, 0
    for line in text.split(b"\n"):
        k = len(line.split())
        if k >= least:
            if n >= least:
                out.append((start, n, b"\n".join(block)))
            block, n = [], 0
            out.append((at, k, line))
        elif k:
            start = start if block else at
            block.append(line)
            n += k
            if n >= least and (not zlib.crc32(line) % 3 or n >= 3 * least):
                out.append((start, n, b"\n".join(block)))
                block, n = [], 0
        at += k
    if n >= least:
        out.append((start, n, b"\n".join(block)))
    return out


def _paragraph_rows(least: int) -> Callable[[pa.Array], tuple[list[int], list[pa.Array]]]:
    def make(texts: pa.Array) -> tuple[list[int], list[pa.Array]]:
        b, at = text_bytes(texts)
        found = [paragraphs(b[at[k] : at[k + 1]].tobytes(), least) for k in range(len(at) - 1)]
        rows = [r for x in found for r in x]
        return [len(x) for x in found], [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2].decode() for r in rows], pa.string())]

    return make


def repeated_paragraphs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, position (first word), n_words, component_id (document of the kept paragraph), removed.

    The paragraphs are written once, as Parquet, and deleted when their components are known."""
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession)
    paras = _parts(docs, "position bigint, n_words bigint, para string", _paragraph_rows(least))
    paras.write.option("compression", "zstd").parquet(folder)
    paras = spark.read.schema(paras.schema).parquet(folder).select(F.struct("doc_id", "position", "n_words").alias("pid"), "para")
    found = cut(near_duplicates(paras, width=5, percent=80, bands=BANDS, rows=ROWS, key="pid", text="para").select("pid", "component_id").distinct())
    remove_folder(spark, folder)
    gone = found.where("pid <> component_id")
    heads = found.join(gone.select(F.col("component_id").alias("pid")).distinct(), "pid", "left_semi")
    every = gone.withColumn("removed", F.lit(True)).unionByName(heads.withColumn("removed", F.lit(False)))
    return every.select("pid.doc_id", "pid.position", "pid.n_words", F.col("component_id.doc_id").alias("component_id"), "removed")


def repeated_runs(docs: DataFrame, run: int = RUN, gap: int = GAP) -> DataFrame:
    """doc_id, position (first word), n_words, component_id (first document that has most of it), removed.

    All anchors are dealt out by key once. What a key's documents have in common is found where they lie, in the one order of the keys, so
    only anchors of two documents go on, and of these no more than where they stand."""
    s = _parts(docs.where("doc_id is not null"), "first int, more int, again int, key bigint, before bigint, after bigint", _anchor_rows(run))
    same = Window.partitionBy("key")
    hit = s.withColumns({"lo": F.min("doc_id").over(same), "hi": F.max("doc_id").over(same)}).where("lo < hi")
    # The words beside an anchor in its first and last document; a document is compared with those of the two that it is not.
    hit = hit.withColumns({f"at_{d}": F.min(F.when(F.col("doc_id") == F.col(d), F.struct("before", "after"))).over(same) for d in ("lo", "hi")})
    for side in ("before", "after"):
        most = [F.when(F.col("doc_id") != F.col(d), _along(side, f"at_{d}.{side}")).otherwise(0) for d in ("lo", "hi")]
        hit = hit.withColumn(f"more_{side}", F.greatest(*most))
    end = F.col("first") + F.col("more") + WIDE + F.col("more_after")
    hit = hit.select("doc_id", "lo", "first", "again", (F.col("first") - F.col("more_before")).alias("start"), end.alias("end"))
    hit = hit.repartition("doc_id").distinct()  # repeated rows of a document
    w = Window.partitionBy("doc_id").orderBy("start", "end", "lo")
    seen = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    hit = hit.withColumn("new", F.coalesce((F.col("start") - seen > gap).cast("int"), F.lit(1))).withColumn("nth", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = hit.groupBy("doc_id", "nth", "lo").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum(F.col("again") + 1).alias("n"))
    spans = parts.groupBy("doc_id", "nth").agg(F.min("start").alias("position"), F.max("end").alias("end"), F.max(F.struct("n", (-F.col("lo")).alias("lo"))).alias("most"))
    spans = spans.withColumn("component_id", -F.col("most.lo"))
    return spans.where(F.col("end") - F.col("position") >= run).select("doc_id", F.col("position").cast("long").alias("position"), (F.col("end") - F.col("position")).cast("long").alias("n_words"), "component_id", (F.col("component_id") < F.col("doc_id")).alias("removed"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Both kinds, told apart by `kind`."""
    p, r = cut(repeated_paragraphs(docs)), repeated_runs(docs)
    return p.withColumn("kind", F.lit("paragraph")).unionByName(r.withColumn("kind", F.lit("run")))
