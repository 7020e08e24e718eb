"""Compression of vectors into codes of parts by Lloyd's method, with trees over the parts of a block and over a codebook's entries.

A vector is cut into equal consecutive parts; each position has a codebook. To assign the parts of a block of vectors, a tree of
bounding boxes is laid over the block's parts of each position, another over the position's entries. Pairs of nodes are refined
together, level by level: a pair whose least distance is above what another pair guarantees its part node at most is dropped, as no part below it
can be nearest there. A part node that is left with one entry is assigned as a whole, by its cached count and sums. What is uncertain
at the leaves is decided by exact integer distances, ties to the lower index. All levels, positions and nodes of a block are handled in
a few array operations each. Components are floor(scale * x), so every bound, distance, sum and mean is an exact integer.

Blocks are assigned by themselves and give a count and sums for each entry; Spark adds these up, and only the codebooks
(positions x entries) reach the driver.

Rows whose vector is null or holds null or non-finite components are dropped, as are vectors of another length than the most frequent one (of
equally frequent ones, the longest). The first codebooks take the vectors of the smallest ids (null ids last, equal ids by their vectors); with fewer vectors
than entries, codebooks are as short; equal entries give their parts to the first, and entries without parts stay. Repeated rows are coded
each for itself. A length that isn't a multiple of `parts` raises ValueError. Components beyond 2**28 are computed with unbounded integers; an error that no long
can hold becomes null. An empty table gives an empty result; only the named columns are read, so that others change nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corundum.llm._spark import cut, small
from corundum.llm._vectors import commonest_length, finite_rows, matrix

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors of a block, and parts of a leaf of its trees.
BLOCK, LEAF = 8192, 4
#: Components up to this size keep squared distances of a few parts within 64 bits.
WIDE = 1 << 28


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, or as unbounded ones where some are large."""
    y = np.floor(scale * x)
    if y.size and np.abs(y).max() >= WIDE:
        return np.array([[int(np.floor(v)) if np.isfinite(v) else int(scale) * int(w) for v, w in zip(r, s, strict=True)] for r, s in zip(y, x, strict=True)], object)
    return y.astype(np.int64)


@dataclass
class Tree:
    """Boxes over points of several positions, as complete binary trees: level l has 2**l nodes, low[l] and high[l] are (positions, 2**l, width)."""

    order: np.ndarray  # (positions, slots): point of each slot, leaf by leaf; the last ones repeat the last point and don't count
    low: list[np.ndarray]
    high: list[np.ndarray]
    leaf: int


def build(points: np.ndarray, leaf: int) -> Tree:
    """points: (positions, n, width). Each node is halved at the median of its widest side."""
    positions, n, width = points.shape
    depth = max(0, int(np.ceil(np.log2(max(1, n / leaf)))))
    size = -(-n // (1 << depth)) << depth
    order = np.broadcast_to(np.minimum(np.arange(size), n - 1), (positions, size)).copy()
    at = np.arange(positions)[:, None]
    low, high = [], []
    for level in range(depth + 1):
        nodes = points[at, order].reshape(positions, 1 << level, size >> level, width)
        low.append(nodes.min(2))
        high.append(nodes.max(2))
        if level < depth:
            side = (high[-1] - low[-1]).argmax(2)
            key = np.take_along_axis(nodes, side[:, :, None, None].astype(np.int64), 3)[..., 0]
            inner = key.argsort(2, kind="stable")
            order = np.take_along_axis(order.reshape(positions, 1 << level, -1), inner, 2).reshape(positions, size)
    return Tree(order, low, high, size >> depth)


def _least_by(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The least value of each run of equal, sorted groups, for every row."""
    first = np.flatnonzero(np.diff(group, prepend=-1))
    return np.repeat(np.minimum.reduceat(value, first), np.diff([*first, len(group)]))


def assign(points: np.ndarray, books: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, dict[str, int]]:
    """Nearest entry of every point: points (positions, n, width) and books (positions, entries, width), integers, to (positions, n).

    Also counts how many points were assigned with their node, and how many distances were computed."""
    positions, n, _ = points.shape
    data, own = build(points, leaf), build(books, 1)
    entry = own.order  # of each leaf slot
    spare = np.zeros(entry.shape, bool)
    spare[:, 1:] = entry[:, 1:] == entry[:, :-1]  # slots that repeat an entry to complete the tree
    out = np.full((positions, data.order.shape[1]), -1, np.int64)
    p, a, b = np.arange(positions), np.zeros(positions, np.int64), np.zeros(positions, np.int64)
    la = lb = 0
    stats = {"whole": 0, "distances": 0}
    while True:
        gap = np.maximum(np.maximum(data.low[la][p, a] - own.high[lb][p, b], own.low[lb][p, b] - data.high[la][p, a]), 0)
        far = np.maximum(data.high[la][p, a] - own.low[lb][p, b], own.high[lb][p, b] - data.low[la][p, a])
        group = p * (1 << la) + a
        keep = (gap * gap).sum(1) <= _least_by(group, (far * far).sum(1))
        p, a, b, group = p[keep], a[keep], b[keep], group[keep]
        if lb == len(own.low) - 1:
            first = np.flatnonzero(np.diff(group, prepend=-1))
            alone = np.repeat(np.diff([*first, len(group)]) == 1, np.diff([*first, len(group)]))
            width = data.order.shape[1] >> la
            slots = a[alone, None] * width + np.arange(width)
            out[p[alone, None], slots] = entry[p[alone], b[alone]][:, None]
            stats["whole"] += slots.size
            p, a, b = p[~alone], a[~alone], b[~alone]
        if not len(p) or (la == len(data.low) - 1 and lb == len(own.low) - 1):
            break
        if la < len(data.low) - 1:
            la, p, a, b = la + 1, np.repeat(p, 2), (2 * a[:, None] + np.arange(2)).ravel(), np.repeat(b, 2)
        if lb < len(own.low) - 1:
            lb, p, a, b = lb + 1, np.repeat(p, 2), np.repeat(a, 2), (2 * b[:, None] + np.arange(2)).ravel()
            if lb == len(own.low) - 1:
                some = ~spare[p, b]
                p, a, b = p[some], a[some], b[some]
        if len(p):
            sort = (p * (1 << la) + a).argsort(kind="stable")
            p, a, b = p[sort], a[sort], b[sort]
    if len(p):
        e = entry[p, b]
        sort = ((p * (1 << la) + a) * books.shape[1] + e).argsort(kind="stable")
        p, a, e = p[sort], a[sort], e[sort]
        width = data.order.shape[1] >> la
        slots = a[:, None] * width + np.arange(width)
        d = points[p[:, None], data.order[p[:, None], slots]] - books[p, e][:, None]
        d = (d * d).sum(2)
        stats["distances"] += d.size
        group = p * (1 << la) + a
        first = np.flatnonzero(np.diff(group, prepend=-1))
        least = np.minimum.reduceat(d, first)
        # The first row of a group that has the least distance has the lowest index.
        which = np.repeat(np.arange(len(first)), np.diff([*first, len(group)]))
        rank = np.where(d == least[which], np.arange(len(d))[:, None], len(d))
        out[p[first][:, None], slots[first]] = e[np.minimum.reduceat(rank, first).astype(np.int64)]
    found = np.empty((positions, n), np.int64)
    found[np.arange(positions)[:, None], data.order] = out
    return found, stats


def _cut_parts(x: np.ndarray, parts: int) -> np.ndarray:
    return np.ascontiguousarray(x.reshape(len(x), parts, -1).transpose(1, 0, 2))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = -(-batch.num_rows // BLOCK)
        for k in range(n):
            at = k * batch.num_rows // n
            yield batch.slice(at, (k + 1) * batch.num_rows // n - at)


def _sums(rows: DataFrame, books: np.ndarray, scale: int) -> np.ndarray:
    """(positions, entries, 1 + width): count and component sums of the parts that each entry is nearest to."""
    parts, entries, width = books.shape
    schema = ", ".join(["cell int", "n bigint", *(f"s{k} decimal(38,0)" for k in range(width))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), object)
        for b in _blocks(batches):
            x = _cut_parts(whole(matrix(b.column(0)), scale), parts)
            cell = assign(x, books)[0] + np.arange(parts)[:, None] * entries
            n += np.bincount(cell.ravel(), minlength=parts * entries)
            s = np.zeros((parts * entries, width), x.dtype)
            np.add.at(s, cell.ravel(), x.reshape(-1, width))
            total += s
        used = np.flatnonzero(n)
        sums = [pa.array([Decimal(int(v)) for v in total[used, k]], pa.decimal128(38, 0)) for k in range(width)]
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used]), *sums], ["cell", "n", *(f"s{k}" for k in range(width))])

    found = rows.select("v").mapInArrow(run, schema).groupBy("cell").agg(F.sum("n").alias("n"), *[F.sum(f"s{k}").alias(f"s{k}") for k in range(width)])
    out = np.zeros((parts * entries, 1 + width), object)
    for r in found.collect():  # parts x entries rows at most
        out[r["cell"]] = [int(v) for v in r[1:]]
    return out.reshape(parts, entries, 1 + width)


def fit(rows: DataFrame, vec_id: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray:
    """Codebooks (positions, entries, width) of `rows`, which has an id and a vector `v` of finite doubles of one length."""
    first = rows.orderBy(F.col(vec_id).asc_nulls_last(), "v").limit(entries).collect()
    x = np.array([r["v"] for r in first], np.float64)
    if x.shape[1] % parts or not x.shape[1]:
        raise ValueError(f"vectors of {x.shape[1]} components can't be cut into {parts} equal parts")
    books = _cut_parts(whole(x, scale), parts)
    for _ in range(rounds):
        found = _sums(rows, books, scale)
        n, s = found[:, :, 0], found[:, :, 1:]
        used = n > 0
        means = books.astype(object)
        means[used] = s[used] // n[used][:, None]
        books = means if np.abs(means).max() >= WIDE else means.astype(np.int64)
    return books


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in books.ravel()).encode()).hexdigest()


def encode(rows: DataFrame, books: np.ndarray, columns: list[str], scale: int = SCALE) -> DataFrame:
    """The named columns of each row, with code (a byte for each part) and error (sum of squared distances)."""
    parts = len(books)
    schema = T.StructType([*(rows.schema[c] for c in columns), T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            x = _cut_parts(whole(matrix(b.column("v")), scale), parts)
            code = assign(x, books)[0]
            d = x - books[np.arange(parts)[:, None], code]
            error = (d * d).sum(2).sum(0)
            codes = pa.array([c.tobytes() for c in code.T.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), codes, pa.array([int(e) if e < 1 << 63 else None for e in error], pa.int64())], [*columns, "code", "error"])

    return rows.select(*columns, "v").mapInArrow(run, schema)


def compress(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code (two hexadecimal digits a part), error, label_error and codebooks_sha256 of every usable row."""
    if entries > 256:
        raise ValueError("an index has two hexadecimal digits")
    rows = finite_rows(vectors, embedding, {"id": vec_id, "label": label})
    length = commonest_length(rows)
    if length is None:
        kind = vectors.schema[vec_id].dataType
        return vectors.sparkSession.createDataFrame([], T.StructType([T.StructField("vec_id", kind)]).add("code", "string").add("error", "long").add("label_error", "long").add("codebooks_sha256", "string"))
    rows = rows.where(F.size("v") == length)
    books = fit(rows, "id", parts, entries, rounds)
    coded = cut(encode(rows, books, ["id", "label"]))
    by_label = small(coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error")))
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("same")))
    return joined.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
