"""Whitening of vectors by a bidiagonal solver: blockwise QR, Householder bidiagonalisation, dqds, twisted factorisations.

Components c become integers floor(scale * c) + OFFSET, so sums are exact. The centred rows of each task are reduced to a triangle block by
block; triangles are merged FAN at a time until one is left, whose right singular vectors are the eigenvectors of the covariance and whose
squared singular values are n times its eigenvalues. No product of the rows is formed before that. What reaches the driver is bounded by the
length of a vector: sums, FAN triangles at most, and the directions.

Rows whose vector is null or holds null or non-finite entries are dropped, as are vectors of another length than the most frequent one (of
equally frequent ones, the longest) and those with an entry whose integer no long holds. Repeated rows count each for itself; a null id stays null. There
are as many components as a vector has entries, if these are fewer than asked for. A component without variance (of constant entries, too few
distinct rows, or one row) has whitened null and takes no part in identity_error, which is null if there is no other; explained is null
if nothing varies. A deviation that no long holds is null. An empty table, or empty vectors, give an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corundum.llm._spark import counted
from corundum.llm._vectors import commonest_length, finite_rows, matrix
from corundum.llm.bidiagonal import EPS, right_singular

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
#: Triangles that one call merges, and rows that one block adds to a triangle.
FAN, BLOCK = 16, 2048
LONG = 1 << 63


@dataclass
class Whitening:
    n: int
    sums: np.ndarray  # exact integers
    directions: np.ndarray  # a column for each component
    deviations: np.ndarray  # square roots of eigenvalues, 0 where nothing varies
    explained: np.ndarray
    identity_error: float | None = None


def integers(column: pa.Array, scale: int) -> np.ndarray:
    return np.floor(scale * matrix(column)).astype(np.int64) + OFFSET


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exactly: in 64 bits where they suffice, in unbounded integers elsewhere."""
    top = max(int(x.max()), -int(x.min())) if x.size else 0
    if n * top + max(map(abs, sums.tolist()), default=0) < LONG:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def _add_sums(rows: DataFrame, length: int, scale: int) -> tuple[int, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(length, object)
        for b in batches:
            x = integers(b.column(0), scale)
            n += len(x)
            for k in range(0, len(x), 1 << 10):
                part = x[k : k + (1 << 10)]
                small = np.abs(part).max() < 1 << 52
                total += (part if small else part.astype(object)).sum(0)
        at = pa.array(np.arange(length, dtype=np.int32))
        # Sums are handed on in halves, which longs hold for any number of rows.
        high = [int(v) >> 32 for v in total]
        yield pa.RecordBatch.from_arrays([at, pa.array([n] * length, pa.int64()), pa.array(high, pa.int64()), pa.array([int(v) & 0xFFFFFFFF for v in total], pa.int64())], ["at", "n", "high", "low"])

    found = rows.select("v").mapInArrow(run, "at int, n bigint, high bigint, low bigint").groupBy("at").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")]).collect()
    sums = np.zeros(length, object)
    for r in found:
        sums[r["at"]] = (r["high"] << 32) + r["low"]
    return found[0]["n"], sums


def _floats(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return np.asarray(centred(x, n, sums) / n, np.float64)


def _merged(triangle: np.ndarray | None, more: np.ndarray) -> np.ndarray:
    return np.linalg.qr(more if triangle is None else np.vstack([triangle, more]), mode="r")


def triangle(rows: DataFrame, n: int, sums: np.ndarray, scale: int, fan: int = FAN) -> np.ndarray:
    """R of the centred rows: a triangle for each task, merged by trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for b in batches:
            x = integers(b.column(0), scale)
            for k in range(0, len(x), BLOCK):
                r = _merged(r, _floats(x[k : k + BLOCK], n, sums))
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["block", "r"])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        r = None
        for _, raw in sorted(zip(table["block"].to_pylist(), table["r"].to_pylist(), strict=True)):
            r = _merged(r, np.frombuffer(raw, np.float64).reshape(-1, len(sums)))
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    found, (many, _) = counted(rows.select("v").mapInArrow(run, "block bigint, r binary"))
    while many > fan:
        found, (many, _) = counted(found.groupBy(F.floor(F.col("block") / fan).alias("group")).applyInArrow(merge, "block bigint, r binary"))
    r = None
    for row in sorted(found.collect()):  # FAN triangles at most
        r = _merged(r, np.frombuffer(row["r"], np.float64).reshape(-1, len(sums)))
    return np.vstack([r, np.zeros((max(0, len(sums) - len(r)), len(sums)))])


def projected(x: np.ndarray, w: Whitening) -> np.ndarray:
    """Whitened rows; a component without variance is NaN."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(w.deviations > 0, (_floats(x, w.n, w.sums) @ w.directions) / w.deviations, np.nan)


def identity_error(rows: DataFrame, w: Whitening, scale: int) -> float | None:
    """Largest absolute entry of the covariance of the whitened rows, less the identity."""
    live = np.flatnonzero(w.deviations > 0)
    if not len(live):
        return None
    k = len(live)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for b in batches:
            y = projected(integers(b.column(0), scale), w)[:, live]
            y = np.hstack([y, np.ones((len(y), 1))])
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["at", "s"])

    m = np.zeros((k + 1) ** 2)
    for r in rows.select("v").mapInArrow(run, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect():
        m[r["at"]] = r["s"]
    m = m.reshape(k + 1, k + 1) / w.n
    # The rows are centred already; what rounding leaves of their means is taken off.
    return float(np.abs(m[:k, :k] - np.outer(m[:k, k], m[:k, k]) - np.eye(k)).max())


def fit(rows: DataFrame, length: int, components: int = COMPONENTS, scale: int = SCALE) -> Whitening:
    n, sums = _add_sums(rows, length, scale)
    r = triangle(rows, n, sums, scale)
    values, directions = right_singular(r, min(components, length))
    total = float((r * r).sum())
    values = np.where(values > length * EPS * 8 * (values[0] if len(values) else 0), values, 0.0)
    w = Whitening(n, sums, directions, values / np.sqrt(n), values * values / total if total else np.full(len(values), np.nan))
    w.identity_error = identity_error(rows, w, scale)
    return w


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error of every usable row and component."""
    schema = T.StructType([T.StructField("vec_id", vectors.schema[vec_id].dataType)])
    for c, kind in (("component", "integer"), ("n", "long"), ("deviation", "long"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")):
        schema = schema.add(c, kind)
    rows = finite_rows(vectors, embedding, {"id": vec_id})
    rows = rows.where(F.forall("v", lambda x: F.abs(x) * scale + OFFSET < float(LONG)))
    if not (length := commonest_length(rows)):
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("v") == length)
    w = fit(rows, length, components, scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(w.deviations)
        explained = pa.array(w.explained, from_pandas=True)
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                some = b.slice(at, BLOCK)
                x = integers(some.column("v"), scale)
                m = len(x)
                deviation = [int(v) if v < LONG else None for v in _squares(centred(x, w.n, w.sums))]
                ids = some.column("id").take(pa.array(np.repeat(np.arange(m), k)))
                columns = [
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, w.n)),
                    pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(projected(x, w).ravel(), from_pandas=True),
                    explained.take(pa.array(np.tile(np.arange(k), m))),
                    pa.array([w.identity_error] * (m * k), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays([ids, *columns], schema.names)

    return rows.select("id", "v").mapInArrow(run, schema)


def _squares(x: np.ndarray) -> np.ndarray:
    """Row sums of squares, exactly."""
    if x.dtype != object and x.size and float(np.abs(x).max()) ** 2 * x.shape[1] >= LONG / 2:
        x = x.astype(object)
    return (x * x).sum(1)
