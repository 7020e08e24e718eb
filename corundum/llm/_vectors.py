"""Columns of vectors for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite_rows(vectors: DataFrame, embedding: str, columns: dict[str, str]) -> DataFrame:
    """The rows whose vector is not null and has finite components alone: `columns` (new name: old name) and the vector `v` as doubles."""
    v = F.col(f"`{embedding}`").cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vectors.where(v.isNotNull() & ~odd).select(*[F.col(f"`{c}`").alias(n) for n, c in columns.items()], v.alias("v"))


def commonest_length(rows: DataFrame) -> int | None:
    """The most frequent length of the vectors `v`, the longest of equally frequent ones; None without a row. A row a length is sorted."""
    found = rows.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("length")).limit(1).collect()
    return found[0]["length"] if found else None


def matrix(column: pa.Array) -> np.ndarray:
    """A batch of vectors of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
