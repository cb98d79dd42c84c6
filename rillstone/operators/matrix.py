"""Sparse matrices as relations ``(i, j, v)`` and ``(j, k, w)``; vectors as ``(index, value)``.

Sums are linear, so repeated coordinates may meet the other side one by one. Only a vector or matrix that is looked up
is added up first, so that it is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_SIDE_ROWS = 100_000


def _compact(df: DataFrame, coordinates: list[str], value: str) -> DataFrame:
    return df.groupBy(*coordinates).agg(F.sum(value).alias(value))


def _hint_if_small(df: DataFrame, limit: int) -> DataFrame:
    """Broadcast hint when at most ``limit`` rows exist, else leave the join to the optimizer."""
    counted = df.limit(limit + 1).agg(F.count(F.lit(1))).collect()[0][0]
    return F.broadcast(df) if counted <= limit else df


def matrix_vector(matrix: DataFrame, vector: DataFrame) -> DataFrame:
    """``A x``: every matrix row is kept; a missing vector entry counts as zero."""
    x = _compact(vector, ["index"], "value")
    joined = matrix.join(x, F.col("j") == F.col("index"), "left")
    return joined.groupBy("i").agg(F.sum(F.col("v") * F.coalesce("value", F.lit(0.0))).alias("value"))


def matrix_vector_in_memory(matrix: DataFrame, vector: DataFrame, limit: int = SMALL_SIDE_ROWS) -> DataFrame:
    """``A x`` with the vector on every executor when it is small enough; the matrix does not move."""
    x = _hint_if_small(_compact(vector, ["index"], "value"), limit)
    joined = matrix.join(x, F.col("j") == F.col("index"), "left")
    return joined.groupBy("i").agg(F.sum(F.col("v") * F.coalesce("value", F.lit(0.0))).alias("value"))


def matrix_product(m: DataFrame, n: DataFrame) -> DataFrame:
    """``M N`` with both sides as relations."""
    joined = m.join(n, "j")
    return joined.groupBy("i", "k").agg(F.sum(F.col("v") * F.col("w")).alias("value"))


def matrix_product_in_memory(m: DataFrame, n: DataFrame, limit: int = SMALL_SIDE_ROWS) -> DataFrame:
    """``M N`` with ``N`` on every executor when it is small enough."""
    joined = m.join(_hint_if_small(_compact(n, ["j", "k"], "w"), limit), "j")
    return joined.groupBy("i", "k").agg(F.sum(F.col("v") * F.col("w")).alias("value"))
