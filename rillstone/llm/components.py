"""Connected components of a graph given by its edges, by alternating stars; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def stars(edges: DataFrame) -> DataFrame:
    """``(a, b)`` for every node ``a`` that is not the least of its component, with ``b`` the least one.

    ``edges`` has two integer columns ``a`` and ``b`` in any direction. Nulls and loops are left out; repeated edges do
    no harm. The number of rounds grows with the logarithm of the longest path; each is written to the shared folder.
    """
    now = saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = lambda df: df.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    old, new = None, mark(now)
    while old != new and new[0]:
        now = saved(_small_star(_large_star(now).distinct()).distinct(), "stars")
        old, new = new, mark(now)
    return now
