"""Relational algebra: selection, projection, set operations, joins, grouping, ordering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.operators.joins import HOT_ROWS, rows_with_key_in
from rillstone.operators.ordered import numbered_blocks


def selection(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that satisfy a condition; duplicates stay."""
    return df.filter(condition)


def projection(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of the named columns."""
    return df.select(*columns).distinct()


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).distinct()


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right)


def intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both inputs, each once. Copies are dropped before the inputs meet."""
    return left.distinct().intersect(right.select(*left.columns).distinct())


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of the first input that the second lacks, each once."""
    return left.distinct().subtract(right.select(*left.columns).distinct())


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """All pairs of rows that agree on the shared columns. Adaptive execution splits a skewed key."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError(f"no shared column to join on: {left.columns} and {right.columns}")
    return left.join(right, shared)


def repeated_values(df: DataFrame, column: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows whose value in ``column`` occurs in more than one row; null is a value like any other."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return rows_with_key_in(df, counts.filter(F.col("n") > 1), [column], hot_rows)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``, reduced before the shuffle."""
    first = F.min_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("_first")).select("_first.*")


def mean_by_group(df: DataFrame, condition: Column, key: str, value: str, name: str) -> DataFrame:
    return df.filter(condition).groupBy(key).agg(F.avg(value).alias(name))


def total(df: DataFrame, **columns: Column) -> DataFrame:
    """Aggregates over all rows, one row out."""
    return df.agg(*[c.alias(name) for name, c in columns.items()])


def group_aggregate(df: DataFrame, keys: list[str], **columns: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(name) for name, c in columns.items()])


def group_values(
    df: DataFrame, key: str, value: str, tie: str, block_rows: int = 1000, max_rows: int | None = None
) -> DataFrame:
    """Values of each key in sorted order, as ``(key, block, values)`` with at most ``block_rows`` per row.

    Blocks in order are the whole list; a key with few values has the single block 0. ``tie`` makes
    the order of equal values definite. Null values are left out; a key that has no others keeps one empty block.
    """
    slim = df.select(key, value, tie).filter(F.col(value).isNotNull())
    blocks = numbered_blocks(slim, [key], [value, tie], block_rows, max_rows)
    lists = blocks.groupBy(key, "block").agg(F.array_sort(F.collect_list(value)).alias("values"))
    empty = df.groupBy(key).agg(F.count(value).alias("_n")).filter("_n = 0")
    kind = lists.schema["values"].dataType
    return lists.unionByName(empty.select(key, F.lit(0).cast("bigint").alias("block"), F.array().cast(kind).alias("values")))


def partition_sorted(df: DataFrame, key: str, order: list[str], partitions: int | None = None) -> DataFrame:
    """Hash partitions by key, each one sorted, as many as Spark's shuffle partitions unless told.

    ``partition_id`` is the number of the partition and ``place`` grows with the rows of a partition.
    """
    spread = df.repartition(partitions, key) if partitions else df.repartition(F.col(key))
    placed = spread.sortWithinPartitions(key, *order)
    return placed.withColumn("partition_id", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id())


def range_sort(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """A total order over range partitions; trailing tie columns let a frequent value span several.

    ``place`` grows from row to row through all partitions.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())


def increment(df: DataFrame, column: str) -> DataFrame:
    """``column + 1``. Raises on 64-bit overflow under ANSI rules."""
    return df.select((F.col(column) + F.lit(1)).alias(column))
