"""Running values over ordered groups, safe when one group holds a large part of all rows.

A plain window sends a whole group to one task. Here the rows are dealt once into ranges of (group, order), so that a
group of any size takes as many ranges as its share of the rows. They are written to shared storage with the number of
their range. The window runs per group and range; what the earlier ranges of a group add up to comes from a carry table.
Only the first and last group of a range can reach into another one, so that table has at most two rows per range.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.session import shared_folder

_SLICE = "_slice"


@dataclass(frozen=True)
class Sliced:
    """Rows with the number of their range in ``_slice``; ``worked`` tells that they hold running values already."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    worked: bool = False

    def with_column(self, name: str, value: Column) -> "Sliced":
        return replace(self, df=self.df.withColumn(name, value))

    def filter(self, condition: Column) -> "Sliced":
        return replace(self, df=self.df.filter(condition))

    def rows(self) -> DataFrame:
        return self.df.drop(_SLICE)


def slice_groups(df: DataFrame, keys: list[str], order: list[str], max_rows: int | None = None) -> Sliced:
    """Deal the rows into ranges and write them down.

    ``order`` lists ascending, non-null columns that make the order total. The number of ranges is that of Spark's
    shuffle partitions; with ``max_rows`` the rows are counted and each range has about so many.
    """
    position = list(dict.fromkeys([*keys, *order]))
    if max_rows is None:
        ranged = df.repartitionByRange(*position)
    else:
        ranged = df.repartitionByRange(max(1, -(-df.count() // max_rows)), *position)
    return Sliced(_written(ranged.withColumn(_SLICE, F.spark_partition_id())), tuple(keys), tuple(order))


def _written(df: DataFrame) -> DataFrame:
    path = shared_folder(df.sparkSession, "ranges")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_TOTALS = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def _same_group(keys: tuple[str, ...], prefix: str) -> list[Column]:
    """Equality of the group columns with their prefixed copies; null keys are a group."""
    return [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys]


def running(
    sliced: Sliced, values: dict[str, tuple[str, Column]], inclusive: bool = True, reverse: bool = False
) -> Sliced:
    """Add one running column per entry ``name -> (kind, value)``.

    Kinds: ``sum count min max last`` (``last`` skips nulls; with ``reverse`` it is the next value).
    Without ``inclusive`` the current row is left out.
    """
    if sliced.worked:  # rows and carry are read apart, so earlier windows would run for each
        sliced = replace(sliced, df=_written(sliced.df), worked=False)
    direction = [F.col(c).desc() if reverse else F.col(c).asc() for c in sliced.order]
    end = 0 if inclusive else -1
    w = Window.partitionBy(*sliced.keys, _SLICE).orderBy(*direction).rowsBetween(Window.unboundedPreceding, end)
    local = {}
    for name, (kind, value) in values.items():
        local[f"_l_{name}"] = F.last(value, ignorenulls=True).over(w) if kind == "last" else _TOTALS[kind](value).over(w)
    # At most two rows per range.
    carry = F.broadcast(_carry(sliced, values, reverse))
    on = [*_same_group(sliced.keys, "_c_"), F.col(_SLICE) == F.col("_c_slice")]
    out = sliced.df.withColumns(local).join(carry, on, "left")
    for name, (kind, _) in values.items():
        here, before = F.col(f"_l_{name}"), F.col(f"_c_{name}")
        if kind == "count":
            value = here + F.coalesce(before, F.lit(0))
        elif kind == "sum":
            value = F.when(here.isNull(), before).otherwise(here + F.coalesce(before, F.lit(0)))
        elif kind == "last":
            value = F.coalesce(here, before)
        else:
            value = F.least(here, before) if kind == "min" else F.greatest(here, before)
        out = out.withColumn(name, value)
    helpers = [f"_l_{n}" for n in values] + [f"_c_{n}" for n in values] + [f"_c_{k}" for k in sliced.keys] + ["_c_slice"]
    return replace(sliced, df=out.drop(*helpers), worked=True)


def _spanning(sliced: Sliced) -> DataFrame:
    """The groups that lie in more than one range, key columns prefixed with ``_s_``; at most one per range."""
    pairs = sliced.df.select(*sliced.keys, _SLICE).distinct()
    ranges = pairs.groupBy(*sliced.keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return ranges.select(*[F.col(k).alias(f"_s_{k}") for k in sliced.keys])


def _carry(sliced: Sliced, values: dict[str, tuple[str, Column]], reverse: bool) -> DataFrame:
    """What all earlier ranges of a group add up to; one row per range of a group that has several."""
    keys = list(sliced.keys)
    position = F.struct(*sliced.order)
    totals = []
    for name, (kind, value) in values.items():
        if kind == "last":
            pick = F.min_by if reverse else F.max_by
            total = pick(F.when(value.isNotNull(), value), F.when(value.isNotNull(), position))
        else:
            total = _TOTALS[kind](value)
        totals.append(total.alias(name))
    rows = sliced.df
    if keys:
        rows = rows.join(F.broadcast(_spanning(sliced)), _same_group(sliced.keys, "_s_"), "left_semi")
    per_slice = rows.groupBy(*keys, _SLICE).agg(*totals)
    direction = F.col(_SLICE).desc() if reverse else F.col(_SLICE).asc()
    before = Window.partitionBy(*keys).orderBy(direction).rowsBetween(Window.unboundedPreceding, -1)
    columns = [F.col(k).alias(f"_c_{k}") for k in keys] + [F.col(_SLICE).alias("_c_slice")]
    for name, (kind, _) in values.items():
        if kind == "last":
            value = F.last(name, ignorenulls=True).over(before)
        elif kind == "count":
            value = F.sum(name).over(before)
        else:
            value = _TOTALS[kind](F.col(name)).over(before)
        columns.append(value.alias(f"_c_{name}"))
    return per_slice.select(*columns)


def numbered_blocks(df: DataFrame, keys: list[str], order: list[str], size: int, max_rows: int | None = None) -> DataFrame:
    """Add ``block``: 0 for the first ``size`` rows of a group, 1 for the next ones, and so on."""
    counted = running(slice_groups(df, keys, order, max_rows), {"_pos": ("count", F.lit(1))})
    return counted.rows().withColumn("block", F.floor((F.col("_pos") - 1) / size).cast("bigint")).drop("_pos")
