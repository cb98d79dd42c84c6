"""User map, combine and reduce functions on pandas batches, for logic that columns cannot express."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PandasFn = Callable[[pd.DataFrame], pd.DataFrame]


def map_reduce(
    df: DataFrame,
    map_fn: PandasFn,
    combine_fn: PandasFn,
    reduce_fn: PandasFn,
    keys: list[str],
    map_schema: str,
    reduce_schema: str,
    spread: int | None = None,
) -> DataFrame:
    """``map_fn`` per batch, ``combine_fn`` per batch and per part of a key, ``reduce_fn`` per key.

    ``combine_fn`` takes and returns rows of ``map_schema`` and may run any number of times; it
    leaves few rows per key. A frequent key is combined in ``spread`` parts before its reduce, by default about the square
    root of the number of shuffle partitions, so that neither a part nor the reduce meets more than so many batches' worth of rows.
    """

    def map_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield combine_fn(map_fn(batch))

    mapped = df.mapInPandas(map_batches, map_schema)
    spread = spread or max(1, isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    parts = mapped.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(spread)))
    combined = parts.groupBy(*keys, "_part").applyInPandas(
        lambda pdf: combine_fn(pdf.drop(columns="_part")), map_schema
    )
    return combined.groupBy(*keys).applyInPandas(reduce_fn, reduce_schema)
