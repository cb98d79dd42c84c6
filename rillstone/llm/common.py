"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.session import shared_folder

# Bounds of one Arrow batch, so that a worker's memory does not depend on how many rows a task has.
BATCH_ROWS = 1024
BATCH_BYTES = "16m"

_ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
    "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    "array<float>": pa.list_(pa.float32()), "array<string>": pa.list_(pa.string()),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df`` from a table in the shared folder, so that a lost executor costs no recomputation."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_fixed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is worked out once per row, whatever later filters and expressions make of it.

    A plain column may be put in place of its name, also inside lambdas, when a filter is pushed down. Rows of a
    generator are not.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def fields(ddl: str) -> list[T.StructField]:
    return list(T.StructType.fromDDL(ddl).fields)


def arrow_type(field: T.StructField) -> pa.DataType:
    return _ARROW[field.dataType.simpleString()]


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def add_columns(
    df: DataFrame, used: Sequence[str], ddl: str, work: Callable[..., Sequence[Sequence]], keep: Sequence[str] | None = None
) -> DataFrame:
    """``df`` with the columns of ``ddl``; one of the same name is replaced.

    ``work`` gets the values of the ``used`` columns of a batch as lists and returns a list per new column.
    ``keep`` names the columns that are carried on, all of them by default.
    """
    bounded_batches(df.sparkSession)
    new = fields(ddl)
    names = {f.name.lower() for f in new}
    kept = [f for f in df.schema.fields if f.name.lower() not in names and (keep is None or f.name in keep)]
    read = list(dict.fromkeys([*(f.name for f in kept), *used]))
    types = [arrow_type(f) for f in new]
    carried = [f.name for f in kept]
    labels = carried + [f.name for f in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = work(*[batch.column(read.index(c)).to_pylist() for c in used])
                arrays = [batch.column(read.index(c)) for c in carried]
                arrays += [pa.array(values, kind) for values, kind in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, labels)

    picked = df.select(*[f"`{c}`" for c in read])
    return picked.mapInArrow(run, T.StructType(kept + [T.StructField(f.name, f.dataType) for f in new]))


def emit_rows(df: DataFrame, used: Sequence[str], ddl: str, work: Callable[..., Sequence[Sequence]]) -> DataFrame:
    """Any number of rows for each batch: ``work`` returns a list per column of ``ddl``, all of one length."""
    bounded_batches(df.sparkSession)
    new = fields(ddl)
    types, labels, used = [arrow_type(f) for f in new], [f.name for f in new], list(used)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work(*[batch.column(i).to_pylist() for i in range(len(used))])
            yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(made, types, strict=True)], labels)

    return df.select(*[f"`{c}`" for c in used]).mapInArrow(run, T.StructType(new))
