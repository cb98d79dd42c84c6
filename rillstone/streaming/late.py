"""Late rows told apart inside a stream and counted by the clock of their micro-batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.operators.events import mark_late


@dataclass
class LateRows:
    """A ``foreachBatch`` function: rows at or behind the newest earlier event time less ``delay`` are late.

    ``arrival`` orders the rows of a batch as they came; what earlier batches saw is one row, written per batch. Late rows go
    to ``late``, their number per window of processing time to ``counts``.
    """

    home: str
    ts: str
    delay: str
    arrival: tuple[str, ...]
    window: str = "1 second"
    max_rows: int | None = None

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        newest = spark.read.parquet(f"{self.home}/newest/{number - 1}").first()["newest"] if number else None
        before = None if newest is None else F.timestamp_micros(F.lit(newest))
        marked = mark_late(batch, self.ts, list(self.arrival), self.delay, self.max_rows, before)
        late = marked.filter("is_late").drop("is_late").withColumn("seen_at", F.current_timestamp())
        late.write.mode("overwrite").parquet(f"{self.home}/late/batch={number}")
        found = spark.read.schema(late.schema).parquet(f"{self.home}/late/batch={number}")
        counts = found.groupBy(F.window("seen_at", self.window).alias("w")).agg(F.count(F.lit(1)).alias("cnt"))
        counts.select(F.lit("LATE").alias("tag"), "cnt", F.col("w.end").alias("at")).write.mode("overwrite").parquet(f"{self.home}/counts/batch={number}")
        top = batch.agg(F.unix_micros(F.max(self.ts))).first()[0]
        newest = max((t for t in (newest, top) if t is not None), default=None)
        spark.createDataFrame([(newest,)], "newest BIGINT").coalesce(1).write.mode("overwrite").parquet(f"{self.home}/newest/{number}")

    def counts(self, spark: SparkSession) -> DataFrame:
        """Late rows per window of processing time; batches that share a window are added up."""
        read = spark.read.schema("tag STRING, cnt BIGINT, at TIMESTAMP, batch BIGINT").parquet(f"{self.home}/counts")
        return read.groupBy("tag", "at").agg(F.sum("cnt").alias("cnt"))
