"""Sinks for micro-batches: a log of changes to a result that is kept up to date, and one sink for each tag.

Both write folders of a batch, so that a batch that is run again after a failure leaves each row once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.streaming.steered import drop_folder

INSERT, BEFORE, AFTER, DELETE = "+I", "-U", "+U", "-D"


@dataclass
class ChangeLog:
    """A ``foreachBatch`` function for the update-mode rows of an aggregate: one row for each row that comes or goes.

    A result row is shown while ``shown`` holds. A first sight is ``+I``, a change a pair of ``-U`` (the row as it was) and
    ``+U``, and a row that is no longer shown ``-D``. What is shown after a batch is kept as the ``image`` of the batch, dealt
    by key into ``parts``; only parts with new rows are written anew.
    """

    home: str
    keys: list[str]
    schema: str
    shown: Callable[[], Column] = lambda: F.lit(True)
    parts: int = 16

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark, names = batch.sparkSession, batch.columns
        values = [c for c in names if c not in self.keys]
        part = F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")
        batch.withColumn("_part", part).repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(f"{self.home}/rows/{number}")
        rows = self._read(spark, f"rows/{number}", ", _part INT")
        touched = [r[0] for r in rows.select("_part").distinct().collect()]  # at most ``parts``
        before = self._image(spark, number - 1).filter(F.col("_part").isin(touched))
        old = before.select(*[F.col(c).alias(f"_k_{c}") for c in self.keys], "_part", F.struct(*names).alias("_old"))
        new = rows.select(*self.keys, "_part", F.struct(*names).alias("_new"), F.coalesce(self.shown(), F.lit(False)).alias("_shown"))
        same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in self.keys]
        met = new.join(old.drop("_part"), same, "left")
        changed = F.lit(False)
        for c in values:
            changed = changed | ~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
        was, event = F.col("_old").isNotNull(), lambda change, row: F.struct(F.lit(change).alias("change"), F.col(row).alias("r"))
        events = (
            F.when(~was & F.col("_shown"), F.array(event(INSERT, "_new")))
            .when(was & ~F.col("_shown"), F.array(event(DELETE, "_old")))
            .when(was & changed, F.array(event(BEFORE, "_old"), event(AFTER, "_new")))
            .otherwise(F.array().cast(f"array<struct<change: string, r: {new.schema['_new'].dataType.simpleString()}>>"))
        )
        log = met.select(F.inline(events)).select("change", "r.*")
        log.write.mode("overwrite").parquet(f"{self.home}/log/batch={number}")
        gone = new.select(*[F.col(c).alias(f"_n_{c}") for c in self.keys])
        stay = before.join(gone, [F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in self.keys], "left_anti")
        now = stay.unionByName(new.filter("_shown").select("_new.*", "_part"))
        now.repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(f"{self.home}/image/{number}")
        drop_folder(spark, f"{self.home}/rows/{number}")
        kept = {p: n for p, n in self._places(spark, number - 1).items() if p not in touched} | dict.fromkeys(touched, number)
        places = spark.createDataFrame([*kept.items()], "part INT, number BIGINT")
        places.coalesce(1).write.mode("overwrite").parquet(f"{self.home}/places/{number}")
        for p, n in self._places(spark, number - 2).items():
            if kept.get(p) != n and self._places(spark, number - 1).get(p) != n:
                drop_folder(spark, f"{self.home}/image/{n}/_part={p}")

    def _read(self, spark: SparkSession, folder: str, more: str = "") -> DataFrame:
        return spark.read.schema(self.schema + more).parquet(f"{self.home}/{folder}")

    def _places(self, spark: SparkSession, number: int) -> dict[int, int]:
        """The batch that has last written each part of the image, as of a batch."""
        if number < 0:
            return {}
        return {r.part: r.number for r in spark.read.parquet(f"{self.home}/places/{number}").collect()}

    def _image(self, spark: SparkSession, number: int) -> DataFrame:
        out = spark.createDataFrame([], f"{self.schema}, _part INT")
        by: dict[int, list[int]] = {}
        for p, n in self._places(spark, number).items():
            by.setdefault(n, []).append(p)
        for n, parts in by.items():
            out = out.unionByName(self._read(spark, f"image/{n}", ", _part INT").filter(F.col("_part").isin(parts)))
        return out

    def log(self, spark: SparkSession) -> DataFrame:
        """All changes with their ``batch``."""
        return spark.read.schema(f"change STRING, {self.schema}, batch BIGINT").parquet(f"{self.home}/log")

    def image(self, spark: SparkSession, number: int) -> DataFrame:
        return self._image(spark, number).drop("_part")


def folded(log: DataFrame, keys: list[str]) -> DataFrame:
    """The result that a log of changes leads to: the newest row of every key that is still shown."""
    names = [c for c in log.columns if c not in ("change", "batch")]
    newest = F.max_by(F.struct("change", F.struct(*names).alias("r")), F.struct("batch", F.col("change").isin(INSERT, AFTER)))
    return log.groupBy(*keys).agg(newest.alias("_n")).filter(F.col("_n.change") != DELETE).select("_n.r.*")


@dataclass
class TaggedSinks:
    """A ``foreachBatch`` function that splits rows by ``output_tag`` into a folder for each tag.

    A folder of a batch is complete once its writer has left its mark; the attempt after a failure skips those and writes
    the others. Rows of a tag without a folder go to ``rest``; without one, such a row is an error.
    """

    folders: dict[str, str]
    rest: str | None = None
    tag: str = "output_tag"

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            known = F.coalesce(F.col(self.tag).isin(*self.folders), F.lit(False))
            if self.rest is None and not batch.filter(~known).isEmpty():
                raise ValueError(f"a row has a tag without a sink: {batch.filter(~known).first()[self.tag]}")
            for tag, folder in self.folders.items():
                self.write(batch.filter(F.col(self.tag) == tag).drop(self.tag), folder, number, spark)
            if self.rest is not None:
                self.write(batch.filter(~known), self.rest, number, spark)
        finally:
            batch.unpersist()

    def write(self, rows: DataFrame, folder: str, number: int, spark: SparkSession) -> None:
        mark = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch={number}/_SUCCESS")
        if not mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
            rows.write.mode("overwrite").parquet(f"{folder}/batch={number}")
