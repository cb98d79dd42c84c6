"""Running a streaming query over everything that is available, into a table on shared storage.

A bounded replay never moves the watermark past its own last events. A run therefore has two
steps on one checkpoint: first the data, then one far-future row per input that lets windows close,
joins give up waiting and timers fire. Operators never see the difference.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.session import prepare, shared_folder
from rillstone.streaming.steered import Steered, merged
from rillstone.streaming.steps import OrderedSteps, Step

FLUSH_TIME = datetime(2100, 1, 1, tzinfo=timezone.utc)
# A replay in steps has at least so many, and more when a core would have more rows in a step than this.
STEPS = 4
CORE_ROWS = 4_000_000
# Rows of a file, so that all cores read a step.
FILE_ROWS = 1_000_000


def table_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """A warehouse table, one file or a folder of files, as a stream of its files."""
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder}/{name}.parque[t]")


def steps_for(spark: SparkSession, rows: int) -> int:
    """How many steps a replay of so many rows has.

    Every micro-batch goes over all of the state, so their number follows the rows that each core gets, not the table.
    """
    return max(STEPS, -(-rows // (CORE_ROWS * spark.sparkContext.defaultParallelism)))


def stepped_stream(df: DataFrame, order: str, home: str, steps: int | None = None) -> DataFrame:
    """A table as a stream of steps that follow each other in ``order`` (a time), one per micro-batch.

    The rows are written once, in ranges of about equal size, several files to a step of a large table; a time that many
    rows share takes several of them. Rows without a time come last.
    """
    spark, n = df.sparkSession, df.count()
    steps = steps or steps_for(spark, n)
    files = max(1, -(-n // (steps * FILE_ROWS)))
    ranged = df.repartitionByRange(steps * files, F.col(order).asc_nulls_last(), F.xxhash64(*df.columns))
    ranged.write.mode("overwrite").parquet(home)
    _aged_by_name(spark, home)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(home)


def _aged_by_name(spark: SparkSession, folder: str) -> None:
    """Give the files of a folder ages in the order of their names, by which a file stream reads them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    paths = sorted((f.getPath() for f in fs.listStatus(at) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    for k, path in enumerate(paths):
        fs.setTimes(path, 1_000_000_000_000 + 1000 * k, -1)


@dataclass
class Replay:
    """Input streams with their flush rows, and the home of checkpoint and output."""

    spark: SparkSession
    name: str
    home: str = ""
    flushes: list[tuple[str, DataFrame]] = field(default_factory=list)
    sources: int = 0
    step_count: int | None = None

    def __post_init__(self):
        prepare(self.spark)
        self.home = self.home or shared_folder(self.spark, f"stream-{self.name}")

    def flushed(self, stream: DataFrame, rows: list[tuple]) -> DataFrame:
        """The stream together with rows that arrive once all of its data has been read."""
        flush = self.spark.createDataFrame(rows, stream.schema)
        folder = f"{self.home}/flush-{len(self.flushes)}"
        flush.limit(0).write.mode("overwrite").parquet(folder)
        self.flushes.append((folder, flush))
        return stream.unionByName(self.spark.readStream.schema(stream.schema).parquet(folder))

    def _run(self, start: Callable) -> None:
        with _stream_partitions(self.spark):
            start().awaitTermination()
            for folder, flush in self.flushes:
                flush.coalesce(1).write.mode("append").parquet(folder)
            if self.flushes:
                start().awaitTermination()

    def to_table(self, result: DataFrame) -> DataFrame:
        """Append-mode result as a table; each row is written once."""
        out = f"{self.home}/table"

        def start():
            writer = result.writeStream.format("parquet").outputMode("append").option("path", out)
            return writer.option("checkpointLocation", f"{self.home}/checkpoint").trigger(availableNow=True).start()

        self._run(start)
        return self.spark.read.schema(result.schema).parquet(out)

    def stepped(self, df: DataFrame, order: str) -> DataFrame:
        """The table as a stream in ``order`` (see :func:`stepped_stream`).

        All sources of a replay have as many steps as the first, so that none runs ahead and fills the state.
        """
        self.sources += 1
        self.step_count = self.step_count or steps_for(self.spark, df.count())
        return stepped_stream(df, order, f"{self.home}/source-{self.sources}", self.step_count)

    def steered(
        self, df: DataFrame, order: str, messages: list[tuple[datetime, str]], fold: Callable[[str], Steered]
    ) -> DataFrame:
        """Answers of a steered query over the table as a stream; a message arrives after the rows up to its (UTC) time.

        The rows are written once, by the stretch between two messages. Each arrival is a run of its own on the same
        checkpoint.
        """
        spark, source, talk = self.spark, f"{self.home}/events", f"{self.home}/messages"
        times = sorted({t.replace(tzinfo=timezone.utc) for t, _ in messages})
        stretch = F.coalesce(sum((F.col(order) > F.lit(t)).cast("int") for t in times), F.lit(len(times)))
        staged = df.withColumn("_stretch", stretch).repartitionByRange("_stretch", order, F.xxhash64(*df.columns))
        staged.write.partitionBy("_stretch").parquet(f"{self.home}/staged")
        staged = spark.read.schema(staged.schema).parquet(f"{self.home}/staged")
        df.limit(0).write.parquet(source)
        spark.createDataFrame([], "value STRING").write.text(talk)
        both = merged(spark.readStream.schema(df.schema).parquet(source), spark.readStream.text(talk))
        run = fold(self.home)

        def start():
            writer = both.writeStream.foreachBatch(run)
            return writer.option("checkpointLocation", f"{self.home}/checkpoint").trigger(availableNow=True).start()

        with _stream_partitions(spark):
            for k in range(len(times) + 1):
                staged.filter(F.col("_stretch") == k).select(*df.columns).write.mode("append").parquet(source)
                start().awaitTermination()
                if k < len(times):
                    lines = [(text,) for at, text in messages if at.replace(tzinfo=timezone.utc) == times[k]]
                    spark.createDataFrame(lines, "value STRING").coalesce(1).write.mode("append").text(talk)
                    start().awaitTermination()
        return run.answers(spark)

    def steps(
        self, source: DataFrame, ts: str, delay: str, step: Step, carry_schema: str, out_schema: str, arrival: tuple[str, ...] = ()
    ) -> DataFrame:
        """Ordered operator by steps (see :mod:`rillstone.streaming.steps`), as a table."""
        fold = OrderedSteps(self.home, ts, delay, step, carry_schema, arrival)

        def start():
            writer = source.writeStream.foreachBatch(fold)
            return writer.option("checkpointLocation", f"{self.home}/checkpoint").trigger(availableNow=True).start()

        self._run(start)
        return self.spark.read.schema(out_schema).parquet(f"{self.home}/out/*")

    def batches(self, source: DataFrame, fold: Callable[[DataFrame, int], None], mode: str = "append") -> None:
        """Run a ``foreachBatch`` function over all that is available."""

        def start():
            writer = source.writeStream.outputMode(mode).foreachBatch(fold)
            return writer.option("checkpointLocation", f"{self.home}/checkpoint").trigger(availableNow=True).start()

        self._run(start)

    def state(self, operator: int = 0, **options: str) -> DataFrame:
        """What a run has left in its state: ``key`` and ``value`` of an aggregate, or of one side of a join (``joinSide``)."""
        reader = self.spark.read.format("statestore").option("operatorId", operator)
        return reader.options(**options).load(f"{self.home}/checkpoint")

    def late(self, schema: T.StructType) -> DataFrame:
        """The late rows of a run by steps."""
        return self.spark.read.schema(schema).parquet(f"{self.home}/late/*")

    def latest(self, result: DataFrame, keys: list[str]) -> DataFrame:
        """Update-mode result as a table of the newest row per key.

        Every micro-batch replaces its own folder, so a repeated batch leaves no double rows.
        """
        out = f"{self.home}/updates"

        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

        def start():
            writer = result.writeStream.outputMode("update").foreachBatch(write)
            return writer.option("checkpointLocation", f"{self.home}/checkpoint").trigger(availableNow=True).start()

        self._run(start)
        columns = [*result.schema.fields, T.StructField("batch", T.LongType())]
        updates = self.spark.read.schema(T.StructType(columns)).parquet(out)
        newest = F.max_by(F.struct(*result.columns), "batch")
        return updates.groupBy(*keys).agg(newest.alias("_u")).select("_u.*")


@contextmanager
def _stream_partitions(spark: SparkSession) -> Iterator[None]:
    """On a local session, keep state in as many partitions as there are cores."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if spark.sparkContext.master.startswith("local"):
        spark.conf.set(name, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def watermark_policy(spark: SparkSession, policy: str) -> AbstractContextManager[None]:
    """Queries started inside take the ``min`` or the ``max`` of the watermarks of their inputs as their own."""
    return _setting(spark, "spark.sql.streaming.multipleWatermarkPolicy", policy)


def data_batches_only(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries started inside have no micro-batches without input. State that expires by the clock asks for one after the
    other, so a run over all that is available would never end."""
    return _setting(spark, "spark.sql.streaming.noDataMicroBatches.enabled", "false")
