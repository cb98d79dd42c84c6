"""Ordered streaming operators made of table operators, one step per micro-batch.

A keyed stateful operator handles all rows of a key in one task, row by row. Here every micro-batch
runs the batch form over the rows that its watermark has passed, so a key of any size is cut into
ranges and handled by all tasks. Between batches there is

* a table of pending rows, which the watermark has not passed yet: as many as the delay spans;
* a small carry table, one row per key (or per waiting item), that the next step puts in front.

All of it lies on shared storage under the number of the batch. A repeated batch starts from what the
one before left and replaces what its first attempt wrote; what no batch can need again is deleted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions import geo
from rillstone.operators.events import by_shape, event_time, mark_late, segment_label
from rillstone.operators.ordered import running, slice_groups
from rillstone.plans.control import improving_reports
from rillstone.plans.rides import ride_cleansing

Step = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


@dataclass
class OrderedSteps:
    """A ``foreachBatch`` function. ``step(ready, carry)`` gives the rows to put out and the new carry.

    The watermark is the newest event time seen before or in the batch, less ``delay``. Rows at or
    behind the watermark of the batch before are late. With ``arrival``, columns that order the rows as they
    came, lateness is told row by row, as :func:`mark_late` tells it for a table. Late rows go to ``late``.
    """

    home: str
    ts: str
    delay: str
    step: Step
    carry_schema: str
    arrival: tuple[str, ...] = ()

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark, home, schema = batch.sparkSession, self.home, batch.schema
        read = lambda name, kind: spark.read.schema(kind).parquet(f"{home}/{name}")
        newest = passed = None
        if number > 0:
            known = spark.read.parquet(f"{home}/state/{number - 1}").first()
            newest, passed = known["newest"], known["watermark"]
        micros = lambda value: F.timestamp_micros(F.lit(value))
        if self.arrival:
            before = None if newest is None else micros(newest)
            marked = mark_late(batch, self.ts, list(self.arrival), self.delay, newest=before)
        else:
            marked = batch.withColumn("is_late", F.lit(False) if passed is None else F.unix_micros(self.ts) <= passed)
        marked.write.mode("overwrite").parquet(f"{home}/rows/{number}")
        rows = read(f"rows/{number}", marked.schema)
        rows.filter("is_late").drop("is_late").write.mode("overwrite").parquet(f"{home}/late/batch={number}")
        fresh = rows.filter("NOT is_late").drop("is_late")
        seen = rows.agg(F.unix_micros(F.max(self.ts)).alias("at"), F.unix_micros(F.max(self.ts) - F.expr(f"INTERVAL {self.delay}"))).first()
        newest = max((t for t in (newest, seen[0]) if t is not None), default=None)
        watermark = max((t for t in (passed, seen[1]) if t is not None), default=None)
        waiting = fresh if number == 0 else fresh.unionByName(read(f"pending/{number - 1}", schema))
        carry = spark.createDataFrame([], self.carry_schema) if number == 0 else read(f"carry/{number - 1}", self.carry_schema)
        if watermark != passed:
            upto = F.col(self.ts) <= micros(watermark)
            out, carry = self.step(waiting.filter(upto), carry)
            waiting = waiting.filter(~upto)
            out.write.mode("overwrite").parquet(f"{home}/out/batch={number}")
        else:
            rows.limit(0).select(F.lit(1).alias("none")).write.mode("overwrite").parquet(f"{home}/out/batch={number}")
        carry.write.mode("overwrite").parquet(f"{home}/carry/{number}")
        waiting.write.mode("overwrite").parquet(f"{home}/pending/{number}")
        pending = spark.read.schema(schema).parquet(f"{home}/pending/{number}").count()
        state = spark.createDataFrame([(newest, watermark, pending)], "newest BIGINT, watermark BIGINT, pending BIGINT")
        state.coalesce(1).write.mode("overwrite").parquet(f"{home}/state/{number}")
        self._forget(spark, number - 2)

    def _forget(self, spark: SparkSession, number: int) -> None:
        for name in ("rows", "carry", "pending"):
            old = spark._jvm.org.apache.hadoop.fs.Path(f"{self.home}/{name}/{number}")
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


SEGMENT_CARRY = (
    "car_id BIGINT, stops BIGINT, stopped TIMESTAMP, n BIGINT, start_time TIMESTAMP, top DOUBLE, mean DOUBLE, m2 DOUBLE"
)


def segments_step(strict: bool = False, max_rows: int | None = None) -> Step:
    """Driving segments; the carry of a car is its last stop and the sums of the open run."""

    def step(ready: DataFrame, carry: DataFrame) -> tuple[DataFrame, DataFrame]:
        open_runs = carry.select(
            "car_id", F.lit(False).alias("real"), F.timestamp_micros(F.lit(0)).alias("ts"), F.lit(False).alias("moving"),
            F.lit(-1).cast("bigint").alias("event_id"), F.lit(0.0).alias("speed"), F.lit(0.0).alias("throttle"),
            F.struct("stops", "stopped", "n", "start_time", "top", "mean", "m2").alias("k"),
        )
        rows = ready.select(
            "car_id", F.lit(True).alias("real"), "ts", (F.col("speed") != 0.0).alias("moving"), "event_id", "speed", "throttle",
            F.lit(None).cast(open_runs.schema["k"].dataType).alias("k"),
        ).unionByName(open_runs)
        is_stop = F.col("real") & ~F.col("moving")
        s = slice_groups(rows, ["car_id"], ["real", "ts", "moving", "event_id"], max_rows)
        s = running(
            s,
            {
                "before": ("sum", F.when(F.col("real"), is_stop.cast("bigint")).otherwise(F.col("k.stops"))),
                "stopped": ("max", F.when(F.col("real"), F.when(is_stop, F.col("ts"))).otherwise(F.col("k.stopped"))),
            },
            inclusive=False,
        )
        run = F.when(F.col("real"), F.coalesce("before", F.lit(0))).otherwise(F.col("k.stops"))
        inside = F.col("real") & F.col("moving") & (F.col("stopped").isNull() | (F.col("ts") > F.col("stopped")))
        pick = lambda c: F.when(inside, F.col(c))
        grouped = s.rows().groupBy("car_id", run.alias("run")).agg(
            F.count(F.when(inside, 1)).alias("n"), F.min(pick("ts")).alias("start_time"), F.max(pick("speed")).alias("top"),
            F.avg(pick("throttle")).alias("mean"), F.var_pop(pick("throttle")).alias("var"),
            F.max("k").alias("k"), F.max(is_stop).alias("closed"), F.max(F.when(is_stop, F.col("ts"))).alias("stop_ts"),
        )
        # The part of this step joined with the part carried into it.
        n0, n1 = F.coalesce("k.n", F.lit(0)), F.col("n")
        mean0, mean1 = F.coalesce("k.mean", F.lit(0.0)), F.coalesce("mean", F.lit(0.0))
        n, gap = n0 + n1, mean1 - mean0
        share = F.when(n > 0, n1 / n).otherwise(0.0)
        m2 = F.coalesce("k.m2", F.lit(0.0)) + F.coalesce(F.col("var") * n1, F.lit(0.0)) + gap * gap * n0 * share
        joined = grouped.select(
            "car_id", "run", "closed", F.greatest("stop_ts", "k.stopped").alias("stopped"), n.alias("n"),
            F.least("start_time", "k.start_time").alias("start_time"), F.greatest("top", "k.top").alias("top"),
            (mean0 + gap * share).alias("mean"), m2.alias("m2"),
        )
        found = joined.filter(F.col("closed") & (F.col("n") > 0))
        if strict:
            found = found.filter(F.col("run") >= 1)
        spread = F.sqrt(F.col("m2") / F.col("n"))
        out = found.select(
            "car_id", "start_time", F.col("n").alias("length"), F.col("top").cast("int").alias("max_speed"),
            spread.alias("erraticness"), segment_label(spread).alias("label"),
        )
        open_run = F.max_by(F.struct("n", "start_time", "top", "mean", "m2"), F.when(~F.col("closed"), F.col("run")))
        kept = joined.groupBy("car_id").agg(
            F.max(F.col("run") + F.col("closed").cast("bigint")).alias("stops"), F.max("stopped").alias("stopped"),
            open_run.alias("o"),
        )
        kept = kept.select(
            "car_id", "stops", "stopped", F.coalesce("o.n", F.lit(0)).alias("n"), "o.start_time", "o.top",
            F.coalesce("o.mean", F.lit(0.0)).alias("mean"), F.coalesce("o.m2", F.lit(0.0)).alias("m2"),
        )
        return out, kept

    return step


POSITION_CARRY = "car_id BIGINT, n BIGINT"


def positions_step(max_rows: int | None = None) -> Step:
    """Events of a car in order, numbered; the carry is how many there were."""

    def step(ready: DataFrame, carry: DataFrame) -> tuple[DataFrame, DataFrame]:
        counts = carry.select("car_id", F.lit(False).alias("real"), F.col("n").alias("weight"))
        real = ready.withColumn("real", F.lit(True)).withColumn("weight", F.lit(1).cast("bigint"))
        rows = real.unionByName(counts, allowMissingColumns=True)
        rows = rows.fillna({"event_id": -1}).withColumn("ts", F.coalesce("ts", F.timestamp_micros(F.lit(0))))
        s = slice_groups(rows, ["car_id"], ["real", "ts", "event_id"], max_rows)
        s = running(s, {"pos": ("sum", F.col("weight"))})
        out = s.rows().filter("real").drop("real", "weight")
        return out, rows.groupBy("car_id").agg(F.sum("weight").alias("n"))

    return step


PREDICTION_CARRY = "cell INT, sector INT, n BIGINT, xy DOUBLE, xx DOUBLE"


def prediction_rows(rides: DataFrame) -> DataFrame:
    """What a prediction needs of each ride event."""
    km = geo.planar_km(F.col("start_lon"), F.col("start_lat"), F.col("end_lon"), F.col("end_lat"))
    degrees = geo.direction_degrees(F.col("end_lon"), F.col("end_lat"), F.col("start_lon"), F.col("start_lat"))
    minutes = (F.unix_millis("end_time") - F.unix_millis("start_time")) / F.lit(60000.0)
    ended = ~F.col("is_start")
    return ride_cleansing(rides).select(
        event_time().alias("event_time"), ended.alias("ended"), "ride_id",
        geo.cell_id(F.col("end_lon"), F.col("end_lat")).alias("cell"), geo.direction_bucket(degrees).alias("sector"),
        km.alias("km"), F.when(ended, km * minutes).alias("xy"), F.when(ended, km * km).alias("xx"),
    )


def predictions_step(max_rows: int | None = None) -> Step:
    """Travel times from the rides seen so far; the carry is the sums of each cell and sector."""

    def step(ready: DataFrame, carry: DataFrame) -> tuple[DataFrame, DataFrame]:
        sums = carry.select(
            "cell", "sector", F.lit(False).alias("real"), F.timestamp_micros(F.lit(0)).alias("event_time"),
            F.lit(True).alias("ended"), F.lit(-1).cast("bigint").alias("ride_id"), F.lit(0.0).alias("km"), "n", "xy", "xx",
        )
        real = ready.withColumn("real", F.lit(True)).withColumn("n", F.col("ended").cast("bigint"))
        rows = real.unionByName(sums)
        s = slice_groups(rows, ["cell", "sector"], ["real", "event_time", "ended", "ride_id"], max_rows)
        s = running(s, {f"_{c}": ("sum", F.col(c)) for c in ("n", "xy", "xx")}, inclusive=False)
        fit = (F.col("_n") >= 2) & (F.col("_xx") > 0)
        guess = F.when(fit, F.round(F.col("_xy") / F.col("_xx") * F.col("km"), 9).cast("int"))
        out = s.rows().filter(F.col("real") & ~F.col("ended")).select(
            "ride_id", F.coalesce(guess, F.lit(-1)).alias("predicted_minutes")
        )
        kept = rows.groupBy("cell", "sector").agg(*[F.coalesce(F.sum(c), F.lit(0).cast(t)).alias(c) for c, t in
                                                    (("n", "bigint"), ("xy", "double"), ("xx", "double"))])
        return out, kept

    return step


PAIR_CARRY = "rule STRING, color BIGINT, ts TIMESTAMP, seq BIGINT, opens BOOLEAN, closes BOOLEAN"


def pairs_step(max_rows: int | None = None) -> Step:
    """Rule matches; the carry is the items that still wait."""

    def step(ready: DataFrame, carry: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = ready.unionByName(carry)
        s = slice_groups(rows, ["rule", "color"], ["ts", "seq"], max_rows)
        closing = F.when(F.col("closes"), F.col("seq"))
        s = running(s, {"second_seq": ("last", closing)}, inclusive=False, reverse=True)
        opened = s.rows().filter("opens")
        out = opened.filter(F.col("second_seq").isNotNull())
        waiting = opened.filter(F.col("second_seq").isNull()).drop("second_seq").withColumn("closes", F.lit(False))
        return out.select("rule", "color", F.col("seq").alias("first_seq"), "second_seq"), waiting

    return step


def pair_rows(items: DataFrame, rules: DataFrame) -> DataFrame:
    """Items next to the rules they open or close; ``rules`` is a static control table."""
    opens, closes = F.col("shape") == F.col("first_shape"), F.col("shape") == F.col("second_shape")
    met = items.join(by_shape(rules), "shape")
    return met.select("rule", "color", "ts", "seq", opens.alias("opens"), closes.alias("closes"))


REPORT_CARRY = "query_id BIGINT, ride_id BIGINT, taxi_id BIGINT, event_time TIMESTAMP, distance FLOAT"


def closest_step(max_rows: int | None = None) -> Step:
    """Improving reports of expiring queries; the carry is the last report put out per query."""

    def step(ready: DataFrame, carry: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = ready.withColumn("old", F.lit(False)).unionByName(carry.withColumn("old", F.lit(True)))
        found = improving_reports(rows, max_rows)
        newest = F.max_by(F.struct(*carry.columns), F.struct("event_time", "ride_id"))
        kept = found.groupBy("query_id").agg(newest.alias("_n")).select("_n.*")
        return found.filter(~F.col("old")).select("query_id", "taxi_id", "event_time", "distance"), kept

    return step
