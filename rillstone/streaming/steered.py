"""Streams steered by control messages that arrive while they run.

Events and messages are two streams of one query. A message gets the number of the micro-batch it arrives in: it is put to
the table kept of all events up to that batch, and applies to the events of the batches after it. Control rows, kept table
and answers are folders of a batch, so that a batch that is run again replaces what its first attempt left.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions import geo
from rillstone.functions.text import time_text, whole_minutes
from rillstone.operators.events import event_time, latest_per_key
from rillstone.operators.joins import with_every_row
from rillstone.plans.control import MAX_EVENT_DELAY, checked_predicate, ride_struct
from rillstone.plans.rides import distances_to
from rillstone.schemas import RIDE_COLUMNS
from rillstone.sources.lines import ride_line

CONTROL = "ts TIMESTAMP, kind STRING, number BIGINT, lon FLOAT, lat FLOAT, text STRING"
ANSWER = "tag STRING, text STRING"
REPORT = "query_id BIGINT, taxi_id BIGINT, distance FLOAT, event_time TIMESTAMP, ride_id BIGINT"


def control_rows(messages: DataFrame) -> DataFrame:
    """Typed control rows from lines ``time|threshold|n``, ``time|location|id|lon|lat`` and ``time|predicate|text``.

    A line that is none of these becomes a row of kind ``refused`` with the line as its text.
    """
    parts = F.split("value", r"\|", 3)
    kind, rest = F.get(parts, F.lit(1)), F.get(parts, F.lit(2))
    place = F.split(rest, r"\|")
    number = F.when(kind == "threshold", rest.try_cast("bigint")).when(kind == "location", F.get(place, F.lit(0)).try_cast("bigint"))
    spot = [F.when(kind == "location", F.get(place, F.lit(k)).try_cast("float")) for k in (1, 2)]
    typed = messages.select(
        "value", F.get(parts, F.lit(0)).try_cast("timestamp").alias("ts"), kind.alias("kind"), number.alias("number"), spot[0].alias("lon"),
        spot[1].alias("lat"), F.when(kind == "predicate", rest).alias("text"),
    )
    known = F.expr(
        "ts IS NOT NULL AND CASE kind WHEN 'threshold' THEN number IS NOT NULL WHEN 'predicate' THEN text IS NOT NULL "
        "WHEN 'location' THEN number IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL ELSE false END"
    )
    fine = F.coalesce(known, F.lit(False))
    return typed.select(
        "ts", F.when(fine, F.col("kind")).otherwise("refused").alias("kind"), "number", "lon", "lat",
        F.when(fine, F.col("text")).otherwise(F.col("value")).alias("text"),
    )


def merged(events: DataFrame, messages: DataFrame) -> DataFrame:
    """One stream of both, for :class:`Steered`: ``event`` or ``message`` is null in each row."""
    one = events.select(F.struct(*events.columns).alias("event"), F.lit(None).cast("string").alias("message"))
    two = messages.select(F.lit(None).cast(one.schema["event"].dataType).alias("event"), F.col("value").alias("message"))
    return one.unionByName(two)


@dataclass
class Steered:
    """A ``foreachBatch`` function over :func:`merged`.

    ``on_events(events, control)`` answers with the events of a batch and all control rows of earlier batches,
    ``on_control(kept, control)`` with the kept table after the batch and the control rows of the batch. The kept table
    holds the newest event of each taxi; of its versions only the last two stay.
    """

    home: str
    out_schema: str
    on_events: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    on_control: Callable[[DataFrame, DataFrame], DataFrame] | None = None

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark, home = batch.sparkSession, self.home
        batch = batch.persist()
        try:
            fresh = control_rows(batch.filter("message IS NOT NULL").select(F.col("message").alias("value")))
            fresh.coalesce(1).write.mode("overwrite").parquet(f"{home}/control/batch={number}")
            events = batch.filter("event IS NOT NULL").select("event.*")
            fresh = spark.read.schema(CONTROL).parquet(f"{home}/control/batch={number}")
            answers = [spark.createDataFrame([], self.out_schema)]
            if self.on_control:
                kept = self._kept(events, number)
                if not fresh.isEmpty():
                    answers.append(self.on_control(kept, fresh))
            if self.on_events and number:
                before = spark.read.schema(f"{CONTROL}, batch BIGINT").parquet(f"{home}/control").filter(F.col("batch") < number)
                answers.append(self.on_events(events, before))
            out = answers[0]
            for more in answers[1:]:
                out = out.unionByName(more)
            out.write.mode("overwrite").parquet(f"{home}/out/batch={number}")
            drop_folder(spark, f"{home}/kept/{number - 2}")
        finally:
            batch.unpersist()

    def _kept(self, events: DataFrame, number: int) -> DataFrame:
        spark = events.sparkSession
        every = events.select(*RIDE_COLUMNS)
        if number:
            every = every.unionByName(spark.read.schema(every.schema).parquet(f"{self.home}/kept/{number - 1}"))
        latest_per_key(every).write.mode("overwrite").parquet(f"{self.home}/kept/{number}")
        return spark.read.schema(every.schema).parquet(f"{self.home}/kept/{number}")

    def answers(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{self.out_schema}, batch BIGINT").parquet(f"{self.home}/out").drop("batch")


def drop_folder(spark: SparkSession, folder: str) -> None:
    old = spark._jvm.org.apache.hadoop.fs.Path(folder)
    old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def ongoing_rides(kept: DataFrame, control: DataFrame) -> DataFrame:
    """For each new threshold: taxis of the kept table whose newest event is a START at least so many whole minutes before."""
    asked = control.filter("kind = 'threshold'").select(F.col("number").alias("n"), F.col("ts").alias("asked_at"))
    waiting = with_every_row(kept.filter("is_start"), asked)
    return waiting.filter(whole_minutes(F.col("start_time"), F.col("asked_at")) >= F.col("n"))


def reports(events: DataFrame, control: DataFrame) -> DataFrame:
    """The nearest report of a batch to every location that is known by then."""
    places = control.filter("kind = 'location'").select(F.col("number").alias("query_id"), "lon", "lat")
    best = F.min_by(F.struct("taxi_id", "distance", "event_time", "ride_id"), F.struct("distance", "event_time", "ride_id"))
    return distances_to(events, places).groupBy("query_id").agg(best.alias("_b")).select("query_id", "_b.*")


def nearest(found: DataFrame) -> DataFrame:
    """The nearest taxi of each location from the reports of all batches."""
    best = F.min_by(F.struct("taxi_id", "distance"), F.struct("distance", "event_time", "ride_id"))
    return found.groupBy("query_id").agg(best.alias("_b")).select("query_id", "_b.*")


def _matching(timed: DataFrame, text: str, tag: str) -> DataFrame:
    """Answers ``(tag, text)`` of rides ``(ride, at)`` to a predicate."""
    hits = timed.withColumn("watermark", F.unix_millis("at")).filter(checked_predicate(text))
    return hits.select(F.concat(F.lit(f"{tag}@"), time_text(F.col("at"))).alias("tag"), ride_line(F.col("ride")).alias("text"))


def _accepted(text: str) -> bool:
    try:
        checked_predicate(text)
    except ValueError:
        return False
    return True


def asked_of_kept(kept: DataFrame, control: DataFrame) -> DataFrame:
    """``QUERY`` rows repeat the new predicates, ``PBE`` rows are kept rides that match one; what may not be run is ``REFUSED``."""
    geo.register_sql_functions(kept.sparkSession)
    out = control.filter("kind = 'refused'").select(F.lit("REFUSED").alias("tag"), "text")
    for row in control.filter("kind = 'predicate'").collect():  # the messages of one batch
        fine = _accepted(row.text)
        out = out.unionByName(kept.sparkSession.createDataFrame([("QUERY" if fine else "REFUSED", row.text)], ANSWER))
        if fine:
            timed = kept.select(ride_struct().alias("ride")).withColumn("at", F.lit(row.ts))
            out = out.unionByName(_matching(timed, row.text, "PBE"))
    return out


def asked_of_events(events: DataFrame, control: DataFrame) -> DataFrame:
    """``PE`` rows: events that match the newest predicate that can be run; the plan does not grow with those before it."""
    geo.register_sql_functions(events.sparkSession)
    newest = control.filter("kind = 'predicate'").orderBy(F.desc("batch"), F.desc("ts")).toLocalIterator()
    text = next((r.text for r in newest if _accepted(r.text)), None)
    if text is None:
        return events.sparkSession.createDataFrame([], ANSWER)
    delay = F.expr(f"INTERVAL {int(MAX_EVENT_DELAY.total_seconds())} SECONDS")
    return _matching(events.select(ride_struct().alias("ride"), (event_time() - delay).alias("at")), text, "PE")
