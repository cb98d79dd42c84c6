"""Connected-car queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.operators.events import mark_late, positions
from rillstone.operators.relational import range_sort

ARRIVAL = ["arrival", "event_id"]


def on_time_sorted(cars: DataFrame, delay: str = "30 SECONDS") -> DataFrame:
    """On-time events with ``pos``, their place in the event-time order of the car."""
    on_time = mark_late(cars, "ts", ARRIVAL, delay).filter(~F.col("is_late")).drop("is_late")
    return positions(on_time, ["car_id"], ["ts", "event_id"])


def sorted_stream(cars: DataFrame, delay: str = "1 SECOND") -> DataFrame:
    """All events in event-time order, ``place`` growing with it; ``output_tag`` tells late events from sorted ones."""
    marked = mark_late(cars, "ts", ARRIVAL, delay)
    tagged = marked.withColumn("output_tag", F.when(F.col("is_late"), "late").otherwise("sorted"))
    return range_sort(tagged.drop("is_late"), ["ts", "event_id"])


def late_count(cars: DataFrame, delay: str) -> DataFrame:
    marked = mark_late(cars, "ts", ARRIVAL, delay)
    return marked.filter("is_late").agg(F.count(F.lit(1)).alias("cnt")).select(F.lit("LATE").alias("tag"), "cnt")


def events_per_second(cars: DataFrame, delay: str) -> DataFrame:
    """On-time events per car and one-second window."""
    on_time = mark_late(cars, "ts", ARRIVAL, delay).filter(~F.col("is_late"))
    counts = on_time.groupBy("car_id", F.window("ts", "1 second").alias("w")).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.select(F.col("car_id").alias("user_id"), F.col("w.start").alias("window_start"), "cnt")
