"""Named, option-checked readers for ride, fare, trip and station files, batch and streaming."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone import schemas
from rillstone.operators.events import with_event_time
from rillstone.sources.lines import parse_car_lines, parse_fare_lines, parse_ride_lines


@dataclass(frozen=True)
class EventFiles:
    """Options of a ride or fare source. The largest event delay becomes the watermark delay."""

    path: str
    max_event_delay_secs: int = 0

    def __post_init__(self):
        if not self.path:
            raise ValueError("connector.path is required")
        if self.max_event_delay_secs < 0:
            raise ValueError("max-event-delay-secs must be at least 0")


def _lines(spark: SparkSession, options: EventFiles, streaming: bool) -> DataFrame:
    return (spark.readStream if streaming else spark.read).text(options.path)


def _timed(df: DataFrame, options: EventFiles, streaming: bool) -> DataFrame:
    return df.withWatermark("event_time", f"{options.max_event_delay_secs} seconds") if streaming else df


def read_rides(spark: SparkSession, options: EventFiles, streaming: bool = False) -> DataFrame:
    """Ride events with ``event_time`` from (gzip) text files."""
    return _timed(with_event_time(parse_ride_lines(_lines(spark, options, streaming))), options, streaming)


def read_fares(spark: SparkSession, options: EventFiles, streaming: bool = False) -> DataFrame:
    """Fares with ``event_time`` from (gzip) text files."""
    parsed = parse_fare_lines(_lines(spark, options, streaming)).withColumn("event_time", F.col("start_time"))
    return _timed(parsed, options, streaming)


def read_cars(spark: SparkSession, options: EventFiles, streaming: bool = False) -> DataFrame:
    cars = parse_car_lines(_lines(spark, options, streaming))
    return cars.withWatermark("ts", f"{options.max_event_delay_secs} seconds") if streaming else cars


def table_view(events: DataFrame, name: str | None = None) -> DataFrame:
    """The table form: event time instead of start and end time; optionally registered by name."""
    shaped = events.drop("start_time", "end_time")
    if name:
        shaped.createOrReplaceTempView(name)
    return shaped


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.TRIP).csv(path, header=True)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STATION).csv(path, header=True)


def read_languages(spark: SparkSession, path: str) -> DataFrame:
    """First column of a CSV with header, as ``name``; every value is text."""
    raw = spark.read.option("header", "true").csv(path)
    return raw.select(F.col(f"`{raw.columns[0]}`").alias("name"))


def read_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Control messages, one per line, from files that are added to a folder."""
    return spark.readStream.text(folder)


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path
