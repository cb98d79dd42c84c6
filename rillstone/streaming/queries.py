"""Streaming forms of the taxi and car queries that built-in operators express.

Inputs are streams of rides, fares or car events; ``delay`` is the watermark delay. Each result has
the columns of the batch form of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.functions import geo
from rillstone.operators.events import relevant_cell, segment_label, segment_summary, with_event_time
from rillstone.plans import rides as batch
from rillstone.schemas import FARE_COLUMNS, RIDE_COLUMNS

EVENT_DELAY = "60 seconds"


def ride_cleansing(rides: DataFrame) -> DataFrame:
    return batch.ride_cleansing(rides)


def _hourly(fares: DataFrame, delay: str) -> DataFrame:
    per = fares.withWatermark("start_time", delay).groupBy(F.window("start_time", "1 hour").alias("w"), "driver_id")
    return per.agg(F.sum(F.col("tip").cast("double")).alias("sum_tips"))


def hourly_tips(fares: DataFrame, delay: str = EVENT_DELAY) -> DataFrame:
    return _hourly(fares, delay).select(F.col("w.end").alias("window_end"), "driver_id", "sum_tips")


def hourly_top_tips(fares: DataFrame, delay: str = EVENT_DELAY) -> DataFrame:
    """Two windows in a chain: tips per driver, then the best driver of the hour."""
    best = F.max_by(F.struct("driver_id", "sum_tips"), F.struct(F.col("sum_tips"), -F.col("driver_id")))
    per_hour = _hourly(fares, delay).groupBy(F.window(F.window_time("w"), "1 hour").alias("h")).agg(best.alias("_b"))
    return per_hour.select(F.col("h.end").alias("window_end"), "_b.driver_id", "_b.sum_tips")


def popular_places(rides: DataFrame, delay: str = EVENT_DELAY, threshold: int = 20) -> DataFrame:
    events = with_event_time(batch.ride_cleansing(rides)).withWatermark("event_time", delay)
    counted = events.groupBy(
        relevant_cell().alias("cell"), "is_start", F.window("event_time", "15 minutes", "5 minutes").alias("w")
    ).agg(F.count(F.lit(1)).alias("cnt"))
    place = geo.cell_center(F.col("cell"))
    return counted.filter(F.col("cnt") >= threshold).select(
        place["lon"].alias("lon"), place["lat"].alias("lat"), F.col("w.end").alias("window_end"), "is_start", "cnt"
    )


def rides_per_hour(rides: DataFrame, delay: str = EVENT_DELAY) -> DataFrame:
    events = with_event_time(rides).withWatermark("event_time", delay)
    counted = events.groupBy("is_start", F.window("event_time", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("cnt"))
    return counted.select(F.col("w.start").alias("window_start"), "is_start", "cnt")


def driving_sessions(cars: DataFrame, gap: str = "15 seconds", delay: str = "30 seconds") -> DataFrame:
    per = cars.withWatermark("ts", delay).groupBy("car_id", F.session_window("ts", gap).alias("w"))
    summary = per.agg(*segment_summary(cars, ["car_id"]))
    return summary.drop("w").withColumn("label", segment_label(F.col("erraticness")))


def _timed_starts(rides: DataFrame, delay: str, drop_reserved: bool = False) -> DataFrame:
    return batch.starts(rides, drop_reserved).withWatermark("start_time", delay)


def _timed_fares(fares: DataFrame, delay: str) -> DataFrame:
    return fares.select(*[F.col(c).alias(f"fare_{c}") for c in FARE_COLUMNS]).withWatermark("fare_start_time", delay)


def rides_and_fares(
    rides: DataFrame, fares: DataFrame, bound: str, delay: str = EVENT_DELAY, fare_delay: str | None = None
) -> DataFrame:
    """Inner join of two streams. A fare must start within ``bound`` of its ride, as in the batch form with that bound.

    State is kept for ``bound`` and the delays. Each input has its own lateness (``fare_delay`` is ``delay`` unless told). By
    Spark's policy the slower of the two watermarks counts for both; see :func:`rillstone.streaming.runner.watermark_policy`.
    """
    return _timed_starts(rides, delay).join(_timed_fares(fares, fare_delay or delay), batch.same_ride(bound))


def unmatched_fares(rides: DataFrame, fares: DataFrame, bound: str, delay: str = EVENT_DELAY) -> DataFrame:
    """Fares given up once the watermark says that no ride can follow."""
    known = _timed_starts(rides, delay, drop_reserved=True).select("ride_id", "start_time")
    joined = _timed_fares(fares, delay).join(known, batch.same_ride(bound), "left_outer")
    return joined.filter(F.col("ride_id").isNull()).select(*[F.col(f"fare_{c}").alias(c) for c in FARE_COLUMNS])


def unmatched_rides(rides: DataFrame, fares: DataFrame, bound: str, delay: str = EVENT_DELAY) -> DataFrame:
    starts = _timed_starts(rides, delay, drop_reserved=True)
    joined = starts.join(_timed_fares(fares, delay), batch.same_ride(bound), "left_outer")
    return joined.filter(F.col("fare_ride_id").isNull()).select(*RIDE_COLUMNS)


def long_rides(rides: DataFrame, delay: str = EVENT_DELAY) -> DataFrame:
    """START events for which no END came within two hours of event time."""
    ends = rides.filter(~F.col("is_start")).select(F.col("ride_id").alias("_id"), F.col("end_time").alias("_end"))
    ends = ends.withWatermark("_end", delay)
    in_time = (F.col("ride_id") == F.col("_id")) & F.expr(
        f"_end BETWEEN start_time AND start_time + INTERVAL {batch.LONG_RIDE}"
    )
    joined = _timed_starts(rides, delay).join(ends, in_time, "left_outer")
    return joined.filter(F.col("_id").isNull()).select(*RIDE_COLUMNS)


def ride_count(rides: DataFrame) -> DataFrame:
    """Events per driver so far; run it in update mode. The state keeps one number per driver."""
    return batch.ride_count(rides)


def rides_view(rides: DataFrame, name: str = "TaxiRides", delay: str = EVENT_DELAY) -> DataFrame:
    """Register a stream of rides for SQL text: its event time with the watermark, and the library's functions."""
    spark = rides.sparkSession
    geo.register_sql_functions(spark)
    timed = with_event_time(rides).withWatermark("event_time", delay)
    timed.createOrReplaceTempView(name)
    return timed


def popular_places_sql(rides: DataFrame, threshold: int = 20, delay: str = EVENT_DELAY) -> DataFrame:
    """The SQL text of :func:`rillstone.plans.rides.popular_places_sql` over a stream; in append or update mode."""
    timed = rides_view(rides, delay=delay)
    return rides.sparkSession.sql(batch.POPULAR_PLACES_SQL, rides=timed, threshold=threshold)


def place_changes(rides: DataFrame, delay: str = EVENT_DELAY, sign: str | None = None) -> DataFrame:
    """Rides per cell and window so far, for a log of changes; with a column ``sign`` of 1 and -1, rides can be taken back."""
    events = with_event_time(rides).withWatermark("event_time", delay)
    inside = events.filter(geo.in_nyc(F.col("start_lon"), F.col("start_lat")) & geo.in_nyc(F.col("end_lon"), F.col("end_lat")))
    cnt = F.sum(F.col(sign)) if sign else F.count(F.lit(1))
    counted = inside.groupBy(relevant_cell().alias("cell"), "is_start", F.window("event_time", "15 minutes", "5 minutes").alias("w")).agg(cnt.alias("cnt"))
    return counted.select("cell", "is_start", F.col("w.end").alias("window_end"), F.col("cnt").cast("bigint").alias("cnt"))


PLACE_KEYS = ["cell", "is_start", "window_end"]
PLACE_CHANGES = "cell INT, is_start BOOLEAN, window_end TIMESTAMP, cnt BIGINT"


def fenced(rides: DataFrame) -> DataFrame:
    """Rides with ``output_tag`` inside or outside New York, for a sink per tag."""
    inside = geo.in_nyc(F.col("start_lon"), F.col("start_lat")) & geo.in_nyc(F.col("end_lon"), F.col("end_lat"))
    return rides.withColumn("output_tag", F.when(F.coalesce(inside, F.lit(False)), "inside").otherwise("outside"))
