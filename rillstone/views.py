"""Taxi, car, bike and post records derived from the warehouse tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions.text import time_text
from rillstone.schemas import FARE_COLUMNS, RIDE_COLUMNS

EPOCH_2013 = 1356998400
EPOCH_2024 = 1704067200
NO_FARE_PRIORITY = "4-NOT SPECIFIED"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _at(seconds: Column) -> Column:
    return F.timestamp_seconds(F.lit(EPOCH_2013) + seconds)


def _spot(lon_index: Column, shift: Column) -> tuple[Column, Column]:
    lon = (F.lit(-73.9993) + F.lit(0.12) * lon_index + F.lit(0.0001) * (shift % 7)).cast("float")
    lat = (F.lit(40.7506) + F.lit(0.03) * lon_index).cast("float")
    return lon, lat


def _trip_base(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    return orders.select(
        key.alias("ride_id"),
        F.col("o_custkey").alias("driver_id"),
        (F.col("o_custkey") % 97).alias("taxi_id"),
        ((key * 7919) % 86400).alias("s_off"),
        (F.lit(300) + (key * 104729) % 10800).alias("dur"),
        (key % 4).alias("s_spot"),
        (F.floor(key / 4) % 4).alias("e_spot"),
        "o_orderstatus",
        "o_orderpriority",
    )


def rides_of(orders: DataFrame) -> DataFrame:
    """A START event per order and an END event for every order that is not pending."""
    base = _trip_base(orders)
    start_lon, start_lat = _spot(F.col("s_spot"), F.col("driver_id"))
    end_lon, end_lat = _spot(F.col("e_spot"), F.col("taxi_id"))
    start, end = _at(F.col("s_off")), _at(F.col("s_off") + F.col("dur"))

    def event(is_start: bool) -> Column:
        end_time = F.lit(None).cast("timestamp") if is_start else end
        return F.struct(F.lit(is_start).alias("is_start"), end_time.alias("end_time"))

    events = F.when(F.col("o_orderstatus") == "P", F.array(event(True))).otherwise(F.array(event(True), event(False)))
    return base.select(
        "ride_id",
        start.alias("start_time"),
        start_lon.alias("start_lon"),
        start_lat.alias("start_lat"),
        end_lon.alias("end_lon"),
        end_lat.alias("end_lat"),
        (F.lit(1) + F.col("ride_id") % 5).cast("smallint").alias("passenger_cnt"),
        "taxi_id",
        "driver_id",
        F.inline(events),
    ).select(*RIDE_COLUMNS)


def rides(spark: SparkSession, folder: str) -> DataFrame:
    return rides_of(table(spark, folder, "orders"))


def fares_of(orders: DataFrame) -> DataFrame:
    """A fare for every order with a stated priority (the payment type)."""
    base = _trip_base(orders).filter(F.col("o_orderpriority") != NO_FARE_PRIORITY)
    return base.select(
        "ride_id",
        "taxi_id",
        "driver_id",
        _at(F.col("s_off")).alias("start_time"),
        F.col("o_orderpriority").alias("payment_type"),
        ((F.col("ride_id") * 13 % 2000) / F.lit(100.0)).cast("float").alias("tip"),
        F.lit(0.0).cast("float").alias("tolls"),
        (F.col("dur") / F.lit(60.0)).cast("float").alias("total_fare"),
    ).select(*FARE_COLUMNS)


def fares(spark: SparkSession, folder: str) -> DataFrame:
    return fares_of(table(spark, folder, "orders"))


def cars_of(events: DataFrame) -> DataFrame:
    """Car telemetry with an arrival time that is up to an hour after the event time."""
    late = F.make_dt_interval(secs=(F.col("event_id") * 7919 % 3600).cast("decimal(18,6)"))
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.col("user_id").alias("car_id"),
        "event_id",
        ts.alias("ts"),
        (ts + late).alias("arrival"),
        F.when(F.col("event_type") == "view", 0.0).otherwise(F.col("value")).alias("speed"),
        (F.col("value") % 50).alias("throttle"),
    )


def cars(spark: SparkSession, folder: str) -> DataFrame:
    return cars_of(table(spark, folder, "events"))


def items_of(events: DataFrame, *more: str) -> DataFrame:
    return events.select(
        F.col("event_id").alias("seq"), F.col("event_type").alias("shape"), F.col("user_id").alias("color"), *more
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    return items_of(table(spark, folder, "events"))


def stations(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        key.alias("id"),
        F.col("s_name").alias("name"),
        (F.lit(37.3) + (key * 37 % 500) / F.lit(1000.0)).alias("lat"),
        (F.lit(-122.5) + (key * 91 % 700) / F.lit(1000.0)).alias("long"),
    )


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Bike trips from order lines; the end station is another supplier's."""
    supplier = table(spark, folder, "supplier")
    size = supplier.agg(F.max("s_suppkey").alias("_last"))
    names = supplier.select(F.col("s_suppkey").alias("_key"), F.col("s_name").alias("_name"))
    lines = table(spark, folder, "lineitem").join(F.broadcast(size), F.lit(True))
    start = names.select(F.col("_key").alias("_s"), F.col("_name").alias("start_station_name"))
    end = names.select(F.col("_key").alias("_e"), F.col("_name").alias("end_station_name"))
    placed = lines.join(start, F.col("l_suppkey") == F.col("_s")).join(
        end, F.col("l_partkey") % (F.col("_last") + 1) == F.col("_e")
    )
    return placed.select(
        F.col("l_suppkey").alias("bike_id"),
        (F.col("l_quantity") * 14).cast("bigint").alias("duration"),
        "start_station_name",
        "end_station_name",
        F.col("l_partkey").cast("string").alias("zip_code"),
    )


def post_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One XML element per order line, as text."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    dates = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        dates, F.col("l_orderkey") == F.col("o_orderkey")
    )
    text = F.format_string(
        '  <row Id="%s-%s" CreationDate="%s" Tags="&lt;%s&gt;&lt;%s&gt;" />',
        F.col("l_orderkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS"),
        F.lower("p_brand"),
        F.lower("p_type"),
    )
    return joined.select(text.alias("value"))


def languages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(F.col("p_brand").alias("name")).distinct()


def location_queries(spark: SparkSession) -> DataFrame:
    """Three fixed control rows: places whose nearest taxi is asked for."""
    rows = [(1, -74.0, 41.0), (2, -73.7781, 40.6413), (3, -73.977664, 40.761484)]
    return spark.createDataFrame(rows, "query_id BIGINT, lon FLOAT, lat FLOAT")


def thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(0,), (5,), (30,)], "n BIGINT")


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("view_purchase", "view", "purchase")], "rule STRING, first_shape STRING, second_shape STRING")


def trades_of(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    return orders.select(
        key.alias("trade_id"),
        F.timestamp_seconds(F.lit(EPOCH_2024) + (key * 7919) % 2592000).alias("ts"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("info"),
    )


def trades(spark: SparkSession, folder: str) -> DataFrame:
    return trades_of(table(spark, folder, "orders"))


def customer_changes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").alias("change_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("info"),
    )


def raw_trip_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Raw trip records as 14-column text lines, with the position of the line."""
    base = _trip_base(table(spark, folder, "orders"))
    start_lon, start_lat = _spot(F.col("s_spot"), F.col("driver_id"))
    end_lon, end_lat = _spot(F.col("e_spot"), F.col("taxi_id"))
    start, end = _at(F.col("s_off")), _at(F.col("s_off") + F.col("dur"))
    blank = F.lit("")
    columns = [
        F.col("taxi_id"), F.col("driver_id"), F.lit("CMT"), F.lit("1"), F.lit("N"), time_text(start), time_text(end),
        F.lit(1) + F.col("ride_id") % 5, F.col("dur"), blank, start_lon, start_lat, end_lon, end_lat,
    ]
    line = F.concat(F.concat_ws(",", *[c.cast("string") for c in columns]), F.lit("\r"))
    return base.select(F.col("ride_id").alias("line_no"), line.alias("value"))


def raw_fare_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Raw fare records as 11-column text lines, with the position of the line."""
    base = _trip_base(table(spark, folder, "orders")).filter(F.col("o_orderpriority") != NO_FARE_PRIORITY)
    tip = ((F.col("ride_id") * 13 % 2000) / F.lit(100.0)).cast("float")
    columns = [
        F.col("taxi_id"), F.col("driver_id"), F.lit("CMT"), time_text(_at(F.col("s_off"))), F.col("o_orderpriority"),
        F.lit("10.0"), F.lit("0.5"), F.lit("0.5"), tip, F.lit("0.0"), (F.col("dur") / F.lit(60.0)).cast("float"),
    ]
    line = F.concat(F.concat_ws(",", *[c.cast("string") for c in columns]), F.lit("\r"))
    return base.select(F.col("ride_id").alias("line_no"), line.alias("value"))
