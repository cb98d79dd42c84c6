"""Each query bound to the warehouse tables, with plain result types."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone import schemas, views
from rillstone.operators import documents, events, mapreduce, matrix, relational
from rillstone.plans import bikes, cars, control, languages, rides
from rillstone.functions import geo
from rillstone.session import prepare, shared_folder
from rillstone.sources import connectors, lines, named, posts, raw
from rillstone.streaming import late, sinks, steered, steps
from rillstone.streaming import queries as stream
from rillstone.streaming.runner import FLUSH_TIME, Replay

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6
CAR_DELAY = "30 MINUTES"
STREAM_CAR_DELAY = "30 SECONDS"
SESSION_GAP = "6 HOURS"
# How far apart a ride and its fare may start in a stream.
PAIR_BOUND = "1 HOUR"
WATERMARK = datetime(2013, 1, 1, 12, 0, 0)
THRESHOLDS = [(WATERMARK, 0), (WATERMARK, 30), (datetime(2013, 1, 1, 20, 0, 0), 0), (datetime(2013, 1, 1, 20, 0, 0), 2)]
TAXI_QUERIES = [
    (datetime(2013, 1, 1, 8, 0, 0), "ride.is_start AND watermark - ride.event_millis > 100 * 60000"),
    (datetime(2013, 1, 1, 20, 0, 0), "NOT ride.is_start AND planarKm(-74.0, 41.0, ride.end_lon, ride.end_lat) < 40.0"),
]
CONTROL_ROWS = [
    (1, -74.0, 41.0, datetime(2013, 1, 1, 0, 30, 0)),
    (2, -73.7781, 40.6413, datetime(2013, 1, 1, 12, 0, 0)),
    (3, -73.977664, 40.761484, datetime(2013, 1, 1, 12, 5, 0)),
    (4, 0.0, 0.0, datetime(2013, 1, 1, 23, 0, 0)),
]


def plain(df: DataFrame) -> DataFrame:
    """Zoneless times, rounded doubles, lists as text: types that every engine prints alike."""
    out = []
    for field in df.schema:
        c, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        if kind == "timestamp":
            c = c.cast("timestamp_ntz")
        elif kind in ("float", "double"):
            c = F.round(c.cast("double"), DIGITS)
        elif kind.startswith("array"):
            c = F.array_join(c.cast("array<string>"), " ")
        out.append(c.alias(field.name))
    return df.select(*out)


T = views.table


def _matrix(spark, d):
    return T(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("i"), F.col("l_partkey").alias("j"), F.col("l_quantity").alias("v")
    )


def _prices(spark, d):
    return T(spark, d, "part").select(
        F.col("p_partkey").alias("j"), F.col("p_size").alias("k"), F.col("p_retailprice").alias("w")
    )


def _price_vector(spark, d):
    return T(spark, d, "part").select(F.col("p_partkey").alias("index"), F.col("p_retailprice").alias("value"))


def _embedding_entries(spark, d):
    return T(spark, d, "embeddings").select(
        F.col("vec_id").alias("i"), F.posexplode("embedding").alias("j", "v")
    ).select("i", "j", F.col("v").cast("double").alias("v"))


def _label_means(spark, d):
    entries = T(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("j", "v"))
    return entries.groupBy("j", F.col("label").alias("k")).agg(F.avg(F.col("v").cast("double")).alias("w"))


def _dimension_means(spark, d):
    return _embedding_entries(spark, d).groupBy(F.col("j").alias("index")).agg(F.avg("v").alias("value"))


def _segments_of_people(spark, d):
    """Mean order value per priority through user functions on batches."""
    def mapped(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"priority": pdf["o_orderpriority"], "total": pdf["o_totalprice"], "n": 1})

    def combined(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby("priority", as_index=False)[["total", "n"]].sum()

    def reduced(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {"priority": [pdf["priority"].iloc[0]], "mean_price": [pdf["total"].sum() / pdf["n"].sum()], "n": [pdf["n"].sum()]}
        )

    orders = T(spark, d, "orders").select("o_orderpriority", "o_totalprice")
    return mapreduce.map_reduce(
        orders, mapped, combined, reduced, ["priority"],
        "priority STRING, total DOUBLE, n BIGINT", "priority STRING, mean_price DOUBLE, n BIGINT",
    )


def _customer_nations(spark, d):
    return T(spark, d, "customer").select(F.col("c_nationkey").alias("nation"))


def _supplier_nations(spark, d):
    return T(spark, d, "supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("nation"))


def _csv_scan(spark, d):
    path = shared_folder(spark, "trips-csv")
    views.trips(spark, d).write.csv(path, header=True)
    return connectors.read_trips(spark, path)


def _posts(spark, d):
    return posts.parse_posts(views.post_lines(spark, d))


def _language_counts(spark, d):
    return languages.language_counts(posts.post_tags(_posts(spark, d)), views.languages(spark, d), 1995, 2001)


def _parquet_roundtrip(spark, d):
    path = connectors.write_parquet(
        languages.top_languages(_language_counts(spark, d)), shared_folder(spark, "top-languages")
    )
    return spark.read.parquet(path)


def _ride_lines(spark, d):
    return lines.parse_ride_lines(views.rides(spark, d).select(lines.ride_line().alias("value")))


def _fare_lines(spark, d):
    return lines.parse_fare_lines(views.fares(spark, d).select(lines.fare_line().alias("value")))


def _car_lines(spark, d):
    e = T(spark, d, "events")
    blank = F.lit("")
    fields = [blank] * lines.CAR_TOKENS
    fields[0], fields[1] = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    fields[9] = F.when(F.col("event_type") == "view", "0.0").otherwise(F.col("value").cast("string"))
    fields[12] = (F.col("value") % 50).cast("float").cast("string")
    fields[20], fields[21] = F.lit("8.67"), F.lit("49.87")
    fields[22] = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    half = lines.CAR_TOKENS // 2
    text = F.concat_ws(", ", F.concat_ws(",", *fields[:half]), F.concat_ws("; ", *fields[half:]))
    return lines.parse_car_lines(e.select(text.alias("value")))


def _location_queries(spark):
    return views.location_queries(spark)


def _control(spark):
    return spark.createDataFrame(CONTROL_ROWS, "query_id BIGINT, lon FLOAT, lat FLOAT, ts TIMESTAMP")


def _popular_places_sql(spark, d):
    p = rides.popular_places_sql(spark, views.rides(spark, d))
    return p.select(F.col("location.lon").alias("lon"), F.col("location.lat").alias("lat"), "wstart", "wend", "is_start", "pop_cnt")


def _named_rides(spark, d):
    path = shared_folder(spark, "ride-files")
    views.rides(spark, d).select(lines.ride_line()).write.text(path, compression="gzip")
    return named.read_named(spark, "taxi-rides", path=path).drop("event_time")


def _bike_sketch(spark, d):
    """The exact number, and whether the one from merged sketches of zip codes is within 2 %."""
    trips = views.trips(spark, d)
    about = bikes.bikes_of_sketches(bikes.bike_sketches(trips, "zip_code")).withColumnRenamed("n", "about")
    both = bikes.count_bikes(trips).join(F.broadcast(about), F.lit(True))
    return both.select("n", (F.abs(F.col("about") - F.col("n")) <= 0.02 * F.col("n")).alias("near"))


def _in_place(sorted_rows):
    """The number of each row in the order in which an operator returned them."""
    return events.positions(sorted_rows, [], ["place"]).drop("place")


def _offsets_in_key(spark, d):
    """How far behind the first row of its key a row lies: keys are together and in order only if they were sorted."""
    placed = relational.partition_sorted(T(spark, d, "orders").select("o_custkey", "o_orderkey"), "o_custkey", ["o_orderkey"])
    first = F.min("place").over(Window.partitionBy("o_custkey", "partition_id"))
    return placed.select("o_custkey", "o_orderkey", (F.col("place") - first).alias("offset_in_key"))


BATCH: dict[str, Query] = {
    # relational algebra
    "selection": lambda s, d: relational.selection(
        T(s, d, "customer").select("c_custkey", "c_acctbal"), F.col("c_acctbal") > 10
    ),
    "projection_distinct": lambda s, d: relational.projection(T(s, d, "customer"), ["c_nationkey", "c_mktsegment"]),
    "set_union": lambda s, d: relational.union_distinct(_customer_nations(s, d), _supplier_nations(s, d)),
    "set_union_all": lambda s, d: relational.union_all(_customer_nations(s, d), _supplier_nations(s, d)),
    "set_intersect": lambda s, d: relational.intersection(_customer_nations(s, d), _supplier_nations(s, d)),
    "set_difference": lambda s, d: relational.difference(
        T(s, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")),
        _supplier_nations(s, d).select("nation", F.lit("MACHINERY").alias("segment")),
    ),
    "repeated_values": lambda s, d: relational.repeated_values(
        T(s, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice"
    ),
    "dedup_first": lambda s, d: relational.first_per_key(
        T(s, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], ["o_orderkey"]
    ),
    "natural_join": lambda s, d: relational.natural_join(
        T(s, d, "orders").select(F.col("o_orderkey").alias("a"), F.col("o_custkey").alias("b")),
        T(s, d, "customer").select(F.col("c_custkey").alias("b"), F.col("c_nationkey").alias("c")),
    ),
    "mean_by_group": lambda s, d: relational.mean_by_group(
        T(s, d, "customer"), F.col("c_mktsegment") == "MACHINERY", "c_nationkey", "c_acctbal", "mean_balance"
    ),
    "global_max": lambda s, d: relational.total(T(s, d, "orders"), max_price=F.max("o_totalprice")),
    "global_mean": lambda s, d: relational.total(T(s, d, "orders"), mean_price=F.avg("o_totalprice")),
    "group_sum": lambda s, d: relational.group_aggregate(T(s, d, "orders"), ["o_custkey"], sum_price=F.sum("o_totalprice")),
    "group_max": lambda s, d: relational.group_aggregate(T(s, d, "orders"), ["o_custkey"], max_price=F.max("o_totalprice")),
    "group_collect": lambda s, d: relational.group_values(T(s, d, "orders"), "o_orderpriority", "o_custkey", "o_orderkey"),
    "partition_sorted": _offsets_in_key,
    "range_sort": lambda s, d: _in_place(
        relational.range_sort(T(s, d, "orders").select("o_totalprice", "o_orderkey"), ["o_totalprice", "o_orderkey"])
    ),
    "increment_map": lambda s, d: relational.increment(T(s, d, "orders").select("o_orderkey"), "o_orderkey"),
    "map_reduce_udf": _segments_of_people,
    # text
    "word_count": lambda s, d: documents.word_count(T(s, d, "documents").select("text")),
    "inverted_index": lambda s, d: documents.inverted_index(T(s, d, "documents").select("doc_id", "text")),
    # matrices
    "matvec_broadcast": lambda s, d: matrix.matrix_vector_in_memory(_embedding_entries(s, d), _dimension_means(s, d)),
    "matvec_join": lambda s, d: matrix.matrix_vector(_matrix(s, d), _price_vector(s, d)),
    "matmul_broadcast": lambda s, d: matrix.matrix_product_in_memory(_embedding_entries(s, d), _label_means(s, d)),
    "matmul_join": lambda s, d: matrix.matrix_product(_matrix(s, d), _prices(s, d)),
    # bikes
    "csv_scan": _csv_scan,
    "bike_max_duration": lambda s, d: bikes.longest_bike(views.trips(s, d)),
    "farthest_stations": lambda s, d: bikes.farthest_stations(views.stations(s, d)),
    "bike_path": lambda s, d: bikes.bike_path(views.trips(s, d)),
    "count_bikes": lambda s, d: bikes.count_bikes(views.trips(s, d)),
    "count_bikes_sketch": _bike_sketch,
    "users_over_3h": lambda s, d: bikes.zip_codes_over(views.trips(s, d)),
    # languages
    "posts_xml_parse": _posts,
    "language_counts": _language_counts,
    "language_top10": lambda s, d: languages.top_languages(_language_counts(s, d)),
    "parquet_sink_roundtrip": _parquet_roundtrip,
    # text forms
    "ride_lines_parse": _ride_lines,
    "fare_lines_parse": _fare_lines,
    "car_lines_parse": _car_lines,
    "ride_value_roundtrip": lambda s, d: lines.from_ride_values(lines.to_ride_values(views.rides(s, d))),
    "taxi_rides_source": _named_rides,
    "rides_table_view": lambda s, d: rides.rides_table(views.rides(s, d)),
    "trips_to_ride_events": lambda s, d: _in_place(raw.trip_events(views.raw_trip_lines(s, d))),
    "raw_fares_normalize": lambda s, d: raw.fare_records(views.raw_fare_lines(s, d)),
    # rides
    "ride_cleansing": lambda s, d: rides.ride_cleansing(views.rides(s, d)),
    "rides_and_fares": lambda s, d: rides.rides_and_fares(views.rides(s, d), views.fares(s, d)),
    "unmatched_fares": lambda s, d: rides.unmatched_fares(views.rides(s, d), views.fares(s, d)),
    "unmatched_rides": lambda s, d: rides.unmatched_rides(views.rides(s, d), views.fares(s, d)),
    "unmatched_sides": lambda s, d: rides.unmatched_sides(views.rides(s, d), views.fares(s, d)),
    "hourly_tips": lambda s, d: rides.hourly_tips(views.fares(s, d)),
    "hourly_top_tips": lambda s, d: rides.hourly_top_tips(views.fares(s, d)),
    "popular_places": lambda s, d: rides.popular_places(views.rides(s, d)),
    "popular_places_sql": _popular_places_sql,
    "rides_per_hour": lambda s, d: rides.rides_per_hour(views.rides(s, d)),
    "ride_count": lambda s, d: rides.ride_count(views.rides(s, d)),
    "ride_count_running": lambda s, d: rides.ride_count_running(views.rides(s, d)),
    "long_rides": lambda s, d: rides.long_rides(views.rides(s, d)),
    "long_rides_nyc": lambda s, d: rides.long_rides(views.rides(s, d), nyc_only=True),
    "nearest_taxi": lambda s, d: rides.nearest_taxi(views.rides(s, d), _location_queries(s)),
    "nearest_taxi_improvements": lambda s, d: rides.nearest_taxi_improvements(views.rides(s, d), _location_queries(s)),
    "nearest_taxi_expiring": lambda s, d: control.nearest_taxi_expiring(views.rides(s, d), _control(s)),
    "ongoing_rides": lambda s, d: rides.ongoing_rides(views.rides(s, d), views.thresholds(s), F.lit(WATERMARK)),
    "taxi_query": lambda s, d: control.taxi_query(views.rides(s, d), TAXI_QUERIES),
    "latest_ride_per_taxi": lambda s, d: events.latest_per_key(views.rides(s, d)),
    "travel_time_prediction": lambda s, d: rides.travel_time_prediction(views.rides(s, d)),
    "route_cell_traffic": lambda s, d: rides.route_cell_traffic(views.rides(s, d)),
    "route_cell_traffic_sql": lambda s, d: rides.route_cell_traffic_sql(s, views.rides(s, d)),
    # cars and events
    "driving_sessions": lambda s, d: events.sessions(views.cars(s, d), SESSION_GAP),
    "driving_segments": lambda s, d: events.driving_segments(views.cars(s, d)),
    "driving_segments_strict": lambda s, d: events.driving_segments(views.cars(s, d), strict=True),
    "car_event_sort": lambda s, d: cars.on_time_sorted(views.cars(s, d), CAR_DELAY),
    "stream_sort": lambda s, d: _in_place(cars.sorted_stream(views.cars(s, d), CAR_DELAY)),
    "late_events": lambda s, d: cars.late_count(views.cars(s, d), CAR_DELAY),
    "events_per_user_second": lambda s, d: cars.events_per_second(views.cars(s, d), CAR_DELAY),
    "rule_pair_match": lambda s, d: events.rule_pairs(views.items(s, d), views.rules(s)),
    # trades
    "asof_enrich": lambda s, d: events.asof_customers(views.trades(s, d), views.customer_changes(s, d)),
}


# Rows far in the future that pass every filter of the streaming queries and have ids no record has.
_FAR = (FLUSH_TIME, FLUSH_TIME, -73.9, 40.75, -73.9, 40.75, 1, -1, -1)
RIDE_FLUSH = [(-1, True, *_FAR), (-1, False, *_FAR)]
FARE_FLUSH = [(-2, -1, -1, FLUSH_TIME, "", 0.0, 0.0, 0.0)]
CAR_FLUSH = [(-1, -1, FLUSH_TIME, FLUSH_TIME, 1.0, 0.0)]


class Replayed:
    """The warehouse tables as flushed streams, in several steps of time."""

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self.spark, self.folder, self.replay = spark, folder, Replay(spark, name)

    def plain_rides(self) -> DataFrame:
        return self.replay.stepped(events.with_event_time(views.rides(self.spark, self.folder)), "event_time").drop("event_time")

    def rides(self) -> DataFrame:
        return self.replay.flushed(self.plain_rides(), RIDE_FLUSH)

    def fares(self) -> DataFrame:
        return self.replay.flushed(self.replay.stepped(views.fares(self.spark, self.folder), "start_time"), FARE_FLUSH)

    def cars(self, order: str = "ts") -> DataFrame:
        return self.replay.flushed(self.replay.stepped(views.cars(self.spark, self.folder), order), CAR_FLUSH)

    def items(self, shape: str) -> DataFrame:
        records = T(self.spark, self.folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
        return self.replay.flushed(self.replay.stepped(views.items_of(records, "ts"), "ts"), [(-1, shape, -1, FLUSH_TIME)])


def _append(name: str, build: Callable[[Replayed, SparkSession], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        r = Replayed(spark, folder, name)
        return r.replay.to_table(build(r, spark))

    return run


def _stream_ride_count(spark, d):
    # No flush: running totals wait for nothing.
    r = Replayed(spark, d, "ride-count")
    return r.replay.latest(stream.ride_count(r.plain_rides()), ["driver_id"])


def _message(at: datetime, *parts) -> tuple[datetime, str]:
    return at, "|".join(map(str, (at, *parts)))


def _steered(spark, d, name: str, messages: list[tuple[datetime, str]], **answer) -> DataFrame:
    """Answers over the rides, to messages that arrive between them."""
    timed = events.with_event_time(views.rides(spark, d))
    return Replay(spark, name).steered(timed, "event_time", messages, lambda home: steered.Steered(home, **answer))


def _stream_nearest_taxi(spark, d):
    asked = [_message(at, "location", i, lon, lat) for i, lon, lat, at in CONTROL_ROWS if lon]
    return steered.nearest(_steered(spark, d, "nearest-taxi", asked, out_schema=steered.REPORT, on_events=steered.reports))


def _stream_ongoing_rides(spark, d):
    asked = [_message(at, "threshold", n) for at, n in THRESHOLDS]
    return _steered(
        spark, d, "ongoing-rides", asked, out_schema=f"{schemas.RIDE}, n BIGINT, asked_at TIMESTAMP", on_control=steered.ongoing_rides
    )


def _stream_taxi_query(spark, d):
    asked = [_message(at, "predicate", text) for at, text in TAXI_QUERIES]
    return _steered(
        spark, d, "taxi-query", asked, out_schema=steered.ANSWER, on_control=steered.asked_of_kept, on_events=steered.asked_of_events
    )


def _stream_expiring(spark, d):
    active = control.active_queries(_control(spark))
    r = Replayed(spark, d, "nearest-expiring")
    reports = control.active_reports(r.plain_rides(), active)
    flushed = r.replay.flushed(reports, [(-1, -1, -1, FLUSH_TIME, 0.0)])
    return r.replay.steps(
        flushed, "event_time", stream.EVENT_DELAY, steps.closest_step(), steps.REPORT_CARRY,
        "query_id BIGINT, taxi_id BIGINT, event_time TIMESTAMP, distance FLOAT",
    )


def _stream_segments(strict: bool) -> Query:
    def run(spark, d):
        r = Replayed(spark, d, "segments")
        return r.replay.steps(
            r.cars(), "ts", STREAM_CAR_DELAY, steps.segments_step(strict), steps.SEGMENT_CARRY,
            "car_id BIGINT, start_time TIMESTAMP, length BIGINT, max_speed INT, erraticness DOUBLE, label STRING",
        )

    return run


def _stream_positions(spark, d):
    return _sorted_cars(spark, d, "car-sort")[0]


def _sorted_cars(spark, d, name):
    """On-time events in order, and the late ones, of cars that are heard in order of arrival."""
    r = Replayed(spark, d, name)
    source = r.cars("arrival")
    on_time = r.replay.steps(
        source, "ts", CAR_DELAY, steps.positions_step(), steps.POSITION_CARRY,
        "car_id BIGINT, event_id BIGINT, ts TIMESTAMP, arrival TIMESTAMP, speed DOUBLE, throttle DOUBLE, pos BIGINT",
        ("arrival", "event_id"),
    )
    return on_time.filter("event_id >= 0"), r.replay.late(source.schema)


def _stream_late(spark, d):
    """All windows of processing time together."""
    r = Replayed(spark, d, "late")
    found = late.LateRows(r.replay.home, "ts", CAR_DELAY, ("arrival", "event_id"))
    r.replay.batches(r.replay.stepped(views.cars(spark, d), "arrival"), found)
    return found.counts(spark).groupBy("tag").agg(F.sum("cnt").alias("cnt"))


def _stream_per_second(spark, d):
    on_time = _sorted_cars(spark, d, "per-second")[0]
    counts = on_time.groupBy("car_id", F.window("ts", "1 second").alias("w")).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.select(F.col("car_id").alias("user_id"), F.col("w.start").alias("window_start"), "cnt")


def _stream_tagged(spark, d):
    on_time, behind = _sorted_cars(spark, d, "tagged")
    both = on_time.drop("pos").withColumn("output_tag", F.lit("sorted")).unionByName(behind.withColumn("output_tag", F.lit("late")))
    return _in_place(relational.range_sort(both, ["ts", "event_id"]))


def _stream_predictions(spark, d):
    r = Replayed(spark, d, "prediction")
    return r.replay.steps(
        steps.prediction_rows(r.rides()), "event_time", stream.EVENT_DELAY, steps.predictions_step(), steps.PREDICTION_CARRY,
        "ride_id BIGINT, predicted_minutes INT",
    )


def _stream_pairs(spark, d):
    r = Replayed(spark, d, "rule-pairs")
    return r.replay.steps(
        steps.pair_rows(r.items("view"), views.rules(spark)), "ts", STREAM_CAR_DELAY, steps.pairs_step(), steps.PAIR_CARRY,
        "rule STRING, color BIGINT, first_seq BIGINT, second_seq BIGINT",
    )


def _stream_places_sql(spark, d):
    r = Replayed(spark, d, "places-sql")
    p = r.replay.to_table(stream.popular_places_sql(r.rides()))
    return p.select(F.col("location.lon").alias("lon"), F.col("location.lat").alias("lat"), "wstart", "wend", "is_start", "pop_cnt")


def _stream_place_changes(spark, d):
    """What a log of changes to the popular places comes to."""
    r = Replayed(spark, d, "place-changes")
    log = sinks.ChangeLog(r.replay.home, stream.PLACE_KEYS, stream.PLACE_CHANGES, lambda: F.col("cnt") >= 20, parts=4)
    r.replay.batches(stream.place_changes(r.plain_rides()), log, "update")
    place = geo.cell_center(F.col("cell"))
    found = sinks.folded(log.log(spark), stream.PLACE_KEYS)
    return found.select(place["lon"].alias("lon"), place["lat"].alias("lat"), "window_end", "is_start", "cnt")


def _stream_tagged_sinks(spark, d):
    """Rides split into a folder for those inside New York and one for the others."""
    r = Replayed(spark, d, "sinks")
    folders = {tag: f"{r.replay.home}/{tag}" for tag in ("inside", "outside")}
    r.replay.batches(stream.fenced(r.plain_rides()), sinks.TaggedSinks(folders))
    read = [spark.read.schema(schemas.RIDE).parquet(f"{f}/batch=*").withColumn("output_tag", F.lit(tag)) for tag, f in folders.items()]
    return read[0].unionByName(read[1])


def _stream_open_hours(spark, d):
    """Hours that wait in the state for fares still to come, read back from the checkpoint."""
    r = Replayed(spark, d, "open-hours")
    fares = r.replay.stepped(views.fares(spark, d), "start_time")
    r.replay.to_table(stream.hourly_tips(fares))
    kept = r.replay.state().select("key.*", F.col("value.sum").alias("sum_tips"))
    return kept.select(F.col("window.end").alias("window_end"), "driver_id", "sum_tips")


def _stream_cleansing(spark, d):
    r = Replayed(spark, d, "cleansing")
    return r.replay.to_table(stream.ride_cleansing(r.plain_rides()))


STREAMS: dict[str, Query] = {
    "stream_ride_cleansing": _stream_cleansing,
    "stream_hourly_tips": _append("hourly-tips", lambda r, s: stream.hourly_tips(r.fares())),
    "stream_hourly_top_tips": _append("hourly-top", lambda r, s: stream.hourly_top_tips(r.fares())),
    "stream_popular_places": _append("popular", lambda r, s: stream.popular_places(r.rides())),
    "stream_popular_places_sql": _stream_places_sql,
    "stream_popular_places_changes": _stream_place_changes,
    "stream_tagged_sinks": _stream_tagged_sinks,
    "stream_open_hours": _stream_open_hours,
    "stream_rides_per_hour": _append("per-hour", lambda r, s: stream.rides_per_hour(r.rides())),
    "stream_ride_count": _stream_ride_count,
    "stream_rides_and_fares": _append(
        "rides-fares", lambda r, s: stream.rides_and_fares(r.rides(), r.fares(), PAIR_BOUND)
    ),
    "stream_unmatched_fares": _append(
        "unmatched-fares", lambda r, s: stream.unmatched_fares(r.rides(), r.fares(), PAIR_BOUND)
    ),
    "stream_unmatched_rides": _append(
        "unmatched-rides", lambda r, s: stream.unmatched_rides(r.rides(), r.fares(), PAIR_BOUND)
    ),
    "stream_long_rides": _append("long-rides", lambda r, s: stream.long_rides(r.rides())),
    "stream_nearest_taxi": _stream_nearest_taxi,
    "stream_nearest_taxi_expiring": _stream_expiring,
    "stream_ongoing_rides": _stream_ongoing_rides,
    "stream_taxi_query": _stream_taxi_query,
    "stream_travel_time_prediction": _stream_predictions,
    "stream_driving_sessions": _append(
        "sessions", lambda r, s: stream.driving_sessions(r.cars(), "6 hours", STREAM_CAR_DELAY)
    ),
    "stream_driving_segments": _stream_segments(False),
    "stream_driving_segments_strict": _stream_segments(True),
    "stream_car_event_sort": _stream_positions,
    "stream_late_events": _stream_late,
    "stream_events_per_user_second": _stream_per_second,
    "stream_sort_tagged": _stream_tagged,
    "stream_rule_pair_match": _stream_pairs,
}


def bound(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(query(prepare(spark), sf_dir))

    return run
