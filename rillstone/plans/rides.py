"""Taxi ride and fare queries on bounded tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions import geo
from rillstone.functions.text import whole_minutes
from rillstone.operators.events import event_time, in_box_both_ends, latest_per_key, relevant_cell, with_event_time
from rillstone.operators.joins import with_every_row
from rillstone.operators.ordered import running, slice_groups
from rillstone.schemas import FARE_COLUMNS, RIDE_COLUMNS

LONG_RIDE = "2 HOURS"
RESERVED_STEP = 1000


def ride_cleansing(rides: DataFrame) -> DataFrame:
    """Rides that start and end inside New York City."""
    return rides.filter(in_box_both_ends())


def starts(rides: DataFrame, drop_reserved: bool = False) -> DataFrame:
    """START events; optionally without the rides whose id is a multiple of 1000."""
    picked = rides.filter("is_start")
    return picked.filter(F.col("ride_id") % RESERVED_STEP != 0) if drop_reserved else picked


def _fares_apart(fares: DataFrame) -> DataFrame:
    return fares.select(*[F.col(c).alias(f"fare_{c}") for c in FARE_COLUMNS])


def same_ride(bound: str | None) -> Column:
    """A ride and a fare (its columns prefixed) of one id, with a ``bound`` no further apart than that in time."""
    same = F.col("ride_id") == F.col("fare_ride_id")
    if bound is None:
        return same
    near = f"fare_start_time BETWEEN start_time - INTERVAL {bound} AND start_time + INTERVAL {bound}"
    return same & F.expr(near)


def rides_and_fares(rides: DataFrame, fares: DataFrame, bound: str | None = None) -> DataFrame:
    """START rides with their fares; fare columns are prefixed with ``fare_``.

    With a ``bound`` (as "1 HOUR") pairs that start further apart do not count. A stream needs one, a table does not.
    """
    return starts(rides).join(_fares_apart(fares), same_ride(bound))


def unmatched_fares(rides: DataFrame, fares: DataFrame, bound: str | None = None) -> DataFrame:
    """Fares without a START ride; rides with an id that is a multiple of 1000 count as absent."""
    lonely = _fares_apart(fares).join(starts(rides, True).select("ride_id", "start_time"), same_ride(bound), "left_anti")
    return lonely.select(*[F.col(f"fare_{c}").alias(c) for c in FARE_COLUMNS])


def unmatched_rides(rides: DataFrame, fares: DataFrame, bound: str | None = None) -> DataFrame:
    return starts(rides, True).join(_fares_apart(fares).select("fare_ride_id", "fare_start_time"), same_ride(bound), "left_anti")


def unmatched_sides(rides: DataFrame, fares: DataFrame, bound: str | None = None) -> DataFrame:
    """Both kinds of unmatched rows, told apart by ``output_tag``.

    Two anti joins rather than one full join: adaptive execution can split a skewed anti join.
    """

    def tagged(rows: DataFrame, tag: str) -> DataFrame:
        return rows.select(F.lit(tag).alias("output_tag"), "ride_id", "taxi_id")

    lonely_fares = tagged(unmatched_fares(rides, fares, bound), "unmatched_fare")
    return lonely_fares.unionByName(tagged(unmatched_rides(rides, fares, bound), "unmatched_ride"))


def hourly_tips(fares: DataFrame) -> DataFrame:
    """Tips per driver and hour."""
    per = fares.groupBy(F.window("start_time", "1 hour").alias("w"), "driver_id")
    return per.agg(F.sum(F.col("tip").cast("double")).alias("sum_tips")).select(
        F.col("w.end").alias("window_end"), "driver_id", "sum_tips"
    )


def hourly_top_tips(fares: DataFrame) -> DataFrame:
    """The driver with the largest tips of every hour; on a tie the smallest id."""
    best = F.max_by(F.struct("driver_id", "sum_tips"), F.struct(F.col("sum_tips"), -F.col("driver_id")))
    return hourly_tips(fares).groupBy("window_end").agg(best.alias("_b")).select("window_end", "_b.*")


def _sliding_counts(rides: DataFrame) -> DataFrame:
    """Counts per cell, direction and 15-minute window sliding by 5 minutes.

    Events are counted once per 5-minute step; each step is then added to its three windows.
    """
    events = ride_cleansing(rides).select(relevant_cell().alias("cell"), "is_start", event_time().alias("event_time"))
    steps = events.groupBy("cell", "is_start", F.window("event_time", "5 minutes").alias("w")).agg(
        F.count(F.lit(1)).alias("n")
    )
    ends = F.array(*[F.col("w.end") + F.expr(f"INTERVAL {m} MINUTES") for m in (0, 5, 10)])
    spread = steps.select("cell", "is_start", "n", F.explode(ends).alias("window_end"))
    return spread.groupBy("cell", "is_start", "window_end").agg(F.sum("n").alias("cnt"))


def popular_places(rides: DataFrame, threshold: int = 20, inclusive: bool = True) -> DataFrame:
    """Cells with many departures or arrivals in a window."""
    enough = F.col("cnt") >= threshold if inclusive else F.col("cnt") > threshold
    place = geo.cell_center(F.col("cell"))
    return _sliding_counts(rides).filter(enough).select(
        place["lon"].alias("lon"), place["lat"].alias("lat"), "window_end", "is_start", "cnt"
    )


POPULAR_PLACES_SQL = """
WITH visits AS (
  SELECT if(is_start, toCellId(start_lon, start_lat), toCellId(end_lon, end_lat)) AS place, is_start,
         window(event_time, '15 minutes', '5 minutes') AS pane
  FROM {rides} WHERE isInNYC(start_lon, start_lat) AND isInNYC(end_lon, end_lat)
)
SELECT toCoords(place) AS location, pane.start AS wstart, pane.end AS wend, is_start, count(*) AS pop_cnt
FROM visits GROUP BY place, is_start, pane HAVING count(*) > {threshold}
"""


def popular_places_sql(spark: SparkSession, rides: DataFrame, threshold: int = 20) -> DataFrame:
    """The same question as SQL text over registered functions; here the threshold is exclusive."""
    geo.register_sql_functions(spark)
    return spark.sql(POPULAR_PLACES_SQL, rides=with_event_time(rides), threshold=threshold)


def rides_per_hour(rides: DataFrame) -> DataFrame:
    counted = with_event_time(rides).groupBy("is_start", F.window("event_time", "1 hour").alias("w"))
    return counted.agg(F.count(F.lit(1)).alias("cnt")).select(F.col("w.start").alias("window_start"), "is_start", "cnt")


def ride_count(rides: DataFrame) -> DataFrame:
    return rides.groupBy("driver_id").agg(F.count(F.lit(1)).alias("cnt"))


EVENT_ORDER = ["event_time", "_end", "ride_id"]


def _in_event_order(rides: DataFrame) -> DataFrame:
    return with_event_time(rides).withColumn("_end", ~F.col("is_start"))


def ride_count_running(rides: DataFrame, max_rows: int | None = None) -> DataFrame:
    """One row per event: how many events the driver has had so far."""
    slim = _in_event_order(rides).select("driver_id", "ride_id", "is_start", "event_time", "_end")
    counted = running(slice_groups(slim, ["driver_id"], EVENT_ORDER, max_rows), {"cnt": ("count", F.lit(1))})
    return counted.rows().select("driver_id", "ride_id", "is_start", "event_time", "cnt")


def long_rides(rides: DataFrame, nyc_only: bool = False) -> DataFrame:
    """START events with no END within two hours; an END after exactly two hours still counts."""
    events = ride_cleansing(rides) if nyc_only else rides
    ends = events.filter(~F.col("is_start")).select(F.col("ride_id").alias("_id"), F.col("end_time").alias("_end"))
    in_time = (F.col("ride_id") == F.col("_id")) & (
        F.col("_end") <= F.col("start_time") + F.expr(f"INTERVAL {LONG_RIDE}")
    )
    return events.filter("is_start").join(ends, in_time, "left_anti")


def ride_ends(rides: DataFrame) -> DataFrame:
    """Where and when taxis have finished a ride."""
    ends = with_event_time(rides).filter(~F.col("is_start"))
    return ends.select("ride_id", "taxi_id", "event_time", "end_lon", "end_lat")


def with_distance(met: DataFrame) -> DataFrame:
    """Ends of rides next to asked locations, with the distance."""
    km = geo.planar_km(F.col("lon"), F.col("lat"), F.col("end_lon"), F.col("end_lat")).cast("float")
    return met.select("query_id", "ride_id", "taxi_id", "event_time", km.alias("distance"))


def distances_to(rides: DataFrame, queries: DataFrame) -> DataFrame:
    """Distance of every finished ride's end to every asked location."""
    return with_distance(with_every_row(ride_ends(rides), queries))


def nearest_taxi(rides: DataFrame, queries: DataFrame) -> DataFrame:
    """The taxi that came closest to each location; on a tie the earliest report."""
    best = F.min_by(F.struct("taxi_id", "distance"), F.struct("distance", "event_time", "ride_id"))
    return distances_to(rides, queries).groupBy("query_id").agg(best.alias("_b")).select("query_id", "_b.*")


def nearest_taxi_improvements(
    rides: DataFrame, queries: DataFrame, step: str = "5 minutes", max_rows: int | None = None
) -> DataFrame:
    """Reports that beat every earlier one of their location, in event-time order.

    The best distance per time step is found first. A report that does not beat the steps before its
    own is dropped before any rows are shuffled and ordered.
    """
    reports = distances_to(rides, queries).withColumn("_step", F.window("event_time", step)["start"])
    per_step = reports.groupBy("query_id", "_step").agg(F.min("distance").alias("_low"))
    steps = slice_groups(per_step, ["query_id"], ["_step"], max_rows)
    before = running(steps, {"_best": ("min", F.col("_low"))}, inclusive=False).rows().drop("_low")
    hopeful = reports.join(before, ["query_id", "_step"]).filter(
        F.col("_best").isNull() | (F.col("distance") < F.col("_best"))
    )
    s = slice_groups(hopeful.drop("_best", "_step"), ["query_id"], ["event_time", "ride_id"], max_rows)
    s = running(s, {"_best": ("min", F.col("distance"))}, inclusive=False)
    better = s.rows().filter(F.col("_best").isNull() | (F.col("distance") < F.col("_best")))
    return better.select("query_id", "taxi_id", "event_time", "distance")


def ongoing_rides(rides: DataFrame, thresholds: DataFrame, watermark: Column) -> DataFrame:
    """Per threshold ``n``: taxis whose newest event up to the watermark is a START at least ``n`` whole minutes old."""
    latest = latest_per_key(rides.filter(event_time() <= watermark)).filter("is_start")
    waiting = with_every_row(latest, thresholds)
    return waiting.filter(whole_minutes(F.col("start_time"), watermark) >= F.col("n"))


def travel_time_prediction(rides: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Predicted minutes of each starting ride, from the finished rides before it.

    Per arrival cell and sector of approach, minutes are proportional to distance; the factor is
    fitted to the rides seen so far. With fewer than two of them the answer is -1. Minutes are
    rounded to nine digits before they are cut, so the order of additions cannot change them.
    """
    km = geo.planar_km(F.col("start_lon"), F.col("start_lat"), F.col("end_lon"), F.col("end_lat"))
    degrees = geo.direction_degrees(F.col("end_lon"), F.col("end_lat"), F.col("start_lon"), F.col("start_lat"))
    events = _in_event_order(ride_cleansing(rides)).select(
        "ride_id", "is_start", "event_time", "_end",
        geo.cell_id(F.col("end_lon"), F.col("end_lat")).alias("cell"),
        geo.direction_bucket(degrees).alias("sector"),
        km.alias("km"),
        ((F.unix_millis("end_time") - F.unix_millis("start_time")) / F.lit(60000.0)).alias("minutes"),
    )
    s = slice_groups(events, ["cell", "sector"], EVENT_ORDER, max_rows)
    done = F.col("_end")
    s = running(
        s,
        {
            "_n": ("count", F.when(done, 1)),
            "_xy": ("sum", F.when(done, F.col("km") * F.col("minutes"))),
            "_xx": ("sum", F.when(done, F.col("km") * F.col("km"))),
        },
        inclusive=False,
    )
    guess = F.when((F.col("_n") >= 2) & (F.col("_xx") > 0), F.round(F.col("_xy") / F.col("_xx") * F.col("km"), 9).cast("int"))
    return s.rows().filter("is_start").select("ride_id", F.coalesce(guess, F.lit(-1)).alias("predicted_minutes"))


def _ways(rides: DataFrame) -> DataFrame:
    """Rides per pair of grid cells, so that a way is worked out once."""
    return starts(ride_cleansing(rides)).groupBy(
        geo.grid_x(F.col("start_lon")).alias("x1"), geo.grid_y(F.col("start_lat")).alias("y1"),
        geo.grid_x(F.col("end_lon")).alias("x2"), geo.grid_y(F.col("end_lat")).alias("y2"),
    ).agg(F.count(F.lit(1)).alias("n"))


def route_cell_traffic(rides: DataFrame) -> DataFrame:
    """How many rides cross each grid cell on the straight way from start to end."""
    cells = _ways(rides).select("n", F.explode(F.expr(geo.WAY_CELLS)).alias("cell"))
    return cells.groupBy("cell").agg(F.sum("n").alias("rides"))


ROUTE_CELLS_SQL = """
SELECT cell, sum(n) AS rides FROM {ways} AS w, LATERAL cellsOnWay(w.x1, w.y1, w.x2, w.y2) GROUP BY cell
"""


def route_cell_traffic_sql(spark: SparkSession, rides: DataFrame) -> DataFrame:
    """The same question as SQL text over the table function ``cellsOnWay``."""
    geo.register_sql_functions(spark)
    return spark.sql(ROUTE_CELLS_SQL, ways=_ways(rides))


def rides_table(rides: DataFrame) -> DataFrame:
    """The table form of ride events: event time in place of start and end."""
    shaped = with_event_time(rides)
    return shaped.select(*[c for c in RIDE_COLUMNS if c not in ("start_time", "end_time")], "event_time")

