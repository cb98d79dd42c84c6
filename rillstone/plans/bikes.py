"""Bike-trip reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions.geo import EARTH_RADIUS_KM, haversine_km
from rillstone.session import shared_folder

THREE_HOURS = 10_800
# 2^14 registers of a sketch.
SKETCH_BITS = 14


def longest_bike(trips: DataFrame) -> DataFrame:
    """The bike with the largest total duration; on a tie the smallest id."""
    totals = trips.groupBy("bike_id").agg(F.sum("duration").alias("total_duration"))
    return totals.orderBy(F.desc("total_duration"), "bike_id").limit(1)


def bike_path(trips: DataFrame) -> DataFrame:
    """Distinct start and end stations of the longest-running bike (a one-row broadcast)."""
    bike = longest_bike(trips).select("bike_id")
    return trips.join(F.broadcast(bike), "bike_id").select("start_station_name", "end_station_name").distinct()


def count_bikes(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count_distinct("bike_id").alias("n"))


def bike_sketches(trips: DataFrame, by: str) -> DataFrame:
    """A sketch of the bikes of each group, for distinct counts that add up over groups; it has a fixed size."""
    return trips.groupBy(by).agg(F.hll_sketch_agg("bike_id", F.lit(SKETCH_BITS)).alias("sketch"))


def bikes_of_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """About how many bikes there are in all groups, or for each value of ``by``; the error is about 1 %."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))


def zip_codes_over(trips: DataFrame, seconds: int = THREE_HOURS) -> DataFrame:
    """Zip codes whose trips add up to more than ``seconds``."""
    totals = trips.groupBy("zip_code").agg(F.sum("duration").alias("total_duration"))
    return totals.filter(F.col("total_duration") > seconds).select("zip_code")


# Grid steps of the three refinement levels: cells per axis of the bounding box.
LEVELS = (32, 512, 8192)
# Refining stops when so few station pairs are left that comparing them is cheaper.
FEW_PAIRS = 2_000_000


def farthest_stations(stations: DataFrame, few_pairs: int = FEW_PAIRS) -> DataFrame:
    """The pair of stations with the largest great-circle distance; on a tie the smallest ids.

    Pairs are ruled out cell by cell. A cell is a disc around its middle; the distance of two discs
    is at most that of their middles plus both radii. Cell pairs that stay below the best known
    distance are dropped, the others are refined up to twice, and only stations of the last
    surviving cell pairs are compared one by one. Only the coarse grid, at most ``LEVELS[0]**2`` cells, meets
    itself; the finer cells meet along surviving parents.
    """
    places = stations.filter(F.col("lat").isNotNull() & F.col("long").isNotNull())
    # Stations at one place are represented by the smallest id.
    places = places.groupBy("lat", "long").agg(F.min(F.struct("id", "name")).alias("_s"))
    box = places.agg(
        F.min("lat").alias("_lat0"), F.max("lat").alias("_lat1"), F.min("long").alias("_lon0"), F.max("long").alias("_lon1")
    )
    placed = places.join(F.broadcast(box), F.lit(True))

    def index(value: str, low: str, high: str, cells: int) -> Column:
        width = F.col(high) - F.col(low)
        share = F.when(width > 0, (F.col(value) - F.col(low)) / width).otherwise(0.0)
        return F.least(F.floor(share * cells), F.lit(cells - 1))

    for level, cells in enumerate(LEVELS):
        number = index("lat", "_lat0", "_lat1", cells) * cells + index("long", "_lon0", "_lon1", cells)
        placed = placed.withColumn(f"c{level}", number.cast("bigint"))
    placed = placed.select("lat", "long", "_s", *[f"c{i}" for i in range(len(LEVELS))])

    pairs = None
    home = shared_folder(stations.sparkSession, "farthest-stations")
    for level in range(len(LEVELS)):
        pairs = _surviving_pairs(placed, level, pairs, f"{home}/level-{level}")
        if (pairs.agg(F.sum("pairs")).collect()[0][0] or 0) <= few_pairs:
            break
    last = f"c{level}"
    a = placed.select(F.col(last).alias("a"), F.col("lat").alias("lat1"), F.col("long").alias("lon1"), F.col("_s").alias("s1"))
    b = placed.select(F.col(last).alias("b"), F.col("lat").alias("lat2"), F.col("long").alias("lon2"), F.col("_s").alias("s2"))
    met = pairs.select("a", "b").join(a, "a").join(b, "b").filter(F.col("s1.id") != F.col("s2.id"))
    km = haversine_km(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    first, second = F.least("s1", "s2"), F.greatest("s1", "s2")
    best = met.agg(
        F.max_by(
            F.struct(first.alias("f"), second.alias("s"), km.alias("km")),
            F.struct(km, -F.least("s1.id", "s2.id"), -F.greatest("s1.id", "s2.id")),
        ).alias("_b")
    ).filter(F.col("_b").isNotNull())
    return best.select(F.col("_b.f.name").alias("station_a"), F.col("_b.s.name").alias("station_b"), F.col("_b.km").alias("km"))


def _surviving_pairs(placed: DataFrame, level: int, parents: DataFrame | None, folder: str) -> DataFrame:
    """Cell pairs ``(a, b)``, ``a <= b``, that may hold the farthest pair.

    The bounds of the pairs are written down, so that the next level does not work them out again.
    """
    cell, parent = f"c{level}", f"c{level - 1}"
    keys = [cell] if parents is None else [cell, parent]
    discs = placed.groupBy(*keys).agg(
        F.min("lat").alias("s"), F.max("lat").alias("n"), F.min("long").alias("w"), F.max("long").alias("e"),
        F.min(F.struct("lat", "long")).alias("p"), F.count(F.lit(1)).cast("double").alias("m"),
    )
    mid_lat, mid_lon = (F.col("s") + F.col("n")) / 2, (F.col("w") + F.col("e")) / 2
    # A latitude step and a longitude step along the widest parallel bound the radius from above.
    widest = F.when((F.col("s") <= 0) & (F.col("n") >= 0), 1.0).otherwise(
        F.greatest(F.cos(F.radians("s")), F.cos(F.radians("n")))
    )
    half = F.radians((F.col("n") - F.col("s")) / 2) + F.radians((F.col("e") - F.col("w")) / 2) * widest
    discs = discs.select(*keys, mid_lat.alias("y"), mid_lon.alias("x"), (half * EARTH_RADIUS_KM).alias("r"), "p", "m")

    def side(name: str) -> DataFrame:
        columns = [F.col(cell).alias(name)] + ([F.col(parent).alias(f"p{name}")] if parents is not None else [])
        return discs.select(*columns, *[F.col(c).alias(f"{c}_{name}") for c in ("y", "x", "r", "p", "m")])

    a, b = side("a"), side("b")
    if parents is None:
        met = a.join(F.broadcast(b), F.col("a") <= F.col("b"))
    else:
        up = parents.select(F.col("a").alias("pa"), F.col("b").alias("pb"))
        met = up.join(a, "pa").join(b, "pb").filter((F.col("pa") != F.col("pb")) | (F.col("a") <= F.col("b")))
    upper = haversine_km(F.col("y_a"), F.col("x_a"), F.col("y_b"), F.col("x_b")) + F.col("r_a") + F.col("r_b")
    known = haversine_km(F.col("p_a.lat"), F.col("p_a.long"), F.col("p_b.lat"), F.col("p_b.long"))
    pairs = (F.col("m_a") * F.col("m_b")).alias("pairs")
    met.select("a", "b", upper.alias("upper"), known.alias("known"), pairs).write.parquet(folder)
    bounded = placed.sparkSession.read.parquet(folder)
    floor = bounded.agg(F.max("known")).collect()[0][0]
    # A slack far below a millimetre keeps rounding from dropping the best pair.
    return bounded.filter(F.col("upper") >= F.lit((floor or 0.0) - 1e-7)).select("a", "b", "pairs")
