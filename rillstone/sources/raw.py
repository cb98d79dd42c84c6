"""Raw yearly trip and fare files turned into ride events and fares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.operators.relational import range_sort

# Positions of the wanted columns in the raw files, counted from zero.
TRIP = {"taxi_id": 0, "driver_id": 1, "start": 5, "end": 6, "passengers": 7, "coordinates": (10, 11, 12, 13)}
FARE = (0, 1, 3, 4, 8, 9, 10)
UNKNOWN_TIME = "1970-01-01 00:00:00"


def _fields() -> Column:
    return F.split(F.regexp_replace("value", "\r", ""), ",")


def trip_events(lines: DataFrame, line_no: str = "line_no") -> DataFrame:
    """Two event lines per raw trip in event-time order, ``place`` growing with it; the ride id is the line number."""
    t = _fields()
    at = lambda i: F.get(t, F.lit(i))
    tail = [*[at(i) for i in TRIP["coordinates"]], at(TRIP["passengers"]), at(TRIP["taxi_id"]), at(TRIP["driver_id"])]
    start, end = at(TRIP["start"]), at(TRIP["end"])
    number = F.col(line_no).cast("string")

    def event(kind: str, first: Column, second: Column) -> Column:
        text = F.concat_ws(",", number, F.lit(kind), first, second, *tail)
        return F.struct(first.alias("event_time"), text.alias("value"))

    events = F.array(event("START", start, F.lit(UNKNOWN_TIME)), event("END", end, start))
    return range_sort(lines.select(F.inline(events)), ["event_time", "value"])


def fare_records(lines: DataFrame, line_no: str = "line_no") -> DataFrame:
    """Eight-column fare lines; the ride id is the line number."""
    t = _fields()
    picked = [F.get(t, F.lit(i)) for i in FARE]
    return lines.select(F.concat_ws(",", F.col(line_no).cast("string"), *picked).alias("value"))
