"""Text forms of rides, fares and car telemetry: parsing and writing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions.text import TIME_FORMAT, time_text
from rillstone.schemas import FARE, FARE_COLUMNS, RIDE_COLUMNS

# Token positions of a car telemetry line of 23 tokens.
CAR_TOKENS = 23
CAR_STRINGS = {"car_id": 0, "event_id": 1}
CAR_FLOATS = {"longitude": 20, "latitude": 21, "consumption": 7, "speed": 9, "throttle": 12, "engineload": 19}
CAR_TIME = 22
CORRUPT = "_corrupt"

# Plain comma-separated tokens: no quotes, an empty token is null.
_PLAIN = {"quote": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
_RIDE_TOKENS = (
    "ride_id BIGINT, kind STRING, first TIMESTAMP, second TIMESTAMP, start_lon FLOAT, start_lat FLOAT, end_lon FLOAT, "
    f"end_lat FLOAT, passenger_cnt SMALLINT, taxi_id BIGINT, driver_id BIGINT, {CORRUPT} STRING"
)
_FLOATS = ("start_lon", "start_lat", "end_lon", "end_lat", "tip", "tolls", "total_fare", *CAR_FLOATS)


def _tokens(lines: DataFrame, text: Column, schema: str, options: dict[str, str], keep: list[str]) -> DataFrame:
    """Typed tokens of each line. The one-element generator parses a line once for all later uses."""
    parsed = F.from_csv(text, F.lit(schema), {**_PLAIN, **options})
    return lines.select(*keep, "value", F.inline(F.array(parsed)))


def _records(tokens: DataFrame, columns: dict[str, Column], good: Column, strict: bool, keep: list[str]) -> DataFrame:
    """Named columns of good lines. A bad line raises in strict mode, else its text is in ``_corrupt``."""
    for name in columns:
        if name not in _FLOATS:
            good = good & columns[name].isNotNull()
    good = F.coalesce(F.col(CORRUPT).isNull() & good, F.lit(False))
    fields = F.struct(*[(F.coalesce(c, F.lit(0.0).cast("float")) if n in _FLOATS else c).alias(n) for n, c in columns.items()])
    if strict:
        bad = F.raise_error(F.concat(F.lit("Invalid record: "), F.col("value")))
        return tokens.select(*keep, F.when(good, fields).otherwise(bad).alias("_r")).select(*keep, "_r.*")
    marked = tokens.select(*keep, F.when(good, fields).alias("_r"), F.when(~good, F.col("value")).alias(CORRUPT))
    return marked.select(*keep, "_r.*", CORRUPT)


def parse_ride_lines(lines: DataFrame, strict: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Ride events from a ``value`` column. In END lines the two times stand in reverse order."""
    t = _tokens(lines, F.col("value"), _RIDE_TOKENS, {"timestampFormat": TIME_FORMAT}, keep or [])
    start = F.col("kind") == "START"
    columns = {name: F.col(name) for name in RIDE_COLUMNS if name not in ("is_start", "start_time", "end_time")}
    columns["is_start"] = start
    columns["start_time"] = F.when(start, F.col("first")).otherwise(F.col("second"))
    columns["end_time"] = F.when(start, F.col("second")).otherwise(F.col("first"))
    in_order = {name: columns[name] for name in RIDE_COLUMNS}
    return _records(t, in_order, F.col("kind").isin("START", "END"), strict, keep or [])


def parse_fare_lines(lines: DataFrame, strict: bool = True, keep: list[str] | None = None) -> DataFrame:
    t = _tokens(lines, F.col("value"), f"{FARE}, {CORRUPT} STRING", {"timestampFormat": TIME_FORMAT}, keep or [])
    columns = {name: F.col(name) for name in FARE_COLUMNS}
    columns["payment_type"] = F.coalesce("payment_type", F.lit(""))
    return _records(t, columns, F.lit(True), strict, keep or [])


def parse_car_lines(lines: DataFrame, strict: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Car telemetry lines, tokens separated by a comma or semicolon and any blanks."""
    places = {i: f"{n} STRING" for n, i in CAR_STRINGS.items()} | {i: f"{n} FLOAT" for n, i in CAR_FLOATS.items()}
    places[CAR_TIME] = "ts TIMESTAMP"
    schema = ", ".join(places.get(i, f"unused_{i} STRING") for i in range(CAR_TOKENS)) + f", {CORRUPT} STRING"
    text = F.regexp_replace("value", r"[,;]\s*", ",")
    t = _tokens(lines, text, schema, {}, keep or [])
    columns = {n: F.col(n) for n in ("car_id", "event_id", "ts", *CAR_FLOATS)}
    return _records(t, columns, F.lit(True), strict, keep or [])


def ride_line(ride: Column | None = None) -> Column:
    """Text line of a ride, such that parsing it gives the ride back.

    A missing end time is written as 1970-01-01 00:00:00. END lines carry the end time first.
    """
    col = (lambda n: F.col(n)) if ride is None else (lambda n: ride[n])
    epoch = F.lit("1970-01-01 00:00:00")
    start, end = time_text(col("start_time")), F.coalesce(time_text(col("end_time")), epoch)
    is_start = col("is_start")
    return F.concat_ws(
        ",",
        col("ride_id").cast("string"),
        F.when(is_start, "START").otherwise("END"),
        F.when(is_start, start).otherwise(end),
        F.when(is_start, end).otherwise(start),
        *[col(n).cast("string") for n in ("start_lon", "start_lat", "end_lon", "end_lat")],
        *[col(n).cast("string") for n in ("passenger_cnt", "taxi_id", "driver_id")],
    )


def fare_line() -> Column:
    return F.concat_ws(
        ",",
        *[F.col(n).cast("string") for n in ("ride_id", "taxi_id", "driver_id")],
        time_text(F.col("start_time")),
        "payment_type",
        *[F.col(n).cast("string") for n in ("tip", "tolls", "total_fare")],
    )


def to_ride_values(rides: DataFrame) -> DataFrame:
    """Message-bus form: ``key`` and binary ``value``."""
    return rides.select(F.col("ride_id").cast("string").alias("key"), ride_line().cast("binary").alias("value"))


def from_ride_values(messages: DataFrame) -> DataFrame:
    return parse_ride_lines(messages.select(F.col("value").cast("string").alias("value")))
