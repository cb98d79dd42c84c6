"""Geography as column expressions. Everything here stays inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The New York City box, its grid and the length of a degree in km.
LON_WEST = -74.05
LON_EAST = -73.7
LAT_SOUTH = 40.5
LAT_NORTH = 41.0
CELL_LON = 0.0014
CELL_LAT = 0.00125
GRID_COLUMNS = 250
DEGREE_KM = 110.25
EARTH_RADIUS_KM = 6371.0
BUCKET_DEGREES = 45


def _double(c: Column) -> Column:
    return c.cast("double")


def in_nyc(lon: Column, lat: Column) -> Column:
    """True inside the box, borders included. NaN counts as outside."""
    return _double(lon).between(LON_WEST, LON_EAST) & _double(lat).between(LAT_SOUTH, LAT_NORTH)


def grid_x(lon: Column) -> Column:
    return F.floor((F.lit(-LON_WEST) - F.abs(_double(lon))) / F.lit(CELL_LON)).cast("int")


def grid_y(lat: Column) -> Column:
    return F.floor((F.lit(LAT_NORTH) - _double(lat)) / F.lit(CELL_LAT)).cast("int")


def cell_id(lon: Column, lat: Column) -> Column:
    """Number of the grid cell, counted row by row from the north-west corner."""
    return grid_x(lon) + grid_y(lat) * F.lit(GRID_COLUMNS)


def cell_center(cell: Column) -> Column:
    """Struct ``(lon FLOAT, lat FLOAT)`` of the middle of a cell."""
    x = cell % F.lit(GRID_COLUMNS)
    y = ((cell - x) / F.lit(GRID_COLUMNS)).cast("int")
    lon = -(F.lit(-LON_WEST) - x * F.lit(CELL_LON) - F.lit(CELL_LON / 2)).cast("float")
    lat = (F.lit(LAT_NORTH) - y * F.lit(CELL_LAT) - F.lit(CELL_LAT / 2)).cast("float")
    return F.struct(lon.alias("lon"), lat.alias("lat"))


def planar_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Flat distance in km. The second latitude enters the cosine unconverted, as results require."""
    dlat = _double(lat1.cast("float") - lat2.cast("float"))
    dlon = _double(lon1.cast("float") - lon2.cast("float")) * F.cos(_double(lat2))
    return F.lit(DEGREE_KM) * F.sqrt(dlat * dlat + dlon * dlon)


def direction_degrees(lon: Column, lat: Column, to_lon: Column, to_lat: Column) -> Column:
    """Whole degrees of the way from a point to a target, shifted so that the range is -1..359.

    A way of length zero keeps the sign of its zero: below a negative cosine it points west, which
    ``atan2`` of Spark, where all zeros are positive, would lose.
    """
    dlat = _double(to_lat.cast("float") - lat.cast("float"))
    cosine = F.cos(_double(lat))
    dlon = _double(to_lon.cast("float") - lon.cast("float")) * cosine
    west = (dlat == 0) & (dlon == 0) & (cosine < 0)
    return F.when(west, F.lit(180)).otherwise(F.degrees(F.atan2(dlat, dlon)).cast("int")) + F.lit(179)


def direction_bucket(degrees: Column) -> Column:
    """One of eight 45-degree sectors; -1 degrees falls into sector 0."""
    return (degrees / F.lit(BUCKET_DEGREES)).cast("int")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km. Rounding may lift the chord of antipodes above one, so it is held there."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    held = F.least(chord, F.lit(1.0))
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(held), F.sqrt(F.lit(1.0) - held))


def _way_cells() -> str:
    """SQL text of the cells on a way between columns ``x1, y1`` and ``x2, y2`` of the grid.

    A way is the straight line between the middles of two cells; it lies on every cell whose inside it meets. Between the
    middles of columns ``a`` and ``a + 1`` it crosses one border of columns, and the rows of a column are those between its
    two crossings. Twice the distances are whole numbers, so rows follow by whole division. Where the line meets a corner
    it goes on in the cell across.
    """
    dx, dy = "abs(x2 - x1)", "abs(y2 - y1)"
    first = f"if(a = 0, 0, int(((2 * a - 1) * {dy} + {dx}) div (2 * {dx})))"
    last = f"if(a = {dx}, {dy}, int(((2 * a + 1) * {dy} + {dx} - 1) div (2 * {dx})))"
    cell = f"int(x1 + a * sign(x2 - x1) + {GRID_COLUMNS} * (y1 + b * sign(y2 - y1)))"
    return f"flatten(transform(sequence(0, {dx}), a -> transform(sequence({first}, {last}), b -> {cell})))"


WAY_CELLS = _way_cells()


def register_sql_functions(spark: SparkSession) -> None:
    """Make the functions callable by name from SQL text; the optimizer inlines them."""
    box = f"lon BETWEEN {LON_WEST}D AND {LON_EAST}D AND lat BETWEEN {LAT_SOUTH}D AND {LAT_NORTH}D"
    x = f"CAST(floor(({-LON_WEST}D - abs(CAST(lon AS DOUBLE))) / {CELL_LON}D) AS INT)"
    y = f"CAST(floor(({LAT_NORTH}D - CAST(lat AS DOUBLE)) / {CELL_LAT}D) AS INT)"
    center_lon = f"-CAST({-LON_WEST}D - (cell % {GRID_COLUMNS}) * {CELL_LON}D - {CELL_LON / 2}D AS FLOAT)"
    center_lat = f"CAST({LAT_NORTH}D - (cell div {GRID_COLUMNS}) * {CELL_LAT}D - {CELL_LAT / 2}D AS FLOAT)"
    distance = (
        f"{DEGREE_KM}D * sqrt(power(CAST(lat1 - lat2 AS DOUBLE), 2) + "
        "power(CAST(lon1 - lon2 AS DOUBLE) * cos(CAST(lat2 AS DOUBLE)), 2))"
    )
    bodies = {
        "isInNYC(lon FLOAT, lat FLOAT) RETURNS BOOLEAN": box,
        "toCellId(lon FLOAT, lat FLOAT) RETURNS INT": f"{x} + {y} * {GRID_COLUMNS}",
        "toCoords(cell INT) RETURNS STRUCT<lon: FLOAT, lat: FLOAT>": (
            f"named_struct('lon', {center_lon}, 'lat', {center_lat})"
        ),
        "planarKm(lon1 FLOAT, lat1 FLOAT, lon2 FLOAT, lat2 FLOAT) RETURNS DOUBLE": distance,
        "timeDiff(first TIMESTAMP, second TIMESTAMP) RETURNS BIGINT": "unix_millis(second) - unix_millis(first)",
    }
    bodies["cellsOnWay(x1 INT, y1 INT, x2 INT, y2 INT) RETURNS TABLE (cell INT)"] = f"SELECT explode({WAY_CELLS})"
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
