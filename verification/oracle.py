"""The same answers as SQL text over the warehouse tables."""

from __future__ import annotations


def _at(x: str) -> str:
    return f"make_timestamp((1356998400 + {x}) * 1000000)"


TRIP_BASE = """
trip_base AS (
  SELECT o_orderkey AS ride_id, o_custkey AS driver_id, o_custkey % 97 AS taxi_id,
         (o_orderkey * 7919) % 86400 AS s_off, 300 + (o_orderkey * 104729) % 10800 AS dur,
         o_orderkey % 4 AS s_spot, CAST(floor(o_orderkey / 4) AS BIGINT) % 4 AS e_spot,
         o_orderstatus, o_orderpriority
  FROM orders),
trip_place AS (
  SELECT *, CAST(-73.9993e0 + 0.12e0 * s_spot + 0.0001e0 * (driver_id % 7) AS REAL) AS start_lon,
         CAST(40.7506e0 + 0.03e0 * s_spot AS REAL) AS start_lat,
         CAST(-73.9993e0 + 0.12e0 * e_spot + 0.0001e0 * (taxi_id % 7) AS REAL) AS end_lon,
         CAST(40.7506e0 + 0.03e0 * e_spot AS REAL) AS end_lat
  FROM trip_base)"""

RIDES = f"""{TRIP_BASE},
rides AS (
  SELECT ride_id, is_start, {_at('s_off')} AS start_time,
         CASE WHEN NOT is_start THEN {_at('s_off + dur')} END AS end_time,
         start_lon, start_lat, end_lon, end_lat, CAST(1 + ride_id % 5 AS SMALLINT) AS passenger_cnt, taxi_id, driver_id,
         CASE WHEN is_start THEN {_at('s_off')} ELSE {_at('s_off + dur')} END AS event_time
  FROM trip_place, (VALUES (true), (false)) AS kind(is_start)
  WHERE is_start OR o_orderstatus <> 'P'),
nyc AS (
  SELECT *, {{cell_s}} AS start_cell, {{cell_e}} AS end_cell FROM rides
  WHERE start_lon::DOUBLE BETWEEN -74.05e0 AND -73.7e0 AND start_lat::DOUBLE BETWEEN 40.5e0 AND 41e0
    AND end_lon::DOUBLE BETWEEN -74.05e0 AND -73.7e0 AND end_lat::DOUBLE BETWEEN 40.5e0 AND 41e0)"""


def _x(p: str) -> str:
    return f"CAST(floor((74.05e0 - abs({p}_lon::DOUBLE)) / 0.0014e0) AS INTEGER)"


def _y(p: str) -> str:
    return f"CAST(floor((41.0e0 - {p}_lat::DOUBLE) / 0.00125e0) AS INTEGER)"


RIDES = RIDES.format(cell_s=f"{_x('start')} + {_y('start')} * 250", cell_e=f"{_x('end')} + {_y('end')} * 250")

FARES = f"""
fares AS (
  SELECT ride_id, taxi_id, driver_id, {_at('s_off')} AS start_time, o_orderpriority AS payment_type,
         CAST((ride_id * 13 % 2000) / 100e0 AS REAL) AS tip, CAST(0 AS REAL) AS tolls, CAST(dur / 60e0 AS REAL) AS total_fare
  FROM trip_base WHERE o_orderpriority <> '4-NOT SPECIFIED')"""

CARS = """
cars AS (
  SELECT user_id AS car_id, event_id, ts, ts + to_seconds(event_id * 7919 % 3600) AS arrival,
         CASE WHEN event_type = 'view' THEN 0.0e0 ELSE value END AS speed, value % 50 AS throttle
  FROM events),
marked AS (
  SELECT *, coalesce(ts <= max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
         - INTERVAL 30 MINUTE, false) AS is_late
  FROM cars)"""

LABEL = (
    "CASE trunc(round(erraticness / 2.5e0, 9)) WHEN 0 THEN 'calm' WHEN 1 THEN 'busy' ELSE 'crazy' END AS label"
)

TRIPS = """
trips AS (
  SELECT l_suppkey AS bike_id, CAST(l_quantity * 14 AS BIGINT) AS duration, a.s_name AS start_station_name,
         b.s_name AS end_station_name, CAST(l_partkey AS VARCHAR) AS zip_code
  FROM lineitem JOIN supplier a ON l_suppkey = a.s_suppkey
       JOIN supplier b ON l_partkey % (SELECT max(s_suppkey) + 1 FROM supplier) = b.s_suppkey)"""

TAGS = """
mentions AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS "Year", unnest([lower(p_brand), lower(p_type)]) AS "Language"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
counts AS (
  SELECT "Year", "Language", count(*) AS "Count" FROM mentions
  WHERE "Year" BETWEEN 1995 AND 2001 AND "Language" IN (SELECT lower(p_brand) FROM part)
  GROUP BY ALL)"""

TOP_LANGUAGES = f"""WITH {TAGS} SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY "Year" ORDER BY "Count" DESC, "Language") AS INTEGER) AS "Rank" FROM counts)
WHERE "Rank" <= 10"""

LOCATIONS = """
places AS (SELECT id AS query_id, CAST(x AS REAL) AS lon, CAST(y AS REAL) AS lat
  FROM (VALUES (1::BIGINT, -74.0e0, 41.0e0), (2, -73.7781e0, 40.6413e0), (3, -73.977664e0, 40.761484e0)) AS v(id, x, y))"""


def _km(a: str, b: str) -> str:
    """Flat distance of two points given as ``lon,lat`` expressions."""
    (x1, y1), (x2, y2) = a.split(","), b.split(",")
    return f"110.25e0 * sqrt(pow(({y1} - {y2})::DOUBLE, 2) + pow(({x1} - {x2})::DOUBLE * cos({y2}::DOUBLE), 2))"


REPORTS = f"""
reports AS (
  SELECT query_id, ride_id, taxi_id, event_time, CAST({_km('lon,lat', 'end_lon,end_lat')} AS REAL) AS distance
  FROM rides, places WHERE NOT is_start)"""

EPOCH_TEXT = "1970-01-01 00:00:00"
_TIME = "'%Y-%m-%d %H:%M:%S'"


def _ride_text(prefix: str = "") -> str:
    p = prefix
    start = f"strftime({p}start_time, {_TIME})"
    end = f"coalesce(strftime({p}end_time, {_TIME}), '{EPOCH_TEXT}')"
    return (
        f"concat_ws(',', {p}ride_id, CASE WHEN {p}is_start THEN 'START' ELSE 'END' END, "
        f"CASE WHEN {p}is_start THEN {start} ELSE {end} END, CASE WHEN {p}is_start THEN {end} ELSE {start} END, "
        f"{p}start_lon, {p}start_lat, {p}end_lon, {p}end_lat, {p}passenger_cnt, {p}taxi_id, {p}driver_id)"
    )


COORDINATES = ["start_lon", "start_lat", "end_lon", "end_lat"]
RIDE_COLS = (
    "ride_id, is_start, start_time, end_time, start_lon, start_lat, end_lon, end_lat, passenger_cnt, taxi_id, driver_id"
)


def _rounded(sql: str, *columns: str) -> str:
    replaced = ", ".join(f'round(CAST("{c}" AS DOUBLE), 6) AS "{c}"' for c in columns)
    return f"SELECT * REPLACE ({replaced}) FROM ({sql})"


def _rides(body: str, *columns: str) -> str:
    return _rounded(f"WITH {RIDES} {body}", *columns) if columns else f"WITH {RIDES} {body}"


def _segments(strict: bool) -> str:
    return _rounded(f"""WITH {CARS},
stops AS (SELECT DISTINCT car_id, ts FROM cars WHERE speed = 0),
moves AS (
  SELECT c.*, (SELECT max(s.ts) FROM stops s WHERE s.car_id = c.car_id AND s.ts <= c.ts) AS before_ts,
         (SELECT min(s.ts) FROM stops s WHERE s.car_id = c.car_id AND s.ts >= c.ts) AS after_ts
  FROM cars c WHERE speed <> 0),
runs AS (
  SELECT car_id, before_ts, after_ts, min(ts) AS start_time, count(*) AS length, CAST(trunc(max(speed)) AS INTEGER) AS max_speed,
         stddev_pop(throttle) AS erraticness
  FROM moves WHERE after_ts > ts AND (before_ts IS NULL OR before_ts < ts)
  GROUP BY ALL)
SELECT car_id, start_time, length, max_speed, erraticness, {LABEL} FROM runs
{'WHERE before_ts IS NOT NULL' if strict else ''}""", "erraticness")


LONG_RIDES = """SELECT {cols} FROM {src} s WHERE is_start AND NOT EXISTS (
  SELECT 1 FROM {src} e WHERE NOT e.is_start AND e.ride_id = s.ride_id AND e.end_time <= s.start_time + INTERVAL 2 HOUR)"""

HOURLY = """hourly AS (
  SELECT time_bucket(INTERVAL 1 HOUR, start_time) + INTERVAL 1 HOUR AS window_end, driver_id, sum(tip::DOUBLE) AS sum_tips
  FROM fares GROUP BY ALL)"""

PANES = """panes AS (
  SELECT CASE WHEN is_start THEN start_cell ELSE end_cell END AS cell, is_start,
         time_bucket(INTERVAL 5 MINUTE, event_time) + to_minutes(m) AS wend
  FROM nyc, (VALUES (5), (10), (15)) AS v(m)),
popular AS (SELECT cell, is_start, wend, count(*) AS n FROM panes GROUP BY ALL)"""
CENTER_LON = "-CAST(74.05e0 - (cell % 250) * 0.0014e0 - 0.0007e0 AS REAL)"
CENTER_LAT = "CAST(41.0e0 - (cell // 250) * 0.00125e0 - 0.000625e0 AS REAL)"

PREDICTION = f"""WITH {RIDES},
points AS (
  SELECT ride_id, is_start, event_time, end_cell, {_km('start_lon,start_lat', 'end_lon,end_lat')} AS km,
         CAST(trunc((CAST(trunc(degrees(atan2((start_lat - end_lat)::DOUBLE,
              (start_lon - end_lon)::DOUBLE * cos(end_lat::DOUBLE)))) AS INTEGER) + 179) / 45e0) AS INTEGER) AS sector,
         epoch_ms(end_time - start_time) / 60000e0 AS minutes
  FROM nyc),
fitted AS (
  SELECT *, count(*) FILTER (NOT is_start) OVER w AS n, sum(km * minutes) FILTER (NOT is_start) OVER w AS xy,
         sum(km * km) FILTER (NOT is_start) OVER w AS xx
  FROM points
  WINDOW w AS (PARTITION BY end_cell, sector ORDER BY event_time, NOT is_start, ride_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT ride_id, coalesce(CASE WHEN n >= 2 AND xx > 0 THEN CAST(trunc(round(xy / xx * km, 9)) AS INTEGER) END, -1) AS predicted_minutes
FROM fitted WHERE is_start"""

# A line between the middles of two cells meets the inside of a cell if two of its corners lie on different sides.
ROUTES = f"""WITH {RIDES},
ways AS (
  SELECT {_x('start')} AS ax, {_y('start')} AS ay, {_x('end')} AS bx, {_y('end')} AS by_, count(*) AS n
  FROM nyc WHERE is_start GROUP BY ALL),
boxes AS (
  SELECT *, unnest(range(least(ax, bx), greatest(ax, bx) + 1)) AS x FROM ways),
cells AS (
  SELECT *, unnest(range(least(ay, by_), greatest(ay, by_) + 1)) AS y FROM boxes),
sides AS (
  SELECT n, x, y, 2 * ((by_ - ay) * (x - ax) - (bx - ax) * (y - ay)) AS middle, abs(by_ - ay) + abs(bx - ax) AS reach FROM cells)
SELECT CAST(x + y * 250 AS INTEGER) AS cell, CAST(sum(n) AS BIGINT) AS rides
FROM sides WHERE abs(middle) < reach OR reach = 0 GROUP BY cell"""

TAXI_QUERY_TEXTS = (
    "ride.is_start AND watermark - ride.event_millis > 100 * 60000",
    "NOT ride.is_start AND planarKm(-74.0, 41.0, ride.end_lon, ride.end_lat) < 40.0",
)
_DIST_40 = _km("-74.0::REAL,41.0::REAL", "end_lon,end_lat") + " < 40.0"
TAXI_QUERY = f"""WITH {RIDES},
asked AS (SELECT * FROM (VALUES (0, TIMESTAMP '2013-01-01 08:00:00'), (1, TIMESTAMP '2013-01-01 20:00:00')) AS v(number, at_time)),
stored AS (
  SELECT * FROM (
    SELECT a.number, a.at_time, r.*, row_number() OVER (PARTITION BY a.number, r.taxi_id
           ORDER BY r.event_time DESC, r.is_start, r.ride_id DESC) AS rn
    FROM asked a JOIN rides r ON r.event_time <= a.at_time) WHERE rn = 1),
later AS (
  SELECT CASE WHEN event_time > TIMESTAMP '2013-01-01 20:00:00' THEN 1 ELSE 0 END AS number,
         event_time - INTERVAL 60 SECOND AS at_time, * FROM rides WHERE event_time > TIMESTAMP '2013-01-01 08:00:00'),
answers AS (
  SELECT 'PBE' AS kind, number, at_time, {RIDE_COLS}, event_time FROM stored
  UNION ALL SELECT 'PE', number, at_time, {RIDE_COLS}, event_time FROM later)
SELECT 'QUERY' AS tag, text FROM (VALUES ('{TAXI_QUERY_TEXTS[0]}'), ('{TAXI_QUERY_TEXTS[1]}')) AS v(text)
UNION ALL
SELECT kind || '@' || strftime(at_time, {_TIME}) AS tag, {_ride_text()} AS text FROM answers
WHERE CASE number WHEN 0 THEN is_start AND epoch_ms(at_time) - epoch_ms(event_time) > 6000000
      ELSE NOT is_start AND {_DIST_40} END"""

EXPIRING = f"""WITH RECURSIVE {RIDES},
control AS (
  SELECT id AS query_id, CAST(x AS REAL) AS lon, CAST(y AS REAL) AS lat, at_time AS ts FROM (VALUES
    (1::BIGINT, -74.0e0, 41.0e0, TIMESTAMP '2013-01-01 00:30:00'), (2, -73.7781e0, 40.6413e0, TIMESTAMP '2013-01-01 12:00:00'),
    (3, -73.977664e0, 40.761484e0, TIMESTAMP '2013-01-01 12:05:00'), (4, 0.0e0, 0.0e0, TIMESTAMP '2013-01-01 23:00:00'))
    AS v(id, x, y, at_time)),
places AS (
  SELECT *, (SELECT min(c.ts) FROM control c WHERE c.ts > q.ts + INTERVAL 15 MINUTE) AS until FROM control q WHERE lon <> 0),
reports AS (
  SELECT query_id, ride_id, taxi_id, event_time, CAST({_km('lon,lat', 'end_lon,end_lat')} AS REAL) AS distance,
         row_number() OVER (PARTITION BY query_id ORDER BY event_time, ride_id) AS n
  FROM rides, places WHERE NOT is_start AND event_time >= ts AND (until IS NULL OR event_time < until)),
chain AS (
  SELECT query_id, n, taxi_id, event_time, distance FROM reports WHERE n = 1
  UNION ALL
  SELECT b.query_id, b.n, b.taxi_id, b.event_time, b.distance FROM (
    SELECT c.query_id, min(r.n) AS n FROM chain c JOIN reports r ON r.query_id = c.query_id AND r.n > c.n
      AND (r.distance < c.distance OR r.event_time > c.event_time + INTERVAL 8 HOUR)
    GROUP BY c.query_id) x JOIN reports b ON b.query_id = x.query_id AND b.n = x.n)
SELECT query_id, taxi_id, event_time, distance FROM chain"""

FARE_FLOATS = ["tip", "tolls", "total_fare"]
RIDE_LINES = f"""SELECT ride_id, is_start, start_time, coalesce(end_time, TIMESTAMP '{EPOCH_TEXT}') AS end_time,
  start_lon, start_lat, end_lon, end_lat, passenger_cnt, taxi_id, driver_id FROM rides"""

ORACLE: dict[str, str] = {
    "selection": "SELECT c_custkey, round(c_acctbal, 6) AS c_acctbal FROM customer WHERE c_acctbal > 10",
    "projection_distinct": "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer",
    "set_union": "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000",
    "set_union_all": "SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000",
    "set_intersect": "SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000",
    "set_difference": """SELECT c_nationkey AS nation, c_mktsegment AS segment FROM customer
        EXCEPT SELECT s_nationkey, 'MACHINERY' FROM supplier WHERE s_acctbal > 5000""",
    "repeated_values": """SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders
        WHERE o_totalprice IN (SELECT o_totalprice FROM orders GROUP BY o_totalprice HAVING count(*) > 1)""",
    "dedup_first": """SELECT o_custkey, o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""",
    "natural_join": "SELECT o_orderkey AS a, o_custkey AS b, c_nationkey AS c FROM orders JOIN customer ON o_custkey = c_custkey",
    "mean_by_group": """SELECT c_nationkey, round(avg(c_acctbal), 6) AS mean_balance FROM customer
        WHERE c_mktsegment = 'MACHINERY' GROUP BY c_nationkey""",
    "global_max": "SELECT round(max(o_totalprice), 6) AS max_price FROM orders",
    "global_mean": "SELECT round(avg(o_totalprice), 6) AS mean_price FROM orders",
    "group_sum": "SELECT o_custkey, round(sum(o_totalprice), 6) AS sum_price FROM orders GROUP BY o_custkey",
    "group_max": "SELECT o_custkey, round(max(o_totalprice), 6) AS max_price FROM orders GROUP BY o_custkey",
    "group_collect": """SELECT o_orderpriority, block, string_agg(CAST(o_custkey AS VARCHAR), ' ' ORDER BY o_custkey) AS "values" FROM (
        SELECT o_orderpriority, o_custkey, (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_custkey, o_orderkey) - 1) // 1000 AS block
        FROM orders) GROUP BY ALL""",
    "partition_sorted": """SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS offset_in_key
        FROM orders""",
    "range_sort": """SELECT round(o_totalprice, 6) AS o_totalprice, o_orderkey,
        row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS pos FROM orders""",
    "increment_map": "SELECT o_orderkey + 1 AS o_orderkey FROM orders",
    "map_reduce_udf": """SELECT o_orderpriority AS priority, round(avg(o_totalprice), 6) AS mean_price, count(*) AS n
        FROM orders GROUP BY o_orderpriority""",
    "word_count": """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""",
    "inverted_index": """SELECT word, block, string_agg(id, ' ' ORDER BY id) AS doc_ids FROM (
        SELECT word, id, (row_number() OVER (PARTITION BY word ORDER BY id) - 1) // 1000 AS block FROM (
          SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id, unnest(string_split(text, ' ')) AS word FROM documents)) GROUP BY ALL""",
    "matvec_broadcast": """WITH cells AS (
          SELECT vec_id AS i, generate_subscripts(embedding, 1) AS j, unnest(embedding)::DOUBLE AS v FROM embeddings),
        means AS (SELECT j, avg(v) AS x FROM cells GROUP BY j)
        SELECT i, round(sum(v * x), 6) AS value FROM cells JOIN means USING (j) GROUP BY i""",
    "matvec_join": """SELECT l_suppkey AS i, round(sum(l_quantity * coalesce(p_retailprice, 0)), 6) AS value
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey""",
    "matmul_broadcast": """WITH cells AS (
          SELECT vec_id, label, generate_subscripts(embedding, 1) AS j, unnest(embedding)::DOUBLE AS v FROM embeddings),
        means AS (SELECT j, label AS k, avg(v) AS w FROM cells GROUP BY ALL)
        SELECT vec_id AS i, k, round(sum(v * w), 6) AS value FROM cells JOIN means USING (j) GROUP BY ALL""",
    "matmul_join": """SELECT l_suppkey AS i, p_size AS k, round(sum(l_quantity * p_retailprice), 6) AS value
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    "csv_scan": f"WITH {TRIPS} SELECT * FROM trips",
    "bike_max_duration": f"""WITH {TRIPS} SELECT bike_id, CAST(sum(duration) AS BIGINT) AS total_duration FROM trips
        GROUP BY bike_id ORDER BY 2 DESC, 1 LIMIT 1""",
    "farthest_stations": """WITH st AS (
          SELECT s_suppkey AS id, s_name AS name, 37.3e0 + (s_suppkey * 37 % 500) / 1000e0 AS lat,
                 -122.5e0 + (s_suppkey * 91 % 700) / 1000e0 AS long FROM supplier),
        pairs AS (
          SELECT a.id AS ia, b.id AS ib, a.name AS station_a, b.name AS station_b,
                 pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2)
                 + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.long) - radians(a.long)) / 2), 2) AS h
          FROM st a JOIN st b ON a.id < b.id)
        SELECT station_a, station_b, round(12742e0 * atan2(sqrt(h), sqrt(1 - h)), 6) AS km
        FROM pairs ORDER BY round(h, 15) DESC, ia, ib LIMIT 1""",
    "bike_path": f"""WITH {TRIPS}, best AS (
          SELECT bike_id FROM trips GROUP BY bike_id ORDER BY sum(duration) DESC, bike_id LIMIT 1)
        SELECT DISTINCT start_station_name, end_station_name FROM trips JOIN best USING (bike_id)""",
    "count_bikes": f"WITH {TRIPS} SELECT count(DISTINCT bike_id) AS n FROM trips",
    "users_over_3h": f"WITH {TRIPS} SELECT zip_code FROM trips GROUP BY zip_code HAVING sum(duration) > 10800",
    "posts_xml_parse": """SELECT l_orderkey || '-' || l_linenumber AS "Id",
          strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS "CreationDate",
          '<' || lower(p_brand) || '><' || lower(p_type) || '>' AS "Tags"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "language_counts": f"WITH {TAGS} SELECT * FROM counts",
    "language_top10": TOP_LANGUAGES,
    "parquet_sink_roundtrip": TOP_LANGUAGES,
    "ride_lines_parse": _rides(RIDE_LINES, *COORDINATES),
    "ride_value_roundtrip": _rides(RIDE_LINES, *COORDINATES),
    "fare_lines_parse": _rounded(f"WITH {TRIP_BASE}, {FARES} SELECT * FROM fares", *FARE_FLOATS),
    "car_lines_parse": """SELECT CAST(user_id AS VARCHAR) AS car_id, CAST(event_id AS VARCHAR) AS event_id, ts,
          round(8.67::REAL::DOUBLE, 6) AS longitude, round(49.87::REAL::DOUBLE, 6) AS latitude, 0.0e0 AS consumption,
          round(CASE WHEN event_type = 'view' THEN 0 ELSE value END::REAL::DOUBLE, 6) AS speed,
          round((value % 50)::REAL::DOUBLE, 6) AS throttle, 0.0e0 AS engineload FROM events""",
    "rides_table_view": _rides("""SELECT ride_id, is_start, start_lon, start_lat, end_lon, end_lat, passenger_cnt, taxi_id,
          driver_id, event_time FROM rides""", *COORDINATES),
    "trips_to_ride_events": f"""WITH {TRIP_BASE}, timed AS (
          SELECT *, strftime({_at('s_off')}, {_TIME}) AS s, strftime({_at('s_off + dur')}, {_TIME}) AS e,
                 concat_ws(',', start_lon, start_lat, end_lon, end_lat, 1 + ride_id % 5, taxi_id, driver_id) AS tail FROM trip_place)
        SELECT *, row_number() OVER (ORDER BY event_time, value) AS pos FROM (
          SELECT s AS event_time, concat_ws(',', ride_id, 'START', s, '{EPOCH_TEXT}', tail) AS value FROM timed
          UNION ALL SELECT e, concat_ws(',', ride_id, 'END', e, s, tail) FROM timed)""",
    "raw_fares_normalize": f"""WITH {TRIP_BASE}, {FARES}
        SELECT concat_ws(',', ride_id, taxi_id, driver_id, strftime(start_time, {_TIME}), payment_type, tip, '0.0', total_fare) AS value
        FROM fares""",
    "ride_cleansing": _rides(f"SELECT {RIDE_COLS} FROM nyc", *COORDINATES),
    "rides_and_fares": _rides(
        f""", {FARES} SELECT {', '.join('r.' + c.strip() for c in RIDE_COLS.split(','))},
        f.ride_id AS fare_ride_id, f.taxi_id AS fare_taxi_id, f.driver_id AS fare_driver_id, f.start_time AS fare_start_time,
        f.payment_type AS fare_payment_type, f.tip AS fare_tip, f.tolls AS fare_tolls, f.total_fare AS fare_total_fare
        FROM rides r JOIN fares f ON r.ride_id = f.ride_id WHERE r.is_start""",
        *COORDINATES, "fare_tip", "fare_tolls", "fare_total_fare",
    ),
    "unmatched_fares": _rides(
        f""", {FARES} SELECT * FROM fares f WHERE NOT EXISTS (
        SELECT 1 FROM rides r WHERE r.is_start AND r.ride_id % 1000 <> 0 AND r.ride_id = f.ride_id)""", *FARE_FLOATS),
    "unmatched_rides": _rides(
        f""", {FARES} SELECT {RIDE_COLS} FROM rides r WHERE is_start AND ride_id % 1000 <> 0
        AND NOT EXISTS (SELECT 1 FROM fares f WHERE r.ride_id = f.ride_id)""", *COORDINATES),
    "unmatched_sides": _rides(
        f""", {FARES} SELECT CASE WHEN r.ride_id IS NULL THEN 'unmatched_fare' ELSE 'unmatched_ride' END AS output_tag,
        coalesce(r.ride_id, f.ride_id) AS ride_id, coalesce(r.taxi_id, f.taxi_id) AS taxi_id
        FROM (SELECT * FROM rides WHERE is_start AND ride_id % 1000 <> 0) r FULL JOIN fares f ON r.ride_id = f.ride_id
        WHERE r.ride_id IS NULL OR f.ride_id IS NULL"""),
    "hourly_tips": _rounded(f"WITH {TRIP_BASE}, {FARES}, {HOURLY} SELECT * FROM hourly", "sum_tips"),
    "hourly_top_tips": _rounded(
        f"""WITH {TRIP_BASE}, {FARES}, {HOURLY} SELECT window_end, driver_id, sum_tips FROM (
        SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY sum_tips DESC, driver_id) AS rn FROM hourly) WHERE rn = 1""",
        "sum_tips"),
    "popular_places": _rides(
        f", {PANES} SELECT {CENTER_LON} AS lon, {CENTER_LAT} AS lat, wend AS window_end, is_start, n AS cnt FROM popular WHERE n >= 20",
        "lon", "lat"),
    "popular_places_sql": _rides(
        f""", {PANES} SELECT {CENTER_LON} AS lon, {CENTER_LAT} AS lat, wend - INTERVAL 15 MINUTE AS wstart, wend, is_start,
        n AS pop_cnt FROM popular WHERE n > 20""", "lon", "lat"),
    "rides_per_hour": _rides(
        "SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS window_start, is_start, count(*) AS cnt FROM rides GROUP BY ALL"),
    "ride_count": _rides("SELECT driver_id, count(*) AS cnt FROM rides GROUP BY driver_id"),
    "ride_count_running": _rides("""SELECT driver_id, ride_id, is_start, event_time,
        row_number() OVER (PARTITION BY driver_id ORDER BY event_time, NOT is_start, ride_id) AS cnt FROM rides"""),
    "long_rides": _rides(LONG_RIDES.format(cols=RIDE_COLS, src="rides"), *COORDINATES),
    "long_rides_nyc": _rides(LONG_RIDES.format(cols=RIDE_COLS, src="nyc"), *COORDINATES),
    "nearest_taxi": _rides(
        f""", {LOCATIONS}, {REPORTS} SELECT query_id, taxi_id, distance FROM (SELECT *, row_number() OVER (
        PARTITION BY query_id ORDER BY distance, event_time, ride_id) AS rn FROM reports) WHERE rn = 1""", "distance"),
    "nearest_taxi_improvements": _rides(
        f""", {LOCATIONS}, {REPORTS} SELECT query_id, taxi_id, event_time, distance FROM (SELECT *, min(distance) OVER (
        PARTITION BY query_id ORDER BY event_time, ride_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM reports)
        WHERE best IS NULL OR distance < best""", "distance"),
    "nearest_taxi_expiring": _rounded(EXPIRING, "distance"),
    "ongoing_rides": _rides(
        f""", latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY taxi_id
          ORDER BY event_time DESC, is_start, ride_id DESC) AS rn FROM rides
          WHERE event_time <= TIMESTAMP '2013-01-01 12:00:00') WHERE rn = 1)
        SELECT {RIDE_COLS}, n FROM latest, (VALUES (0::BIGINT), (5), (30)) AS v(n)
        WHERE is_start AND trunc((epoch_ms(TIMESTAMP '2013-01-01 12:00:00') - epoch_ms(start_time)) / 60000e0) >= n""", *COORDINATES),
    "taxi_query": TAXI_QUERY,
    "latest_ride_per_taxi": _rides(
        f"""SELECT {RIDE_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY taxi_id
        ORDER BY event_time DESC, is_start, ride_id DESC) AS rn FROM rides) WHERE rn = 1""", *COORDINATES),
    "travel_time_prediction": PREDICTION,
    "route_cell_traffic": ROUTES,
    "driving_sessions": _rounded(f"""WITH {CARS}, flagged AS (
          SELECT *, ts > max(ts) OVER w + INTERVAL 6 HOUR OR max(ts) OVER w IS NULL AS opens FROM cars
          WINDOW w AS (PARTITION BY car_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        numbered AS (SELECT *, sum(opens::INTEGER) OVER (PARTITION BY car_id ORDER BY ts, event_id) AS s FROM flagged)
        SELECT * EXCLUDE (s), {LABEL} FROM (
          SELECT car_id, s, min(ts) AS start_time, count(*) AS length, CAST(trunc(max(speed)) AS INTEGER) AS max_speed,
                 stddev_pop(throttle) AS erraticness FROM numbered GROUP BY car_id, s)""", "erraticness"),
    "driving_segments": _segments(False),
    "driving_segments_strict": _segments(True),
    "car_event_sort": _rounded(f"""WITH {CARS} SELECT car_id, event_id, ts, arrival, speed, throttle,
        row_number() OVER (PARTITION BY car_id ORDER BY ts, event_id) AS pos FROM marked WHERE NOT is_late""", "speed", "throttle"),
    "stream_sort": _rounded(f"""WITH {CARS} SELECT car_id, event_id, ts, arrival, speed, throttle,
        CASE WHEN is_late THEN 'late' ELSE 'sorted' END AS output_tag, row_number() OVER (ORDER BY ts, event_id) AS pos FROM marked""", "speed", "throttle"),
    "late_events": f"WITH {CARS} SELECT 'LATE' AS tag, count(*) AS cnt FROM marked WHERE is_late",
    "events_per_user_second": f"""WITH {CARS} SELECT car_id AS user_id, date_trunc('second', ts) AS window_start, count(*) AS cnt
        FROM marked WHERE NOT is_late GROUP BY ALL""",
    "rule_pair_match": """SELECT 'view_purchase' AS rule, a.user_id AS color, a.event_id AS first_seq, min(b.event_id) AS second_seq
        FROM events a JOIN events b ON a.user_id = b.user_id AND b.event_id > a.event_id
        WHERE a.event_type = 'view' AND b.event_type = 'purchase' GROUP BY ALL""",
    "asof_enrich": """WITH t AS (
          SELECT o_orderkey AS trade_id, o_custkey AS customer_id, o_orderpriority AS trade_info,
                 make_timestamp((1704067200 + (o_orderkey * 7919) % 2592000) * 1000000) AS ts FROM orders)
        SELECT trade_id, customer_id, t.ts AS ts, trade_info, e.ts AS customer_ts, e.event_type AS customer_info
        FROM t ASOF LEFT JOIN events e ON t.customer_id = e.user_id AND t.ts >= e.ts""",
}

STREAM_TWINS = (
    "ride_cleansing hourly_tips hourly_top_tips popular_places rides_per_hour ride_count rides_and_fares unmatched_fares "
    "unmatched_rides long_rides nearest_taxi nearest_taxi_expiring ongoing_rides taxi_query travel_time_prediction "
    "driving_sessions driving_segments driving_segments_strict rule_pair_match car_event_sort late_events "
    "events_per_user_second"
).split()
ORACLE.update({f"stream_{name}": ORACLE[name] for name in STREAM_TWINS})
# The steered streams are told when messages arrive: thresholds at two times, locations one after the other.
ORACLE["stream_ongoing_rides"] = _rides(
    f""", asked AS (SELECT * FROM (VALUES (TIMESTAMP '2013-01-01 12:00:00', 0::BIGINT), (TIMESTAMP '2013-01-01 12:00:00', 30),
          (TIMESTAMP '2013-01-01 20:00:00', 0), (TIMESTAMP '2013-01-01 20:00:00', 2)) AS v(asked_at, n)),
        latest AS (SELECT * FROM (SELECT a.asked_at, a.n, r.*, row_number() OVER (PARTITION BY a.asked_at, a.n, r.taxi_id
          ORDER BY r.event_time DESC, r.is_start, r.ride_id DESC) AS rn FROM rides r JOIN asked a ON r.event_time <= a.asked_at) WHERE rn = 1)
        SELECT {RIDE_COLS}, n, asked_at FROM latest
        WHERE is_start AND trunc((epoch_ms(asked_at) - epoch_ms(start_time)) / 60000e0) >= n""", *COORDINATES)
ORACLE["stream_nearest_taxi"] = _rides(
    f""", {LOCATIONS}, {REPORTS}, since AS (SELECT * FROM (VALUES (1::BIGINT, TIMESTAMP '2013-01-01 00:30:00'),
          (2, TIMESTAMP '2013-01-01 12:00:00'), (3, TIMESTAMP '2013-01-01 12:05:00')) AS v(query_id, at_time))
        SELECT query_id, taxi_id, distance FROM (SELECT reports.*, row_number() OVER (
        PARTITION BY query_id ORDER BY distance, event_time, ride_id) AS rn FROM reports JOIN since USING (query_id)
        WHERE event_time > at_time) WHERE rn = 1""", "distance")
ORACLE["stream_popular_places_sql"] = ORACLE["popular_places_sql"]
ORACLE["stream_popular_places_changes"] = ORACLE["popular_places"]
ORACLE["route_cell_traffic_sql"] = ORACLE["route_cell_traffic"]
ORACLE["stream_tagged_sinks"] = _rides(
    f"""SELECT {RIDE_COLS}, CASE WHEN ride_id IN (SELECT ride_id FROM nyc) THEN 'inside' ELSE 'outside' END AS output_tag FROM rides""", *COORDINATES)
# An hour is open while the watermark, the newest time less a minute, has not passed its end.
ORACLE["stream_open_hours"] = _rounded(f"""WITH {TRIP_BASE}, {FARES}, {HOURLY} SELECT window_end, driver_id, sum_tips FROM hourly
    WHERE window_end > (SELECT max(start_time) - INTERVAL 60 SECOND FROM fares)""", "sum_tips")
ORACLE["count_bikes_sketch"] = f"WITH {TRIPS} SELECT count(DISTINCT bike_id) AS n, true AS near FROM trips"
ORACLE["taxi_rides_source"] = ORACLE["ride_lines_parse"]
ORACLE["stream_sort_tagged"] = ORACLE["stream_sort"]
