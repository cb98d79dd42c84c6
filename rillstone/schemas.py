"""Record types. Event times are ``TIMESTAMP`` (an instant, session zone UTC)."""

RIDE = (
    "ride_id BIGINT, is_start BOOLEAN, start_time TIMESTAMP, end_time TIMESTAMP, "
    "start_lon FLOAT, start_lat FLOAT, end_lon FLOAT, end_lat FLOAT, "
    "passenger_cnt SMALLINT, taxi_id BIGINT, driver_id BIGINT"
)
FARE = (
    "ride_id BIGINT, taxi_id BIGINT, driver_id BIGINT, start_time TIMESTAMP, "
    "payment_type STRING, tip FLOAT, tolls FLOAT, total_fare FLOAT"
)
CAR_EVENT = (
    "car_id STRING, event_id STRING, ts TIMESTAMP, longitude FLOAT, latitude FLOAT, "
    "consumption FLOAT, speed FLOAT, throttle FLOAT, engineload FLOAT"
)
TRIP = "bike_id BIGINT, duration BIGINT, start_station_name STRING, end_station_name STRING, zip_code STRING"
STATION = "id INT, name STRING, lat DOUBLE, long DOUBLE"
POST_ATTRIBUTES = "_Id STRING, _CreationDate STRING, _Tags STRING"
LANGUAGE = "name STRING"
LOCATION_QUERY = "query_id BIGINT, lon FLOAT, lat FLOAT, ts TIMESTAMP"
RULE = "rule STRING, first_shape STRING, second_shape STRING"
ITEM = "item_id BIGINT, shape STRING, color STRING, seq BIGINT"
CUSTOMER = "ts TIMESTAMP, customer_id BIGINT, info STRING"
TRADE = "ts TIMESTAMP, customer_id BIGINT, info STRING"

RIDE_COLUMNS = [part.split()[0] for part in RIDE.split(", ")]
FARE_COLUMNS = [part.split()[0] for part in FARE.split(", ")]

# The allowed item shapes and colours of the rule-matching demo.
SHAPES = ("RECTANGLE", "TRIANGLE", "CIRCLE")
COLORS = ("RED", "GREEN", "BLUE")
