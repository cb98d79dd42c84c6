"""Ride, fare and car queries on small inputs."""

import gzip
import math
import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rillstone import schemas, views
from rillstone.operators import events
from rillstone.plans import cars, control, rides
from rillstone.sources import connectors, lines, raw

T0 = datetime(2000, 1, 1)
PENN = (-73.9947, 40.750626)
ELSEWHERE = (0.0, 90.0)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def ride(number, start=True, begin=T0, end=None, a=PENN, b=PENN, taxi=1, driver=1):
    return (number, start, begin, end, *a, *b, 1, taxi, driver)


def fare(number, driver=1, begin=T0, tip=0.0):
    return (number, 1, driver, begin, "CASH", tip, 0.0, 0.0)


def ride_table(spark, data):
    return spark.createDataFrame(data, schemas.RIDE)


def fare_table(spark, data):
    return spark.createDataFrame(data, schemas.FARE)


def test_cleansing_keeps_rides_inside(spark):
    data = [ride(1), ride(2, b=ELSEWHERE), ride(3, a=ELSEWHERE), ride(4, a=ELSEWHERE, b=ELSEWHERE)]
    assert rows(rides.ride_cleansing(ride_table(spark, data)), "ride_id") == [(1,)]


@pytest.mark.parametrize("order", [(1, 2), (2, 1)])
def test_fares_with_and_without_rides(spark, order):
    fares = fare_table(spark, [fare(i) for i in order])
    one, both = ride_table(spark, [ride(1)]), ride_table(spark, [ride(1), ride(2)])
    assert rows(rides.unmatched_fares(one, fares), "ride_id") == [(2,)]
    assert rows(rides.rides_and_fares(both, fares), "ride_id", "fare_ride_id") == [(1, 1), (2, 2)]
    assert rows(rides.unmatched_sides(ride_table(spark, [ride(1), ride(7), ride(1000)]), fares), "output_tag", "ride_id") == [
        ("unmatched_fare", 2), ("unmatched_ride", 7)
    ]


def test_hourly_tips(spark):
    data = [fare(1, 1, at(0), 1.0), fare(2, 1, at(15), 5.0), fare(3, 1, at(90), 10.0)]
    assert rows(rides.hourly_top_tips(fare_table(spark, data[:1]))) == [(at(60), 1, 1.0)]
    assert rows(rides.hourly_top_tips(fare_table(spark, data))) == [(at(60), 1, 6.0), (at(120), 1, 10.0)]
    data.append(fare(4, 2, at(90), 20.0))
    assert rows(rides.hourly_top_tips(fare_table(spark, data))) == [(at(60), 1, 6.0), (at(120), 2, 20.0)]


def test_long_rides_border(spark):
    data = []
    for number, minutes in [(1, 120), (2, 120.02), (3, 5), (4, None)]:
        data.append(ride(number))
        if minutes is not None:
            data.append(ride(number, False, T0, at(minutes)))
    assert rows(rides.long_rides(ride_table(spark, data)), "ride_id") == [(2,), (4,)]


def test_popular_places_border(spark):
    data = ride_table(spark, [ride(i) for i in range(20)])
    found = sorted(tuple(r) for r in rides.popular_places(data).select("window_end", "cnt").collect())
    assert found == [(at(5), 20), (at(10), 20), (at(15), 20)]
    assert rides.popular_places(data, inclusive=False).count() == 0
    assert rides.popular_places_sql(spark, data, 19).count() == 3


def test_ongoing_rides_do_not_look_ahead(spark):
    data = [ride(1, begin=at(0), taxi=1), ride(1, False, at(0), at(500), taxi=1), ride(2, begin=at(600), taxi=1)]
    limits = spark.createDataFrame([(30,)], "n BIGINT")
    assert rows(rides.ongoing_rides(ride_table(spark, data), limits, F.lit(at(400))), "n", "ride_id") == [(30, 1)]


def test_latest_and_ongoing(spark):
    data = [ride(1, begin=at(0)), ride(1, False, at(0), at(10)), ride(2, begin=at(10)), ride(3, begin=at(30), taxi=2)]
    latest = events.latest_per_key(ride_table(spark, data))
    assert rows(latest, "taxi_id", "ride_id", "is_start") == [(1, 1, False), (2, 3, True)]
    ongoing = rides.ongoing_rides(
        ride_table(spark, data), spark.createDataFrame([(30,), (60,)], "n BIGINT"), F.lit(at(60))
    )
    assert rows(ongoing, "n", "ride_id") == [(30, 3)]


def test_prediction_needs_two_finished_rides(spark):
    b = (-73.9, 40.8)
    data = []
    for number, begin in [(1, 0), (2, 60), (3, 120)]:
        data += [ride(number, begin=at(begin), b=b), ride(number, False, at(begin), at(begin + 10), b=b)]
    got = rows(rides.travel_time_prediction(ride_table(spark, data)))
    assert got == [(1, -1), (2, -1), (3, 10)]


def rule_loop(items, rule):
    waiting, out = {}, []
    for seq, shape, color in items:
        if shape == rule[1] and waiting.get(color):
            out += [(color, w, seq) for w in waiting.pop(color)]
        if shape == rule[0]:
            waiting.setdefault(color, []).append(seq)
    return sorted(out)


@pytest.mark.parametrize("rule", [("RECTANGLE", "TRIANGLE"), ("CIRCLE", "CIRCLE")])
def test_rule_pairs(spark, rule):
    shown = [
        ("RECTANGLE", "GREEN"), ("TRIANGLE", "BLUE"), ("TRIANGLE", "RED"), ("CIRCLE", "BLUE"), ("CIRCLE", "GREEN"),
        ("TRIANGLE", "BLUE"), ("RECTANGLE", "GREEN"), ("CIRCLE", "GREEN"), ("TRIANGLE", "GREEN"),
    ]
    rng = random.Random(1)
    data = [(i, s, c) for i, (s, c) in enumerate(shown)]
    data += [(i, rng.choice(schemas.SHAPES), rng.choice(schemas.COLORS)) for i in range(9, 200)]
    items = spark.createDataFrame(data, "seq BIGINT, shape STRING, color STRING")
    rules = spark.createDataFrame([("r", *rule)], schemas.RULE)
    assert rows(events.rule_pairs(items, rules), "color", "first_seq", "second_seq") == sorted(rule_loop(data, rule), key=repr)
    if rule[0] == "RECTANGLE":
        first = events.rule_pairs(items.filter("seq < 9"), rules)
        assert rows(first, "first_seq", "second_seq") == [(0, 8), (6, 8)]


def test_asof_customers(spark):
    ms = lambda n: datetime(1970, 1, 1) + timedelta(milliseconds=n)
    customers = spark.createDataFrame(
        [(i, ms(t), 0, f"c{t}") for i, t in enumerate([0, 500, 1500, 1600, 2100])],
        "change_id BIGINT, ts TIMESTAMP, customer_id BIGINT, info STRING",
    )
    trades = spark.createDataFrame(
        [(i, ms(t), 0, "t") for i, t in enumerate([1000, 1200, 1500, 1700, 1800, 2000])] + [(9, ms(5), 1, "t")],
        "trade_id BIGINT, ts TIMESTAMP, customer_id BIGINT, info STRING",
    )
    got = rows(events.asof_customers(trades, customers), "trade_id", "customer_info")
    assert got == [(0, "c500"), (1, "c500"), (2, "c1500"), (3, "c1600"), (4, "c1600"), (5, "c1600"), (9, None)]


def car_table(spark, data):
    return spark.createDataFrame(
        data, "car_id BIGINT, event_id BIGINT, ts TIMESTAMP, arrival TIMESTAMP, speed DOUBLE, throttle DOUBLE"
    )


def car(number, seconds, speed=10.0, throttle=0.0, arrival=None, car_id=1):
    t = T0 + timedelta(seconds=seconds)
    return (car_id, number, t, t if arrival is None else T0 + timedelta(seconds=arrival), speed, throttle)


def test_sessions_merge_at_the_exact_gap(spark):
    df = car_table(spark, [car(1, 0, throttle=1.0), car(2, 15, throttle=3.0), car(3, 31, 20.7), car(4, 60)])
    got = rows(events.sessions(df, "15 SECONDS"), "length", "max_speed", "erraticness", "label")
    assert got == [(1, 10, 0.0, "calm"), (1, 20, 0.0, "calm"), (2, 10, 1.0, "calm")]


def segments_loop(data, strict):
    """Moving events after the last stop and before the next one, per car."""
    out = []
    for car_id in {d[0] for d in data}:
        mine = [d for d in data if d[0] == car_id]
        stops = sorted({d[2] for d in mine if d[4] == 0})
        for before, after in zip([None, *stops], stops):
            inside = [d for d in mine if d[4] != 0 and d[2] < after and (before is None or d[2] > before)]
            if inside and (before is not None or not strict):
                out.append((car_id, min(d[2] for d in inside), len(inside), int(max(d[4] for d in inside))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("strict", [True, False])
def test_segments(spark, strict):
    rng = random.Random(2)
    data = [
        car(i, rng.randrange(120), rng.choice([0.0, 0.0, 12.5, 33.3, 7.0]), rng.random() * 9, car_id=rng.randrange(3))
        for i in range(250)
    ]
    got = events.driving_segments(car_table(spark, data), strict)
    assert rows(got, "car_id", "start_time", "length", "max_speed") == segments_loop(data, strict)


def test_late_and_sorted(spark):
    df = car_table(spark, [car(1, 0, arrival=0), car(2, 100, arrival=1), car(3, 70, arrival=2), car(4, 71, arrival=3)])
    assert rows(cars.on_time_sorted(df, "30 SECONDS"), "event_id", "pos") == [(1, 1), (2, 3), (4, 2)]
    assert rows(cars.late_count(df, "30 SECONDS")) == [("LATE", 1)]
    tags = rows(cars.sorted_stream(df, "30 SECONDS"), "event_id", "output_tag")
    assert tags == [(1, "sorted"), (2, "sorted"), (3, "late"), (4, "sorted")]
    assert rows(cars.events_per_second(df, "0 SECONDS"), "cnt") == [(1,), (1,)]


def expiring_loop(reports):
    out = {}
    best = {}
    for q, t, number, taxi, km in sorted(reports, key=lambda r: (r[0], r[1], r[2])):
        known = best.get(q)
        if known is None or t > known[1] + timedelta(hours=8) or km < known[0]:
            best[q] = (km, t)
            out.setdefault(q, []).append((q, taxi, t))
    return sorted(sum(out.values(), []), key=repr)


def test_expiring_queries(spark):
    rng = random.Random(4)
    data = []
    for i in range(1, 300):
        end = at(rng.randrange(3 * 1440))
        data.append(ride(i, False, end, end, b=(-74 + rng.random() * 0.3, 40.5 + rng.random() * 0.5), taxi=i))
    queries = [(1, -74.0, 41.0, at(1)), (2, -73.8, 40.6, at(2000)), (3, 0.0, 0.0, at(2010)), (4, 0.0, 0.0, at(3900))]
    table, asked = ride_table(spark, data), spark.createDataFrame(queries, schemas.LOCATION_QUERY)
    active = control.active_queries(asked)
    assert rows(active, "query_id", "until") == [(1, at(2000)), (2, at(3900))]
    reports = [tuple(r) for r in control.active_reports(table, active).select(
        "query_id", "event_time", "ride_id", "taxi_id", "distance").collect()]
    assert rows(control.nearest_taxi_expiring(table, asked), "query_id", "taxi_id", "event_time") == expiring_loop(reports)
    nobody = control.nearest_taxi_expiring(table, asked.filter("query_id > 2"))
    assert nobody.count() == 0


def test_many_forgotten_reports(spark):
    """Two hundred times nothing nearer comes for eight hours; ranges of any size give the same."""
    rng = random.Random(8)
    data = []
    for i in range(900):
        t = at((i // 3) * 490 + rng.randrange(60))
        data.append((i % 2, i, i, t, float(rng.randrange(50))))
    schema = "query_id BIGINT, ride_id BIGINT, taxi_id BIGINT, event_time TIMESTAMP, distance FLOAT"
    reports = spark.createDataFrame(data, schema)
    want = expiring_loop([(q, t, r, x, d) for q, r, x, t, d in data])
    for max_rows in (None, 7, 100):
        got = control.improving_reports(reports, max_rows)
        assert rows(got, "query_id", "taxi_id", "event_time") == want
    assert len(want) > 200


def test_taxi_query_refuses_other_text(spark):
    for text in [r"'\'' = version() OR ' = '", "ride.taxi_id = '", r"'a\\' = 'b'", "1=1; drop", "java_method('a','b')", "ride.secret = 1", "x > 1", "`a`", "true -- x", "(SELECT 1) = 1"]:
        with pytest.raises(ValueError):
            control.checked_predicate(text)
    control.checked_predicate("NOT ride.is_start AND ride.taxi_id IN (1, 2) OR watermark > 5")


def test_taxi_query_answers(spark):
    data = [ride(1, begin=at(0)), ride(2, begin=at(50), taxi=2), ride(1, False, at(0), at(70)), ride(3, begin=at(80), taxi=3)]
    got = rows(control.taxi_query(ride_table(spark, data), [(at(60), "ride.is_start"), (at(75), "false")]))
    tags = [g[0] for g in got]
    assert tags == ["PBE@2000-01-01 01:00:00"] * 2 + ["QUERY"] * 2
    assert got[0][1].startswith("1,START,2000-01-01 00:00:00,1970-01-01 00:00:00,-73.9947,40.750626,")


RIDE_LINE = "6,START,2013-01-01 00:00:00,1970-01-01 00:00:00,-73.866135,40.771091,-73.961334,40.764912,6,2013000006,2013000006"
END_LINE = "6,END,2013-01-01 00:11:00,2013-01-01 00:00:00,-73.866135,,-73.961334,40.764912,6,2013000006,2013000006"


def test_ride_lines_from_gzip(spark, tmp_path):
    with gzip.open(tmp_path / "rides.gz", "wt") as f:
        f.write(RIDE_LINE + "\n" + END_LINE + "\n")
    options = connectors.EventFiles(str(tmp_path / "rides.gz"), 60)
    got = connectors.read_rides(spark, options).orderBy("event_time").collect()
    assert [g["event_time"] for g in got] == [datetime(2013, 1, 1), datetime(2013, 1, 1, 0, 11)]
    assert got[1]["start_time"] == datetime(2013, 1, 1) and got[1]["start_lat"] == 0.0 and got[1]["passenger_cnt"] == 6
    view = connectors.table_view(connectors.read_rides(spark, options), "TaxiRides")
    assert "start_time" not in view.columns and spark.table("TaxiRides").count() == 2
    again = lines.from_ride_values(lines.to_ride_values(connectors.read_rides(spark, options)))
    assert rows(again) == rows(connectors.read_rides(spark, options).drop("event_time"))


@pytest.mark.parametrize("bad", ["1,START", RIDE_LINE.replace("START", "STOP"), RIDE_LINE.replace("6,START", "x,START"), RIDE_LINE + ",1"])
def test_bad_ride_lines(spark, bad):
    df = spark.createDataFrame([(RIDE_LINE,), (bad,)], "value STRING")
    marked = lines.parse_ride_lines(df, strict=False)
    assert rows(marked.filter("_corrupt is not null"), "_corrupt", "ride_id") == [(bad, None)]
    assert marked.filter("ride_id = 6").count() == 1
    with pytest.raises(Exception, match="Invalid record"):
        lines.parse_ride_lines(df).collect()


def test_fare_and_car_lines(spark):
    text = "1,2013000001,2013000001,2013-01-01 00:00:00,CSH,0,,6.5"
    got = lines.parse_fare_lines(spark.createDataFrame([(text,)], "value STRING")).first()
    assert (got["payment_type"], got["tip"], got["tolls"], got["total_fare"]) == ("CSH", 0.0, 0.0, 6.5)
    tokens = ["car7", "e1"] + ["0"] * 5 + ["3.5"] + ["x", "88.5", "x", "x", "12.25"] + ["x"] * 6 + ["40.5", "8.6", "49.8"]
    tokens.append("2017-01-16T16:00:00.000Z")
    mixed = ", ".join(tokens[:10]) + ";" + "; ".join(tokens[10:])
    got = lines.parse_car_lines(spark.createDataFrame([(mixed,)], "value STRING")).first()
    assert (got["car_id"], got["event_id"], got["speed"], got["throttle"]) == ("car7", "e1", 88.5, 12.25)
    assert got["ts"] == datetime(2017, 1, 16, 16) and math.isclose(got["latitude"], 49.8, rel_tol=1e-6)
    short = spark.createDataFrame([("a,b",)], "value STRING")
    assert lines.parse_car_lines(short, strict=False).first()["_corrupt"] == "a,b"


def test_connector_options():
    with pytest.raises(ValueError):
        connectors.EventFiles("")
    with pytest.raises(ValueError):
        connectors.EventFiles("x", -1)
    assert connectors.EventFiles("x").max_event_delay_secs == 0


def test_raw_files(spark, folder):
    events_text = raw.trip_events(views.raw_trip_lines(spark, folder))
    times = [r["event_time"] for r in events_text.collect()]
    assert times == sorted(times)
    parsed = lines.parse_ride_lines(events_text.select("value"))
    assert parsed.count() == 2 * views.table(spark, folder, "orders").count()
    fares = lines.parse_fare_lines(raw.fare_records(views.raw_fare_lines(spark, folder)))
    assert rows(fares.select("ride_id", F.round("tip", 2))) == rows(views.fares(spark, folder).select("ride_id", F.round("tip", 2)))


def test_csv_readers(spark, tmp_path):
    (tmp_path / "trips.csv").write_text("bike_id,duration,start_station_name,end_station_name,zip_code\n1,60,A,B,94107\n")
    (tmp_path / "stations.csv").write_text("id,name,lat,long\n2,A,37.3,-121.9\n")
    (tmp_path / "languages.csv").write_text("name,wikipedia_url\nC#,u\n")
    assert rows(connectors.read_trips(spark, str(tmp_path / "trips.csv"))) == [(1, 60, "A", "B", "94107")]
    assert rows(connectors.read_stations(spark, str(tmp_path / "stations.csv"))) == [(2, "A", 37.3, -121.9)]
    assert rows(connectors.read_languages(spark, str(tmp_path / "languages.csv"))) == [("C#",)]
