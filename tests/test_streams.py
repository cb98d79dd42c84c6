"""Streaming runs: several micro-batches, restarts, late rows, state snapshots."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rillstone import schemas, views
from rillstone.operators import events
from rillstone.plans import control, rides
from rillstone.session import shared_folder
from rillstone.sources import connectors
from rillstone.streaming import steps
from rillstone.streaming import queries as stream
from rillstone.streaming.runner import FLUSH_TIME, Replay, table_stream
from test_events import at, fare, fare_table, ride, ride_table
from verification.bindings import CAR_FLUSH, CONTROL_ROWS, FARE_FLUSH, RIDE_FLUSH


def in_files(spark, folder, name, parts, source):
    """A table cut into several files, in an order unrelated to event time."""
    home = shared_folder(spark, "split")
    df = spark.read.parquet(f"{source}/{name}.parquet")
    df.repartition(parts).write.parquet(f"{home}/{name}.parquet")
    return home


def test_many_small_batches_equal_one_table(spark, folder):
    home = in_files(spark, folder, "events", 3, folder)
    replay = Replay(spark, "sessions")
    source = replay.flushed(views.cars_of(table_stream(spark, home, "events", files_per_batch=1)), CAR_FLUSH)
    result, want = stream.driving_sessions(source, "6 hours", "60 days"), events.sessions(views.cars(spark, folder), "6 HOURS")
    digits = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in want.dtypes]
    assert rows(replay.to_table(result).select(*digits)) == rows(want.select(*digits))


def in_time_steps(spark, df, ts, count, name):
    """A stream of ``count`` files that follow each other in event time."""
    low, high = df.agg(F.unix_micros(F.min(ts)), F.unix_micros(F.max(ts))).first()
    width = (high - low) // count + 1
    step = F.floor((F.unix_micros(ts) - low) / width)
    return file_stream(spark, [df.filter(step == i) for i in range(count)], name)


@pytest.mark.parametrize(
    "name, max_rows",
    [("segments", 20), ("strict", 1_000_000), ("positions", 20), ("predictions", 20), ("pairs", 20), ("closest", 1_000_000)],
)
def test_steps_carry_over_between_batches(spark, folder, name, max_rows):
    """Short watermark delays: most rows are handled batch by batch, not in the last one."""
    replay = Replay(spark, name)
    table = views.cars(spark, folder)
    if name in ("segments", "strict"):
        source = replay.flushed(in_time_steps(spark, table, "ts", 3, name), CAR_FLUSH)
        want = events.driving_segments(table, name == "strict")
        got = replay.steps(
            source, "ts", "2 HOURS", steps.segments_step(name == "strict", max_rows), steps.SEGMENT_CARRY,
            "car_id BIGINT, start_time TIMESTAMP, length BIGINT, max_speed INT, erraticness DOUBLE, label STRING",
        )
    elif name == "positions":
        source = replay.flushed(in_time_steps(spark, table, "ts", 3, name), CAR_FLUSH)
        want = events.positions(table, ["car_id"], ["ts", "event_id"])
        got = replay.steps(
            source, "ts", "2 HOURS", steps.positions_step(max_rows), steps.POSITION_CARRY,
            "car_id BIGINT, event_id BIGINT, ts TIMESTAMP, arrival TIMESTAMP, speed DOUBLE, throttle DOUBLE, pos BIGINT",
        )
    elif name == "predictions":
        data = steps.prediction_rows(views.rides(spark, folder))
        flush = [(FLUSH_TIME, True, -1, -1, 0, 1.0, 1.0, 1.0)]
        source = replay.flushed(in_time_steps(spark, data, "event_time", 3, name), flush)
        want = rides.travel_time_prediction(views.rides(spark, folder))
        got = replay.steps(
            source, "event_time", "10 MINUTES", steps.predictions_step(max_rows), steps.PREDICTION_CARRY,
            "ride_id BIGINT, predicted_minutes INT",
        )
    elif name == "pairs":
        raw = spark.read.parquet(f"{folder}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
        data = steps.pair_rows(views.items_of(raw, "ts"), views.rules(spark))
        source = replay.flushed(in_time_steps(spark, data, "ts", 3, name), [("", -1, FLUSH_TIME, -1, True, False)])
        want = events.rule_pairs(views.items(spark, folder), views.rules(spark))
        got = replay.steps(
            source, "ts", "1 HOUR", steps.pairs_step(max_rows), steps.PAIR_CARRY,
            "rule STRING, color BIGINT, first_seq BIGINT, second_seq BIGINT",
        )
    else:
        asked = spark.createDataFrame(CONTROL_ROWS, "query_id BIGINT, lon FLOAT, lat FLOAT, ts TIMESTAMP")
        data = control.active_reports(views.rides(spark, folder), control.active_queries(asked))
        source = replay.flushed(in_time_steps(spark, data, "event_time", 3, name), [(-1, -1, -1, FLUSH_TIME, 0.0)])
        want = control.nearest_taxi_expiring(views.rides(spark, folder), asked)
        got = replay.steps(
            source, "event_time", "10 MINUTES", steps.closest_step(max_rows), steps.REPORT_CARRY,
            "query_id BIGINT, taxi_id BIGINT, event_time TIMESTAMP, distance FLOAT",
        )
    digits = [F.round(c, 6).alias(c) if t in ("double", "float") else F.col(c) for c, t in want.dtypes]
    assert rows(got.select(*digits)) == rows(want.select(*digits))
    assert len(spark.read.parquet(f"{replay.home}/state/0").collect()) == 1


def test_a_repeated_batch_replaces_its_first_attempt(spark):
    home = shared_folder(spark, "repeat")
    fold = steps.OrderedSteps(home, "ts", "1 MINUTE", steps.positions_step(), steps.POSITION_CARRY)
    schema = "car_id BIGINT, event_id BIGINT, ts TIMESTAMP, arrival TIMESTAMP, speed DOUBLE, throttle DOUBLE"
    batch = lambda *events: spark.createDataFrame([(1, i, at(m), at(m), 1.0, 1.0) for i, m in events], schema)
    fold(batch((1, 0), (2, 10)), 0)
    fold(batch((3, 5), (4, 20)), 1)
    fold(batch((3, 9.5), (4, 20), (9, 1)), 1)
    fold(batch((5, 60)), 2)
    out = spark.read.schema("event_id BIGINT, pos BIGINT").parquet(f"{home}/out/*")
    assert rows(out) == [(1, 1), (2, 3), (3, 2), (4, 4)]


def test_restart_continues_from_the_checkpoint(spark, folder):
    home = shared_folder(spark, "grown")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    early, late = orders.filter("o_totalprice < 200000"), orders.filter("o_totalprice >= 200000")
    early.write.parquet(f"{home}/orders.parquet")
    place = shared_folder(spark, "restart")

    def run():
        replay = Replay(spark, "restart", place)
        counted = replay.latest(stream.ride_count(views.rides_of(table_stream(spark, home, "orders"))), ["driver_id"])
        return rows(counted)

    assert run() == rows(rides.ride_count(views.rides_of(early)))
    late.write.mode("append").parquet(f"{home}/orders.parquet")
    assert run() == rows(rides.ride_count(views.rides_of(orders)))
    assert run() == rows(rides.ride_count(views.rides_of(orders)))


def file_stream(spark, tables, name):
    """One file per step."""
    home = shared_folder(spark, name)
    for t in tables:
        t.coalesce(1).write.mode("append").parquet(home)
    return spark.readStream.schema(tables[0].schema).option("maxFilesPerTrigger", 1).parquet(home)


@pytest.mark.parametrize("turned", [False, True])
def test_unmatched_fares_in_both_orders(spark, turned):
    pair = [fare_table(spark, [fare(1)]), fare_table(spark, [fare(2)])]
    replay = Replay(spark, "unmatched")
    fares = replay.flushed(file_stream(spark, pair[::-1] if turned else pair, "fares"), FARE_FLUSH)
    seen = replay.flushed(file_stream(spark, [ride_table(spark, [ride(1)])], "rides"), RIDE_FLUSH)
    assert rows(replay.to_table(stream.unmatched_fares(seen, fares, "1 HOUR")), "ride_id") == [(2,)]


def test_pairs_beyond_the_bound_are_alike_in_both_forms(spark):
    """Ride 2 starts two hours before its fare: a pair only where the bound allows it."""
    asked, paid = [ride(1, begin=at(0)), ride(2, begin=at(0))], [fare(1, 1, at(5)), fare(2, 1, at(120))]
    ride_rows, fare_rows = ride_table(spark, asked), fare_table(spark, paid)
    for bound, pairs in (("1 HOUR", [(1,)]), ("3 HOURS", [(1,), (2,)])):
        for form in ("rides_and_fares", "unmatched_fares", "unmatched_rides"):
            replay = Replay(spark, "bound")
            seen = replay.flushed(file_stream(spark, [ride_rows], "rides"), RIDE_FLUSH)
            fares = replay.flushed(file_stream(spark, [fare_rows], "fares"), FARE_FLUSH)
            got = rows(replay.to_table(getattr(stream, form)(seen, fares, bound=bound)), "ride_id")
            assert got == rows(getattr(rides, form)(ride_rows, fare_rows, bound), "ride_id")
            assert got == (pairs if form == "rides_and_fares" else sorted({(1,), (2,)} - set(pairs)))


def test_only_rows_within_the_delay_are_kept(spark, folder):
    """Most cars are handled in their own batch; what waits is bounded by the delay, and old folders are gone."""
    replay = Replay(spark, "bounded")
    table = views.cars(spark, folder)
    source = replay.flushed(replay.stepped(table, "arrival"), CAR_FLUSH)
    replay.steps(
        source, "ts", "30 MINUTES", steps.positions_step(), steps.POSITION_CARRY,
        "car_id BIGINT, event_id BIGINT, ts TIMESTAMP, arrival TIMESTAMP, speed DOUBLE, throttle DOUBLE, pos BIGINT",
        ("arrival", "event_id"),
    )
    pending = [spark.read.parquet(f"{replay.home}/state/{i}").first()["pending"] for i in range(5)]
    assert len(pending) == 5 and max(pending) < 0.05 * table.count()
    with pytest.raises(AnalysisException):
        spark.read.parquet(f"{replay.home}/pending/1")
    late = events.mark_late(table, "ts", ["arrival", "event_id"], "30 MINUTES").filter("is_late")
    assert replay.late(source.schema).count() == late.count() > 0


def test_rows_behind_the_watermark_are_dropped(spark):
    early = fare_table(spark, [fare(1, 1, at(0), 1.0)])
    steps = [fare_table(spark, [fare(2, 1, at(300), 2.0)]), fare_table(spark, [fare(3, 1, at(310), 4.0)]), early]
    replay = Replay(spark, "late")
    fares = replay.flushed(file_stream(spark, steps, "late"), FARE_FLUSH)
    got = rows(replay.to_table(stream.hourly_tips(fares, "60 seconds")))
    assert got == [(at(360), 1, 6.0)]


def test_long_rides_wait_for_order(spark):
    data = []
    for number, begin in [(1, 0), (2, 60), (3, 120)]:
        data += [ride(number, begin=at(begin)), ride(number, False, at(begin), at(begin + 10))]
    data.append(ride(4, begin=at(5)))
    steps = [ride_table(spark, [r]) for r in data[::-1]]
    replay = Replay(spark, "long")
    source = replay.flushed(file_stream(spark, steps, "backwards-long"), RIDE_FLUSH)
    assert rows(replay.to_table(stream.long_rides(source, "1 day")), "ride_id") == [(4,)]


def test_text_files_as_a_stream(spark, tmp_path):
    line = "{},START,2013-01-01 00:0{}:00,1970-01-01 00:00:00,-73.9,40.7,-73.9,40.7,1,1,1"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join(line.format(i, i) for i in range(5)) + "\n")
    source = connectors.read_rides(spark, connectors.EventFiles(str(tmp_path / "in"), 60), streaming=True)
    assert source.isStreaming
    counted = Replay(spark, "text").latest(stream.ride_count(source), ["driver_id"])
    assert rows(counted) == [(1, 5)]


def test_control_messages(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "1.txt").write_text("30\n60\n")
    messages = connectors.read_messages(spark, str(tmp_path / "m"))
    got = Replay(spark, "messages").to_table(messages.select(F.col("value").cast("bigint").alias("n")))
    assert rows(got) == [(30,), (60,)]
