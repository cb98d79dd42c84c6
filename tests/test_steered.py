"""Streams steered by messages, change logs, sinks by tag, lateness per input, late rows, SQL text, expiry and state."""

import time
from datetime import timedelta

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rillstone import schemas, views
from rillstone.operators import events
from rillstone.plans import control, rides
from rillstone.session import shared_folder
from rillstone.sources import named
from rillstone.streaming import expiry, late, sinks, steered
from rillstone.streaming import queries as stream
from rillstone.streaming.runner import Replay, data_batches_only, stepped_stream, watermark_policy
from test_events import T0, at, fare, fare_table, ride, ride_table

NEAR, FAR = (-73.99, 40.75), (-73.80, 40.65)


def message(minutes, *parts):
    return at(minutes).replace(tzinfo=None), "|".join(map(str, (at(minutes), *parts)))


def append(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


class Live:
    """A steered query over two folders that grow."""

    def __init__(self, spark, **answer):
        self.spark, home = spark, shared_folder(spark, "live")
        self.events, self.talk, self.home = f"{home}/events", f"{home}/talk", f"{home}/run"
        append(ride_table(spark, []), self.events)
        spark.createDataFrame([], "value STRING").write.text(self.talk)
        self.fold = steered.Steered(self.home, **answer)

    def hear(self, *rides_in, lines=()):
        if rides_in:
            append(ride_table(self.spark, list(rides_in)), self.events)
        if lines:
            self.spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1).write.mode("append").text(self.talk)
        self.run()

    def run(self):
        source = self.spark.readStream.schema(schemas.RIDE).parquet(self.events)
        both = steered.merged(source, self.spark.readStream.text(self.talk))
        writer = both.writeStream.foreachBatch(self.fold).option("checkpointLocation", f"{self.home}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()

    def answers(self, *columns):
        return rows(self.fold.answers(self.spark), *columns)


def test_messages_are_typed(spark):
    lines = ["2013-01-01 00:00:00|threshold|30", "2013-01-01 00:00:00|location|7|-73.9|40.7", "2013-01-01 00:00:00|predicate|a | b"]
    bad = ["30", "", "x|threshold|3", "2013-01-01 00:00:00|threshold|many", "2013-01-01 00:00:00|location|7|-73.9", "2013-01-01 00:00:00|else|1"]
    got = steered.control_rows(spark.createDataFrame([(x,) for x in [*lines, *bad, None]], "value STRING")).collect()
    assert [(r.kind, r.number) for r in got[:3]] == [("threshold", 30), ("location", 7), ("predicate", None)]
    assert (round(got[1].lon, 3), got[2].text) == (-73.9, "a | b")
    assert [(r.kind, r.text) for r in got[3:]] == [("refused", x) for x in [*bad, None]]


def test_a_threshold_is_put_to_the_table_kept_by_then(spark):
    out = f"{schemas.RIDE}, n BIGINT, asked_at TIMESTAMP"
    live = Live(spark, out_schema=out, on_control=steered.ongoing_rides)
    live.hear(ride(1, begin=at(0), taxi=1), ride(2, begin=at(50), taxi=2))
    assert live.answers() == []
    live.hear(lines=[message(60, "threshold", 30)[1]])
    assert live.answers("ride_id", "n") == [(1, 30)]
    live.hear(ride(1, False, at(0), at(70), taxi=1))
    live.run()
    assert live.answers("ride_id", "n") == [(1, 30)]
    live.hear(lines=[message(90, "threshold", 30)[1], "not a message"])
    assert live.answers("ride_id", "asked_at") == [(1, at(60)), (2, at(90))]


def test_a_location_counts_for_later_events_only(spark):
    live = Live(spark, out_schema=steered.REPORT, on_events=steered.reports)
    best = lambda: rows(steered.nearest(live.fold.answers(spark)), "query_id", "taxi_id")
    end = lambda k, spot: ride(k, False, at(0), at(k), b=spot, taxi=k)
    live.hear(end(1, NEAR), lines=[message(1, "location", 5, *NEAR)[1]])
    assert best() == []
    live.hear(end(2, FAR))
    assert best() == [(5, 2)]
    live.hear(end(3, NEAR), lines=[message(3, "location", 6, *NEAR)[1]])
    live.hear(end(4, FAR))
    live.run()
    assert best() == [(5, 3), (6, 4)]


def test_a_predicate_asks_kept_rides_and_later_events(spark):
    live = Live(spark, out_schema=steered.ANSWER, on_control=steered.asked_of_kept, on_events=steered.asked_of_events)
    live.hear(ride(1, begin=at(0), taxi=1), ride(2, begin=at(5), taxi=2))
    live.hear(lines=[message(10, "predicate", "ride.taxi_id = 1")[1]])
    live.hear(ride(3, begin=at(20), taxi=1), ride(4, begin=at(20), taxi=2))
    live.hear(lines=[message(30, "predicate", "ride.taxi_id = 2")[1], message(31, "predicate", "drop(ride.taxi_id)")[1]])
    live.hear(ride(5, begin=at(40), taxi=1), ride(6, begin=at(40), taxi=2))
    tags = sorted((tag.split("@")[0], text.split(",")[0]) for tag, text in live.answers())
    assert tags == [("PBE", "1"), ("PBE", "4"), ("PE", "3"), ("PE", "6"), ("QUERY", "ride.taxi_id = 1"), ("QUERY", "ride.taxi_id = 2"), ("REFUSED", "drop(ride.taxi_id)")]


def test_a_repeated_batch_replaces_its_answers(spark):
    fold = steered.Steered(shared_folder(spark, "again"), steered.ANSWER, steered.asked_of_events, steered.asked_of_kept)
    events_in = lambda *r: ride_table(spark, list(r))
    talk = lambda *x: spark.createDataFrame([(v,) for v in x], "value STRING")
    batches = [
        steered.merged(events_in(ride(1)), talk(message(1, "predicate", "ride.is_start")[1])),
        steered.merged(events_in(ride(2, begin=at(5))), talk()),
        steered.merged(events_in(ride(3, begin=at(9))), talk()),
    ]
    for number in (0, 0, 1, 1, 2, 2):
        fold(batches[number], number)
    assert sorted((t.split("@")[0], x.split(",")[0]) for t, x in rows(fold.answers(spark))) == [("PBE", "1"), ("PE", "2"), ("PE", "3"), ("QUERY", "ride.is_start")]


def test_replay_is_written_once_in_order(spark):
    """A time that a third of the rows share takes several files; rows without a time come last and are not lost."""
    data = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(at(5))).when(F.col("id") > 2900, None).otherwise(F.lit(T0) + F.expr("make_interval(0, 0, 0, 0, 0, 0, id)")).alias("ts"))
    home = f"{shared_folder(spark, 'order')}/files"
    source, seen = stepped_stream(data, "ts", home, steps=9), []
    query = source.writeStream.foreachBatch(lambda df, n: seen.append([r.ts for r in df.collect()])).trigger(availableNow=True)
    query.option("checkpointLocation", f"{home}-check").start().awaitTermination()
    flat = [x for part in seen for x in part]
    assert len(flat) == 3000 and len(seen) >= 8 and max(map(len, seen)) < 700
    bounds = [(min(t), max(t)) for part in seen if (t := [x for x in part if x is not None])]
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))
    assert None in seen[-1] and None not in [x for part in seen[:-1] for x in part]


def changes(spark, steps, shown, keys=("k",), parts=3):
    log = sinks.ChangeLog(shared_folder(spark, "log"), list(keys), "k STRING, n BIGINT", shown, parts)
    for number, step in enumerate(steps):
        batch = spark.createDataFrame(step, "k STRING, n BIGINT")
        log(batch, number)
        log(batch, number)  # again, as after a failure
    return log


def test_log_of_changes(spark):
    steps = [[("a", 1), ("b", 5), (None, 7)], [("a", 6), ("b", 2)], [("a", 6), ("c", 1)], [("a", 9), ("b", 8)], []]
    log = changes(spark, steps, lambda: F.col("n") >= 5)
    assert sorted(map(tuple, log.log(spark).select("batch", "change", "k", "n").collect()), key=str) == sorted([
        (0, "+I", "b", 5), (0, "+I", None, 7), (1, "+I", "a", 6), (1, "-D", "b", 5), (3, "-U", "a", 6), (3, "+U", "a", 9), (3, "+I", "b", 8),
    ], key=str)
    want = [("a", 9), ("b", 8), (None, 7)]
    assert rows(sinks.folded(log.log(spark), ["k"])) == sorted(want, key=repr)
    assert rows(log.image(spark, 4)) == sorted(want, key=repr)


def test_a_place_that_falls_below_the_threshold_is_taken_back(spark):
    schema = schemas.RIDE + ", sign INT"
    signed = lambda *pairs: spark.createDataFrame([(*r, s) for r, s in pairs], schema)
    home = shared_folder(spark, "signed")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(home + "*")
    steps = [[(ride(k, begin=at(1)), 1) for k in range(3)], [(ride(1, begin=at(1)), -1)], [(ride(9, begin=at(2)), 1), (ride(10, begin=at(2)), 1)]]
    replay, log = Replay(spark, "signed"), None
    log = sinks.ChangeLog(replay.home, stream.PLACE_KEYS, stream.PLACE_CHANGES, lambda: F.col("cnt") >= 3)
    for step in steps:
        append(signed(*step), home)
        replay.batches(stream.place_changes(source, "1 day", "sign"), log, "update")
    per_window = [(r.change, r.cnt) for r in log.log(spark).orderBy("window_end", "batch", F.desc("change")).collect()]
    assert per_window == [("+I", 3), ("-D", 3), ("+I", 4)] * 3
    left = [r for n, step in enumerate(steps) for r, s in step if s > 0 and r[0] != 1]
    want = rides.popular_places(ride_table(spark, left), threshold=3)
    assert sorted(r[-1] for r in rows(sinks.folded(log.log(spark), stream.PLACE_KEYS))) == sorted(r[-1] for r in rows(want))


def test_tags_go_to_their_sinks_once(spark, monkeypatch):
    """A failure between two sinks leaves no row twice and none out."""
    home = shared_folder(spark, "tags")
    append(ride_table(spark, [ride(1), ride(2, b=(0.0, 0.0)), ride(3)]), f"{home}/in")
    folders = {tag: f"{home}/{tag}" for tag in ("inside", "outside")}
    sink = sinks.TaggedSinks(folders)
    whole, calls = sinks.TaggedSinks.write, []

    def failing(self, rows_in, folder, number, session):
        calls.append(folder)
        if len(calls) == 2:
            raise OSError("disk gone")
        whole(self, rows_in, folder, number, session)

    def run():
        source = stream.fenced(spark.readStream.schema(schemas.RIDE).parquet(f"{home}/in"))
        writer = source.writeStream.foreachBatch(sink).option("checkpointLocation", f"{home}/check")
        writer.trigger(availableNow=True).start().awaitTermination()

    monkeypatch.setattr(sinks.TaggedSinks, "write", failing)
    with pytest.raises(StreamingQueryException):
        run()
    first = spark.read.parquet(f"{folders['inside']}/batch=0").inputFiles()
    run()
    append(ride_table(spark, [ride(4, b=(0.0, 0.0))]), f"{home}/in")
    run()
    read = {tag: rows(spark.read.schema(schemas.RIDE).parquet(f"{f}/batch=*"), "ride_id") for tag, f in folders.items()}
    assert read == {"inside": [(1,), (3,)], "outside": [(2,), (4,)]}
    assert spark.read.parquet(f"{folders['inside']}/batch=0").inputFiles() == first


def test_a_tag_without_a_sink(spark):
    home = shared_folder(spark, "rest")
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id INT, output_tag STRING")
    with pytest.raises(ValueError, match="without a sink"):
        sinks.TaggedSinks({"a": f"{home}/a"})(batch, 0)
    sinks.TaggedSinks({"a": f"{home}/a"}, f"{home}/rest")(batch, 0)
    assert rows(spark.read.parquet(f"{home}/rest/batch=*"), "id") == [(2,), (3,)]


@pytest.mark.parametrize("policy, found, kept", [("min", [(1,), (2,)], 2), ("max", [(1,)], 1)])
def test_lateness_of_each_input(spark, policy, found, kept):
    """The fare of ride 2 comes when rides are two hours ahead: late by the faster watermark, in time by the slower one."""
    ride_home, fare_home = (shared_folder(spark, n) for n in ("late-rides", "late-fares"))
    replay = Replay(spark, f"policy-{policy}")
    source = spark.readStream.schema(schemas.RIDE).parquet(ride_home + "*")
    fares = spark.readStream.schema(schemas.FARE).parquet(fare_home + "*")
    joined = stream.rides_and_fares(source, fares, "10 MINUTES", "1 minute", "6 hours")
    with watermark_policy(spark, policy):
        for ride_step, fare_step in (([ride(1), ride(2)], [fare(1)]), ([ride(3, begin=at(120))], []), ([], []), ([], [fare(2)])):
            append(ride_table(spark, ride_step), ride_home)
            append(fare_table(spark, fare_step), fare_home)
            got = replay.to_table(joined)
    assert rows(got, "ride_id") == found
    waiting = replay.state(joinSide="left").select("value.ride_id").distinct().count()
    assert waiting == kept + (policy == "min")
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "min"


def test_late_rows_are_told_apart_in_the_stream(spark):
    schema = "id BIGINT, ts TIMESTAMP, arrival BIGINT"
    steps = [[(1, at(0), 1), (2, at(10), 2), (3, at(1), 3)], [(4, at(9), 4), (5, at(9.5), 5), (6, None, 6)], [(7, at(30), 7), (8, at(5), 8)]]
    found = late.LateRows(shared_folder(spark, "late"), "ts", "1 MINUTE", ("arrival",))
    for number, step in enumerate(steps):
        for _ in range(2):
            found(spark.createDataFrame(step, schema), number)
    per_batch = spark.read.parquet(f"{found.home}/late").select("id", "batch")
    assert rows(per_batch) == [(3, 0), (4, 1), (8, 2)]
    assert found.counts(spark).agg(F.sum("cnt")).first()[0] == 3
    want = events.mark_late(spark.createDataFrame([r for s in steps for r in s], schema), "ts", ["arrival"], "1 MINUTE")
    assert rows(want.filter("is_late"), "id") == rows(per_batch, "id")


def test_sql_text_in_update_mode(spark, folder):
    """The text over the declared view, in update mode: the newest count of a place is that of the table."""
    table = views.rides(spark, folder)
    replay = Replay(spark, "sql-update")
    seen = replay.latest(stream.popular_places_sql(replay.stepped(table, "start_time"), 2, "2 days"), ["location", "wstart", "is_start"])
    want = rides.popular_places_sql(spark, table, 2)
    assert rows(seen) == rows(want) and want.count() > 0
    counted = spark.sql("SELECT is_start, count(*) AS n FROM TaxiRides GROUP BY is_start")
    assert counted.isStreaming


def test_a_best_report_is_forgotten_by_the_clock(spark):
    home = shared_folder(spark, "expiry")
    schema = "query_id BIGINT, taxi_id BIGINT, distance DOUBLE"
    replay = Replay(spark, "expiry")
    source = spark.readStream.schema(schema).parquet(home + "*")

    def hear(*reports, keep=timedelta(hours=8)):
        append(spark.createDataFrame(list(reports), schema), home)
        with data_batches_only(spark):
            return sorted(map(tuple, replay.to_table(expiry.improvements(source, keep)).collect()))

    assert hear((1, 10, 5.0), (2, 20, 1.0), (3, 30, None)) == [(1, 10, 5.0), (2, 20, 1.0)]
    assert hear((1, 11, 7.0), (2, 21, 0.5)) == [(1, 10, 5.0), (2, 20, 1.0), (2, 21, 0.5)]
    assert replay.state(stateVarName="best").count() == 2


def test_expired_state_is_gone(spark):
    home = shared_folder(spark, "expired")
    schema = "query_id BIGINT, taxi_id BIGINT, distance DOUBLE"
    replay = Replay(spark, "expired")
    reports = expiry.improvements(spark.readStream.schema(schema).parquet(home + "*"), timedelta(milliseconds=1))
    for report in ((1, 10, 5.0), (1, 11, 7.0), (2, 12, 9.0)):
        append(spark.createDataFrame([report], schema), home)
        with data_batches_only(spark):
            got = replay.to_table(reports)
        time.sleep(0.1)
    assert sorted(map(tuple, got.collect())) == [(1, 10, 5.0), (1, 11, 7.0), (2, 12, 9.0)]
    assert replay.state(stateVarName="best").filter("key.query_id = 1").count() == 0


def test_named_source(spark, tmp_path):
    line = "{},START,2013-01-01 00:0{}:00,1970-01-01 00:00:00,-73.9,40.7,-73.9,40.7,1,1,1"
    place = tmp_path / "in"
    place.mkdir()
    (place / "a.csv").write_text("\n".join(line.format(i, i) for i in range(3)) + "\n")
    (place / "_hidden").write_text("no line")
    options = {"path": str(place), "maxEventDelaySecs": "60"}
    assert rows(named.read_named(spark, "taxi-rides", **options), "ride_id") == [(0,), (1,), (2,)]
    assert spark.read.format("taxi-rides").options(**options).load().rdd.getNumPartitions() == 1
    for wrong in ({}, {"path": ""}, {"path": str(place), "maxEventDelaySecs": "-1"}, {"path": str(place), "speed": "2"}):
        with pytest.raises(ValueError, match="option"):
            named.read_named(spark, "taxi-rides", **wrong)
    replay = Replay(spark, "named")
    counted = lambda: rows(replay.latest(stream.ride_count(named.read_named(spark, "taxi-rides", True, **options)), ["driver_id"]))
    assert counted() == [(1, 3)]
    time.sleep(0.05)
    (place / "0.csv").write_text(line.format(7, 7) + "\r\n")
    assert counted() == [(1, 4)]


def test_blocks_of_hours(spark):
    """Blocks cover each hour of a span once, and a long span has few of them."""
    spans = [(0, 0), (5, 70), (63, 64), (64, 127), (1, 9000), (4096, 8191), (-70, 130), (380_000, 467_649)]
    df = spark.createDataFrame(spans, "a BIGINT, b BIGINT")
    for r in df.withColumn("blocks", control._blocks_between(F.col("a"), F.col("b"))).collect():
        hours = [h for size, block in r.blocks for h in range(size * block, size * (block + 1))]
        assert sorted(hours) == list(range(r.a, r.b + 1)) and len(r.blocks) < 300


def test_sketches_add_up(spark):
    from rillstone.plans import bikes

    trips = spark.range(200_000).selectExpr("id % 50000 AS bike_id", "cast(id % 7 AS string) AS zip_code")
    sketched = bikes.bike_sketches(trips, "zip_code")
    assert abs(bikes.bikes_of_sketches(sketched).first().n - 50_000) <= 1000
    assert bikes.bikes_of_sketches(sketched, "zip_code").count() == 7
    assert "Expand" not in sketched._jdf.queryExecution().executedPlan().toString()
