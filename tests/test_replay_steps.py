"""What a replay sends to the driver, and how its steps grow with the table."""

import re

from pyspark.sql import functions as F

from rillstone import views
from rillstone.plans import control
from rillstone.streaming import runner
from rillstone.streaming.runner import Replay
from test_events import at
from test_plans import plan
from verification.bindings import CONTROL_ROWS


def builds(df):
    return re.findall(r"BroadcastHashJoin.*(Build(?:Left|Right))", plan(df))


def test_reports_are_not_sent_to_the_driver(spark, folder):
    """Only the control rows and the row per query and range are; the rides and reports are shorter here, but not at size."""
    asked = spark.createDataFrame(CONTROL_ROWS, "query_id BIGINT, lon FLOAT, lat FLOAT, ts TIMESTAMP")
    reports = control.active_reports(views.rides(spark, folder), control.active_queries(asked))
    assert "BuildRight" in builds(reports) and "BuildLeft" not in builds(reports)
    assert builds(control.improving_reports(reports)) == ["BuildRight"]


def timed(spark, n):
    return spark.range(n).select("id", (F.lit(at(0)) + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("ts"))


def read_in_steps(stream, spark, name):
    """The ids of each micro-batch."""
    seen = []
    Replay(spark, name).batches(stream, lambda batch, number: seen.append([r.id for r in batch.select("id").collect()]))
    return seen


def test_a_step_of_a_large_table_has_several_files(spark, monkeypatch):
    monkeypatch.setattr(runner, "FILE_ROWS", 10, raising=False)
    replay = Replay(spark, "files")
    steps = read_in_steps(replay.stepped(timed(spark, 400), "ts"), spark, "files-read")
    assert len(spark.read.parquet(f"{replay.home}/source-1").inputFiles()) == 40
    assert len(steps) == 4 and sorted(sum(steps, [])) == [*range(400)]
    assert all(max(a) < min(b) for a, b in zip(steps, steps[1:]))


def test_sources_of_a_replay_have_the_same_steps(spark, monkeypatch):
    """Steps grow with the rows of a core, and a shorter table does not run ahead of a longer one."""
    monkeypatch.setattr(runner, "CORE_ROWS", 10, raising=False)
    replay, cores = Replay(spark, "pair"), spark.sparkContext.defaultParallelism
    long, short = replay.stepped(timed(spark, 80 * cores), "ts"), replay.stepped(timed(spark, 20 * cores), "ts")
    assert [len(read_in_steps(s, spark, "pair-read")) for s in (long, short)] == [8, 8]
