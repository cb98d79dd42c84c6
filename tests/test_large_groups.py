"""Cutting large groups into slices must not change any result."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rillstone import views
from rillstone.operators import documents, events, relational
from rillstone.operators.ordered import running, slice_groups
from rillstone.plans import cars, control, rides
from verification.bindings import CONTROL_ROWS

TINY = 25


def skewed(spark):
    """One key holds most rows, and many of its rows share one time."""
    base = datetime(2024, 1, 1)
    data = []
    for i in range(600):
        key = "hot" if i % 3 else f"k{i % 7}"
        at = base if i % 2 else base + timedelta(seconds=(i * 37) % 500)
        data.append((key, at, i, (i * 31) % 97))
    return spark.createDataFrame(data, "k STRING, ts TIMESTAMP, id BIGINT, v BIGINT"), data


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("reverse", [True, False])
@pytest.mark.parametrize("keys", [["k"], []])
def test_running_values_match_a_plain_loop(spark, inclusive, reverse, keys):
    df, data = skewed(spark)
    s = slice_groups(df, keys, ["ts", "id"], TINY)
    assert s.df.filter("k = 'hot'").select("_slice").distinct().count() > 10
    odd = F.when(F.col("v") % 2 == 1, F.col("v"))
    s = running(
        s,
        {
            "total": ("sum", F.col("v")), "n": ("count", odd), "low": ("min", F.col("v")), "high": ("max", odd),
            "near": ("last", odd),
        },
        inclusive=inclusive,
        reverse=reverse,
    )
    got = {r["id"]: (r["total"], r["n"], r["low"], r["high"], r["near"]) for r in s.rows().collect()}
    want, groups = {}, {}
    for key, at, i, v in data:
        groups.setdefault(key if keys else "", []).append((at, i, v))
    for members in groups.values():
        members.sort(reverse=reverse)
        for p, (_, i, _) in enumerate(members):
            seen = [v for _, _, v in members[: p + 1 if inclusive else p]]
            odds = [v for v in seen if v % 2]
            want[i] = (
                sum(seen) if seen else None, len(odds), min(seen, default=None), max(odds, default=None),
                odds[-1] if odds else None,
            )
    assert got == want


def test_null_key_is_a_group(spark):
    df, _ = skewed(spark)
    df = df.withColumn("k", F.when(F.col("k") != "hot", F.col("k")))
    s = running(slice_groups(df, ["k"], ["ts", "id"], TINY), {"n": ("count", F.lit(1))})
    assert s.df.filter("k is null").select("_slice").distinct().count() > 10
    got = sorted(r["n"] for r in s.rows().filter("k is null").collect())
    assert got == list(range(1, 401))


def test_ranges_are_even_whatever_the_groups(spark):
    df, _ = skewed(spark)
    sizes = [r["count"] for r in slice_groups(df, ["k"], ["ts", "id"], TINY).df.groupBy("_slice").count().collect()]
    assert len(sizes) > 20 and max(sizes) <= 2 * TINY


def test_ranges_follow_the_shuffle_partitions(spark):
    df, _ = skewed(spark)
    ranges = slice_groups(df, ["k"], ["ts", "id"]).df.select("_slice").distinct().count()
    assert 1 <= ranges <= int(spark.conf.get("spark.sql.shuffle.partitions"))


CASES = {
    "segments": lambda s, d, n: events.driving_segments(views.cars(s, d), max_rows=n),
    "segments_strict": lambda s, d, n: events.driving_segments(views.cars(s, d), strict=True, max_rows=n),
    "sessions": lambda s, d, n: events.sessions(views.cars(s, d), "6 HOURS", n),
    "late": lambda s, d, n: events.mark_late(views.cars(s, d), "ts", cars.ARRIVAL, "30 MINUTES", n),
    "positions": lambda s, d, n: events.positions(views.cars(s, d), ["car_id"], ["ts", "event_id"], n),
    "pairs": lambda s, d, n: events.rule_pairs(views.items(s, d), views.rules(s), n),
    "asof": lambda s, d, n: events.asof_customers(views.trades(s, d), views.customer_changes(s, d), n),
    "running_count": lambda s, d, n: rides.ride_count_running(views.rides(s, d), n),
    "prediction": lambda s, d, n: rides.travel_time_prediction(views.rides(s, d), n),
    "improvements": lambda s, d, n: rides.nearest_taxi_improvements(
        views.rides(s, d), views.location_queries(s), max_rows=n
    ),
    "expiring": lambda s, d, n: control.nearest_taxi_expiring(
        views.rides(s, d), s.createDataFrame(CONTROL_ROWS, "query_id BIGINT, lon FLOAT, lat FLOAT, ts TIMESTAMP"), n
    ),
    "index": lambda s, d, n: documents.inverted_index(views.table(s, d, "documents"), block_rows=50, max_rows=n),
    "values": lambda s, d, n: relational.group_values(
        views.table(s, d, "orders"), "o_orderpriority", "o_custkey", "o_orderkey", 50, n
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_slices_give_the_plain_result(spark, folder, name):
    plain = CASES[name](spark, folder, 1_000_000)
    cut = CASES[name](spark, folder, TINY)
    assert cut.columns == plain.columns
    digits = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in plain.dtypes]
    assert rows(cut.select(*digits)) == rows(plain.select(*digits))


def test_repeated_values_with_hot_values(spark):
    data = [(i, 5 if i % 3 else i) for i in range(300)] + [(300, None), (301, None)]
    df = spark.createDataFrame(data, "id BIGINT, value BIGINT")
    want = sorted(((i, v) for i, v in data if v in (5, None)), key=repr)
    assert rows(relational.repeated_values(df, "value", hot_rows=10)) == want
    assert rows(relational.repeated_values(df, "value")) == want
