"""Queries that are steered by a table of control rows: ad-hoc predicates and expiring locations."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions import geo
from rillstone.functions.text import time_text
from rillstone.operators.events import event_time
from rillstone.operators.joins import BROADCAST_ROWS, with_every_row
from rillstone.operators.ordered import running, slice_groups
from rillstone.plans.rides import ride_ends, with_distance
from rillstone.schemas import RIDE_COLUMNS
from rillstone.sources.lines import ride_line

# What the text of an ad-hoc predicate may contain.
PREDICATE_WORDS = {"and", "or", "not", "true", "false", "between", "in", "is", "null", "like"}
PREDICATE_FUNCTIONS = {"abs", "floor", "ceil", "round", "sqrt", "least", "greatest", "planarkm", "isinnyc", "tocellid"}
RIDE_FIELDS = {*RIDE_COLUMNS, "event_millis"}
MAX_EVENT_DELAY = timedelta(seconds=60)


def checked_predicate(text: str) -> Column:
    """A condition over ``ride.<field>`` and ``watermark`` (ms); anything else in the text is refused."""
    if "\\" in text or text.count("'") % 2:
        raise ValueError(f"predicate holds a backslash or an open quote: {text}")
    bare = re.sub(r"'[^']*'", " ", text)
    if re.search(r"[;`\"]|--|/\*", bare):
        raise ValueError(f"predicate holds a forbidden character: {text}")
    for word in re.findall(r"(?<![\w.])[A-Za-z_][\w.]*", bare):
        if word.startswith("ride.") and word[5:] in RIDE_FIELDS:
            continue
        if word == "watermark" or word.lower() in PREDICATE_WORDS | PREDICATE_FUNCTIONS:
            continue
        raise ValueError(f"predicate may not use {word!r}")
    return F.coalesce(F.expr(text).cast("boolean"), F.lit(False))


def ride_struct() -> Column:
    return F.struct(*RIDE_COLUMNS, F.unix_millis(event_time()).alias("event_millis"))


def _by_number(predicates: list[Column], number: str) -> Column:
    """The predicate that belongs to the query number of a row."""
    out = F.lit(False)
    for i, p in enumerate(predicates):
        out = F.when(F.col(number) == i, p).otherwise(out)
    return out


class AdHocQueries:
    """Predicates with the (UTC) times they arrive at, each checked when the object is made."""

    def __init__(self, queries: list[tuple[datetime, str]]):
        self.queries = sorted((at.replace(tzinfo=timezone.utc), text) for at, text in queries)
        self.predicates = [checked_predicate(text) for _, text in self.queries]
        self.times = [F.lit(at) for at, _ in self.queries]

    def echo(self, spark) -> DataFrame:
        return spark.createDataFrame([("QUERY", text) for _, text in self.queries], "tag STRING, text STRING")

    def stored(self, rides: DataFrame) -> DataFrame:
        """Per taxi, the newest ride at the time of each query, in one pass."""
        order = F.struct(event_time(), ~F.col("is_start"), F.col("ride_id"))
        newest = [
            F.max_by(ride_struct(), F.when(event_time() <= at, order)).alias(f"q{i}") for i, at in enumerate(self.times)
        ]
        return rides.groupBy("taxi_id").agg(*newest)

    def stored_answers(self, stored: DataFrame) -> DataFrame:
        entries = [
            F.struct(F.lit(i).alias("number"), at.alias("at"), F.col(f"q{i}").alias("ride"))
            for i, at in enumerate(self.times)
        ]
        found = stored.select(F.inline(F.array(*entries))).filter(F.col("ride").isNotNull())
        return self._matching(found, "PBE")

    def later_answers(self, rides: DataFrame) -> DataFrame:
        """Events after a query that match it while it is the newest."""
        active = F.lit(None).cast("int")
        for i, at in enumerate(self.times):
            active = F.when(F.col("event_at") > at, F.lit(i)).otherwise(active)
        later = rides.select(event_time().alias("event_at"), ride_struct().alias("ride"))
        later = later.withColumn("number", active).filter(F.col("number").isNotNull())
        delay = F.expr(f"INTERVAL {int(MAX_EVENT_DELAY.total_seconds())} SECONDS")
        return self._matching(later.withColumn("at", F.col("event_at") - delay), "PE")

    def _matching(self, df: DataFrame, tag: str) -> DataFrame:
        hits = df.withColumn("watermark", F.unix_millis("at")).filter(_by_number(self.predicates, "number"))
        stamp = F.concat(F.lit(f"{tag}@"), time_text(F.col("at")))
        return hits.select(stamp.alias("tag"), ride_line(F.col("ride")).alias("text"))


def taxi_query(rides: DataFrame, queries: list[tuple[datetime, str]]) -> DataFrame:
    """Answers ``(tag, text)`` to ad-hoc predicates that arrive at the given (UTC) times.

    ``QUERY`` rows repeat the predicate. ``PBE@time`` rows are the newest ride of each taxi that
    matches when the query arrives; ``PE@time`` rows are later events that match while the query is
    the newest. The watermark of a later event trails it by ``MAX_EVENT_DELAY``.
    """
    geo.register_sql_functions(rides.sparkSession)
    asked = AdHocQueries(queries)
    answers = asked.stored_answers(asked.stored(rides)).unionByName(asked.later_answers(rides))
    return asked.echo(rides.sparkSession).unionByName(answers)


QUERY_RETENTION = "15 MINUTES"
REPORT_RETENTION = "8 HOURS"


def active_queries(control: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Location queries with ``until``: the first control row more than 15 minutes later, if any.

    A row with longitude 0 only cleans up and asks nothing.
    """
    probes = control.filter(F.col("lon") != 0).select(
        (F.col("ts") + F.expr(f"INTERVAL {QUERY_RETENTION}")).alias("at"), F.lit(True).alias("_probe"),
        "query_id", "lon", "lat", "ts",
    )
    marks = control.select(
        F.col("ts").alias("at"), F.lit(False).alias("_probe"), "query_id", "lon", "lat", "ts"
    )
    s = slice_groups(probes.unionByName(marks), [], ["at", "_probe", "query_id"], max_rows)
    s = running(s, {"until": ("last", F.when(~F.col("_probe"), F.col("at")))}, inclusive=False, reverse=True)
    return s.rows().filter("_probe").select("query_id", "lon", "lat", "ts", "until")


# Sizes in hours of the blocks of time that stand for a query's hours.
_BLOCKS = (1, 64, 4096)


def _blocks_between(first: Column, last: Column) -> Column:
    """The hours ``first`` to ``last`` as ``(size, block)``: whole blocks inside, smaller ones at both ends."""

    def run(low: Column, high: Column, size: int) -> Column:
        blocks = F.transform(F.sequence(low, high), lambda b: F.struct(F.lit(size).alias("size"), b.alias("block")))
        return F.when(low <= high, blocks).otherwise(F.array().cast("array<struct<size: int, block: bigint>>"))

    out, low, high = [], first, last
    for size, larger in zip(_BLOCKS, (*_BLOCKS[1:], None)):
        if larger is None:
            out.append(run(low, high, size))
            break
        step = larger // size
        inner_low, inner_high = F.ceil(low / step), F.floor((high + 1) / step) - 1
        none = inner_low > inner_high
        out.append(run(low, F.when(none, high).otherwise(inner_low * step - 1), size))
        out.append(run(F.when(none, high + 1).otherwise((inner_high + 1) * step), high, size))
        low, high = inner_low, inner_high
    return F.concat(*out)


def active_reports(rides: DataFrame, queries: DataFrame) -> DataFrame:
    """Distances to the locations that are asked for at the time of the ride's end.

    Rides meet the queries that end by blocks of hours, a few hundred for a query of ten years; only queries without an end,
    those of the last quarter of an hour of the control rows, are put to every ride.
    """
    timed = queries.withColumnRenamed("ts", "since")
    hour = lambda c: F.floor(F.unix_seconds(c) / 3600)
    ends = ride_ends(rides)
    blocks = F.explode(_blocks_between(hour(F.col("since")), hour(F.col("until"))))
    closed = timed.filter("until IS NOT NULL").withColumn("_block", blocks)
    # Without a hint Spark may send the ride ends, of which it knows the size, instead.
    closed = F.broadcast(closed) if closed.count() <= BROADCAST_ROWS else closed.hint("merge")
    places = F.array(*[F.struct(F.lit(n).alias("size"), F.floor(hour(F.col("event_time")) / n).alias("block")) for n in _BLOCKS])
    met = ends.withColumn("_block", F.explode(places)).join(closed, "_block").drop("_block")
    always = with_every_row(ends, timed.filter("until IS NULL"))
    asked = (F.col("event_time") >= F.col("since")) & (F.col("until").isNull() | (F.col("event_time") < F.col("until")))
    return with_distance(met.unionByName(always).filter(asked))


def nearest_taxi_expiring(rides: DataFrame, control: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Improving reports per query, for queries that expire and bests that are forgotten.

    A query is asked from its time until :func:`active_queries` ends it. A best report is forgotten
    when no better one came for eight hours; the next report then starts over.
    """
    found = improving_reports(active_reports(rides, active_queries(control, max_rows)), max_rows)
    return found.select("query_id", "taxi_id", "event_time", "distance")


_KEEP_MICROS = 8 * 3600 * 10**6  # REPORT_RETENTION
_NO_TIME = -(1 << 62)
_SUMMARY = (
    "query_id BIGINT, slice INT, low ARRAY<DOUBLE>, low_prev ARRAY<BIGINT>, low_t ARRAY<BIGINT>, low_d ARRAY<DOUBLE>, "
    "run_last ARRAY<BIGINT>, run_t ARRAY<BIGINT>, run_d ARRAY<DOUBLE>"
)


def _in_order(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """The reports of a range in order, their times and distances, and the next report that replaces each.

    A report is replaced by the first later one that is nearer or comes when it is forgotten; the length of the range
    stands for one beyond it.
    """
    pdf = pdf.sort_values(["t", "ride_id"], kind="stable")
    t, d = pdf["t"].to_numpy("i8"), np.nan_to_num(pdf["distance"].to_numpy("f8"), nan=np.inf)
    nearer, open_ = np.full(len(t), len(t)), []
    for i, here in enumerate(d.tolist()):
        while open_ and d[open_[-1]] > here:
            nearer[open_.pop()] = i
        open_.append(i)
    return pdf, t, d, np.minimum(nearer, np.searchsorted(t, t + _KEEP_MICROS, "right"))


def _summarised(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """What a range does to any best report that enters it: where it is first replaced, and what is best in the end."""
    _, t, d, after = _in_order(pdf)
    end = np.arange(len(t))
    for i in range(len(t) - 1, -1, -1):
        if after[i] < len(t):
            end[i] = end[after[i]]
    before = np.minimum.accumulate(np.concatenate([[np.inf], d[:-1]]))
    low = np.flatnonzero((d < before) | (np.arange(len(t)) == 0))
    last = np.flatnonzero(np.append(end[1:] != end[:-1], True))
    lists = [d[low], np.where(low > 0, t[low - 1], _NO_TIME), t[end[low]], d[end[low]], t[last], t[end[last]], d[end[last]]]
    return pd.DataFrame([[*key, *(v.tolist() for v in lists)]], columns=[c.split()[0] for c in _SUMMARY.split(", ")])


def _entered(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The best report with which each range of a query is entered, from the summaries of the ranges."""
    t, d, rows = _NO_TIME, np.inf, []
    for r in pdf.sort_values("slice").itertuples():
        rows.append((key[0], r.slice, t, d))
        forgotten = t if t == _NO_TIME else t + _KEEP_MICROS
        near = np.searchsorted(-np.asarray(r.low), -d, "right")
        run = np.searchsorted(np.asarray(r.run_last), forgotten, "right")
        if near < len(r.low) and r.low_prev[near] <= forgotten:
            t, d = r.low_t[near], r.low_d[near]
        elif run < len(r.run_last):
            t, d = r.run_t[run], r.run_d[run]
    return pd.DataFrame(rows, columns=["query_id", "slice", "in_t", "in_d"])


def _kept(pdf: pd.DataFrame) -> pd.DataFrame:
    """The reports of a range that are the best when they come."""
    pdf, t, d, after = _in_order(pdf)
    in_t, in_d = int(pdf["in_t"].iloc[0]), float(pdf["in_d"].iloc[0])
    forgotten = in_t if in_t == _NO_TIME else in_t + _KEEP_MICROS
    near = np.flatnonzero(d < in_d)
    i = min(near[0] if len(near) else len(t), np.searchsorted(t, forgotten, "right"))
    best = np.zeros(len(t), bool)
    while i < len(t):
        best[i] = True
        i = after[i]
    return pdf[best].drop(columns=["t", "in_t", "in_d", "slice"])


# Rows of a range that a task holds at a time.
RANGE_ROWS = 500_000


def improving_reports(reports: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Reports ``(query_id, event_time, ride_id, distance, ...)`` that were the best when they came.

    Reports are dealt into ranges of (query, time). A range is summed up as what it does to any best report that enters
    it, in short lists. The summaries of a query in order tell with which report each range is entered, and the ranges
    then mark their own reports. The number of jobs does not depend on how often reports are forgotten.
    """
    names = reports.columns
    ranged = slice_groups(reports, ["query_id"], ["event_time", "ride_id"], max_rows or RANGE_ROWS).df
    timed = ranged.withColumnRenamed("_slice", "slice").withColumn("t", F.unix_micros("event_time"))
    slim = timed.select("query_id", "slice", "t", "ride_id", "distance")
    summaries = slim.groupBy("query_id", "slice").applyInPandas(_summarised, _SUMMARY)
    entered = summaries.groupBy("query_id").applyInPandas(_entered, "query_id BIGINT, slice INT, in_t BIGINT, in_d DOUBLE")
    # One row per query and range; without the hint Spark may send the reports themselves.
    met = timed.join(F.broadcast(entered), ["query_id", "slice"]).select(*names, "slice", "t", "in_t", "in_d")
    return met.groupBy("query_id", "slice").applyInPandas(_kept, reports.schema)
