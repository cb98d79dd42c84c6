"""Event-stream operators on bounded tables, by event time.

Orderings are total, so results do not depend on the physical order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions import geo
from rillstone.operators.ordered import running, slice_groups
from rillstone.schemas import RIDE_COLUMNS


def with_event_time(rides: DataFrame) -> DataFrame:
    """Start time of START events, end time of END events."""
    return rides.withColumn("event_time", event_time())


def event_time() -> Column:
    return F.when(F.col("is_start"), F.col("start_time")).otherwise(F.col("end_time"))


def in_box_both_ends() -> Column:
    return geo.in_nyc(F.col("start_lon"), F.col("start_lat")) & geo.in_nyc(F.col("end_lon"), F.col("end_lat"))


def relevant_cell() -> Column:
    """Departure cell of START events, arrival cell of END events."""
    return F.when(F.col("is_start"), geo.cell_id(F.col("start_lon"), F.col("start_lat"))).otherwise(
        geo.cell_id(F.col("end_lon"), F.col("end_lat"))
    )


def latest_per_key(rides: DataFrame, key: str = "taxi_id") -> DataFrame:
    """The newest event per key. At one time an END counts as newer than a START."""
    newest = F.max_by(F.struct(*RIDE_COLUMNS), F.struct(event_time(), ~F.col("is_start"), F.col("ride_id")))
    return rides.groupBy(key).agg(newest.alias("_r")).select("_r.*")


def mark_late(
    df: DataFrame, ts: str, arrival: list[str], delay: str, max_rows: int | None = None, newest: Column | None = None
) -> DataFrame:
    """Add ``is_late``: at or before the newest earlier arrival minus ``delay``, over the whole stream.

    ``newest`` is the newest time of what came before these rows, if anything did.
    """
    seen = running(slice_groups(df, [], arrival, max_rows), {"_newest": ("max", F.col(ts))}, inclusive=False)
    before = F.col("_newest") if newest is None else F.greatest("_newest", newest)
    late = F.col(ts) <= before - F.expr(f"INTERVAL {delay}")
    return seen.rows().withColumn("is_late", F.coalesce(late, F.lit(False))).drop("_newest")


def positions(df: DataFrame, keys: list[str], order: list[str], max_rows: int | None = None) -> DataFrame:
    """Add ``pos``, the 1-based place of a row in the order of its group."""
    return running(slice_groups(df, keys, order, max_rows), {"pos": ("count", F.lit(1))}).rows()


def segment_label(stddev: Column) -> Column:
    """Calm, busy or crazy, in steps of 2.5. Rounded first, so the order of additions cannot change it."""
    level = F.round(stddev / 2.5, 9).cast("int")
    return F.when(level == 0, "calm").when(level == 1, "busy").otherwise("crazy")


def segment_summary(df: DataFrame, keys: list[str], counted: Column | None = None) -> list[Column]:
    """Start, length, top speed, spread of the throttle; ``counted`` picks the rows that matter."""
    pick = (lambda c: c) if counted is None else (lambda c: F.when(counted, c))
    return [
        F.min(pick(F.col("ts"))).alias("start_time"),
        F.count(pick(F.lit(1))).alias("length"),
        F.max(pick(F.col("speed"))).cast("int").alias("max_speed"),
        F.stddev_pop(pick(F.col("throttle"))).alias("erraticness"),
    ]


def sessions(df: DataFrame, gap: str, max_rows: int | None = None) -> DataFrame:
    """Per car, runs of events no more than ``gap`` apart, summarised."""
    s = slice_groups(df, ["car_id"], ["ts", "event_id"], max_rows)
    s = running(s, {"_before": ("max", F.col("ts"))}, inclusive=False)
    opens = F.col("_before").isNull() | (F.col("ts") > F.col("_before") + F.expr(f"INTERVAL {gap}"))
    s = running(s, {"_session": ("max", F.when(opens, F.col("ts")))})
    grouped = s.rows().groupBy("car_id", "_session").agg(*segment_summary(df, ["car_id"]))
    return grouped.drop("_session").withColumn("label", segment_label(F.col("erraticness")))


def driving_segments(df: DataFrame, strict: bool = False, max_rows: int | None = None) -> DataFrame:
    """Runs of moving events that a stop ends; ``strict`` wants a stop in front as well.

    A stop belongs to the run it ends. Moving events at the time of a stop are left out.
    """
    stop = F.col("speed") == 0.0
    marked = df.withColumn("_moving", ~stop)
    s = slice_groups(marked, ["car_id"], ["ts", "_moving", "event_id"], max_rows)
    is_stop = ~F.col("_moving")
    s = running(
        s,
        {"_run": ("count", F.when(is_stop, 1)), "_stopped": ("max", F.when(is_stop, F.col("ts")))},
        inclusive=False,
    )
    inside = F.col("_moving") & (F.col("_stopped").isNull() | (F.col("ts") > F.col("_stopped")))
    grouped = s.rows().groupBy("car_id", "_run").agg(
        *segment_summary(df, ["car_id"], inside), F.max(is_stop).alias("_closed")
    )
    kept = grouped.filter(F.col("_closed") & (F.col("length") > 0))
    if strict:
        kept = kept.filter(F.col("_run") >= 1)
    return kept.drop("_run", "_closed").withColumn("label", segment_label(F.col("erraticness")))


def by_shape(rules: DataFrame) -> DataFrame:
    """Rules keyed by each shape that they name."""
    return rules.withColumn("shape", F.explode(F.array_distinct(F.array("first_shape", "second_shape"))))


def rule_pairs(items: DataFrame, rules: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Each item of a rule's first shape with the next item of its second shape in the same colour."""
    picked = items.join(by_shape(rules), "shape")
    s = slice_groups(picked, ["rule", "color"], ["seq"], max_rows)
    closing = F.when(F.col("shape") == F.col("second_shape"), F.col("seq"))
    s = running(s, {"second_seq": ("last", closing)}, inclusive=False, reverse=True)
    pairs = s.rows().filter((F.col("shape") == F.col("first_shape")) & F.col("second_seq").isNotNull())
    return pairs.select("rule", "color", F.col("seq").alias("first_seq"), "second_seq")


def asof_customers(trades: DataFrame, customers: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Each trade with the newest customer record at or before it, null when there is none."""
    both = trades.select(
        "customer_id", "ts", F.lit(True).alias("_trade"), F.col("trade_id").alias("_id"), "trade_id",
        F.col("info").alias("trade_info"), F.lit(None).cast("timestamp").alias("customer_ts"),
        F.lit(None).cast("string").alias("customer_info"),
    ).unionByName(
        customers.select(
            "customer_id", "ts", F.lit(False).alias("_trade"), F.col("change_id").alias("_id"),
            F.lit(None).cast("bigint").alias("trade_id"), F.lit(None).cast("string").alias("trade_info"),
            F.col("ts").alias("customer_ts"), F.col("info").alias("customer_info"),
        )
    )
    s = slice_groups(both, ["customer_id"], ["ts", "_trade", "_id"], max_rows)
    record = F.when(~F.col("_trade"), F.struct("customer_ts", "customer_info"))
    s = running(s, {"_customer": ("last", record)})
    return s.rows().filter("_trade").select(
        "trade_id", "customer_id", "ts", "trade_info",
        F.col("_customer.customer_ts").alias("customer_ts"), F.col("_customer.customer_info").alias("customer_info"),
    )
