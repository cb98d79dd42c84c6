"""Join helpers that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound of the rows given to every executor as a hinted table.
BROADCAST_ROWS = 10_000
HOT_ROWS = 1_000_000


def rows_with_key_in(df: DataFrame, keys: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows of ``df`` whose ``on`` values are in ``keys(*on, n)``; one row per key, ``n`` = its rows in ``df``.

    The at most ``BROADCAST_ROWS`` largest keys above ``hot_rows`` are matched without moving their
    rows; all others meet in a shuffle.
    """
    named = [F.col(c).alias(f"_k_{c}") for c in on]
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in on]
    hot = keys.filter(F.col("n") > hot_rows).orderBy(F.desc("n"), *on).limit(BROADCAST_ROWS)
    hot = F.broadcast(hot.select(*named, F.lit(True).alias("_hot")))
    marked = df.join(hot, same, "left").drop(*[f"_k_{c}" for c in on])
    stay = marked.filter(F.col("_hot")).drop("_hot")
    move = marked.filter(F.col("_hot").isNull()).drop("_hot").join(keys.select(*named), same, "left_semi")
    return stay.select(*df.columns).unionByName(move.select(*df.columns))


def with_every_row(df: DataFrame, small: DataFrame, piece_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Each row of ``df`` next to each row of a control table, for controls that apply to everything.

    The control table is counted and sent to the executors in pieces of about ``piece_rows`` rows, one for all but long
    tables; ``df`` stays where it is and is read once for each piece.
    """
    pieces = max(1, -(-small.count() // piece_rows))
    if pieces == 1:
        return df.join(F.broadcast(small), F.lit(True))
    number = F.pmod(F.xxhash64(*small.columns), F.lit(pieces))
    out = None
    for k in range(pieces):
        met = df.join(F.broadcast(small.filter(number == k)), F.lit(True))
        out = met if out is None else out.unionByName(met)
    return out
