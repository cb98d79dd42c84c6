"""State that expires: the best report of a location is forgotten when it has not been replaced for a time."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

KEEP = timedelta(hours=8)
IMPROVED = "query_id BIGINT, taxi_id BIGINT, distance DOUBLE"


class BestReport(StatefulProcessor):
    """Puts out reports that beat the best known one. Spark drops that one by itself when its time to live is over."""

    def __init__(self, keep: timedelta):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", "distance DOUBLE", int(self.keep.total_seconds() * 1000))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = self.best.get()[0] if self.best.exists() else None
        for row in rows:
            if best is None or row["distance"] < best:
                best = row["distance"]
                self.best.update((best,))
                yield Row(query_id=key[0], taxi_id=row["taxi_id"], distance=best)

    def close(self) -> None:
        pass


def improvements(reports: DataFrame, keep: timedelta = KEEP) -> DataFrame:
    """Reports ``(query_id, taxi_id, distance)`` of a stream that are nearer than the best of the last ``keep`` of clock time.

    Run it with a trigger that ends by itself only under :func:`rillstone.streaming.runner.data_batches_only`. A null distance never is. Reports of a micro-batch come in any order; put the nearest of each batch in to hear only that.
    """
    asked = reports.filter("distance IS NOT NULL").select("query_id", "taxi_id", reports["distance"].cast("double").alias("distance"))
    return asked.groupBy("query_id").transformWithState(
        statefulProcessor=BestReport(keep), outputStructType=IMPROVED, outputMode="Append", timeMode="ProcessingTime"
    )
