"""Progress of running queries as a table for health reports."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from touchline.schemas import DOUBLE, LONG, TEXT, TIME, struct

_METRIC = "arrivals"

PROGRESS = struct(
    query=TEXT,
    batch_id=LONG,
    timestamp=TIME,
    records=LONG,
    records_per_second=DOUBLE,
    lag_ms=LONG,
    watermark=TIME,
    late_groups=LONG,
)


def observed(events: DataFrame) -> DataFrame:
    """Let progress reports carry the newest event time of each micro-batch."""
    return events.observe(_METRIC, F.max("event_time").alias("newest"))


def _instant(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text).astimezone(timezone.utc)


def progress_row(progress) -> tuple:
    """One ``PROGRESS`` row; the lag is NULL where no event time was observed.

    ``late_groups`` is what the watermark kept out of state.  Spark counts it
    behind the partial aggregation: events of one window, key and user that
    arrive late in one micro-batch are one.
    """
    stamp = _instant(progress.timestamp)
    metric = progress.observedMetrics.get(_METRIC)
    newest = None if metric is None else metric["newest"]
    lag = None if newest is None else round((stamp.timestamp() - newest) * 1000)
    return (
        progress.name or str(progress.id),
        progress.batchId,
        stamp,
        progress.numInputRows,
        float(progress.inputRowsPerSecond),
        lag,
        _instant(progress.eventTime.get("watermark")),
        sum(op.numRowsDroppedByWatermark for op in progress.stateOperators),
    )


class ProgressListener(StreamingQueryListener):
    """Appends progress to a Parquet folder, ``rows_per_file`` micro-batches at a time.

    What is left is written when a query ends, or by :meth:`flush`.
    """

    def __init__(self, spark: SparkSession, path: str, rows_per_file: int = 60):
        self._spark = spark
        self._path = path
        self._limit = rows_per_file
        self._rows: list[tuple] = []

    def flush(self) -> None:
        if self._rows:
            rows, self._rows = self._rows, []
            table = self._spark.createDataFrame(rows, PROGRESS).coalesce(1)
            table.write.mode("append").parquet(self._path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._rows.append(progress_row(event.progress))
        if len(self._rows) >= self._limit:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()


@contextmanager
def recorded(spark: SparkSession, path: str) -> Iterator[None]:
    """Record the progress of all queries that run meanwhile to ``path``."""
    listener = ProgressListener(spark, path)
    spark.streams.addListener(listener)
    try:
        yield
    finally:
        # Reports come after the fact; none is lost when the listener leaves.
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(listener)
        listener.flush()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS).parquet(path)
