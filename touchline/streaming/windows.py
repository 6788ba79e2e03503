"""Window statistics on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from touchline.operators import enrich, sessions, stats

# Fixed value: how far out of order events may arrive before they are late.
WATERMARK = "5 seconds"


def with_watermark(events: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """``event_timestamp`` as event time, late after ``delay``."""
    return enrich.with_event_timestamp(events).withWatermark("event_timestamp", delay)


def stream_stats(
    events: DataFrame,
    keys: Sequence[str],
    size: str = stats.MINUTE,
    slide: str | None = None,
    panes: bool = True,
) -> DataFrame:
    """Final counts per window; write in append mode.

    Chained aggregations, per user and then over users, so the exact distinct
    count needs no set of users in state.  Sliding windows are put together from
    panes unless ``panes`` is false; see :func:`stats.window_stats` for what is
    late then.  Spark judges lateness by the watermark of the micro-batch before
    the last one.
    """
    return stats.window_stats(with_watermark(events), keys, size, slide, panes)


def stream_sessions(events: DataFrame, gap: int = sessions.SESSION_GAP) -> DataFrame:
    """Closed sessions with their first touch; write in append mode."""
    return sessions.stream_sessions(with_watermark(events), gap)
