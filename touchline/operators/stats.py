"""Event and user counts over time windows."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

# Window length and slide of the two reports.
MINUTE = "1 minute"
FIVE_MINUTES = "5 minutes"

# Our choice: 2**12 registers, a standard error of 1.6 % of the users counted.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def _flat(stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    return stats.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        "event_count",
        "user_count",
    )


def _per_user(events: DataFrame, keys: Sequence[str], size: str, slide: str | None) -> DataFrame:
    window = F.window("event_timestamp", size, slide)
    return events.groupBy(window, *keys, "user_id").agg(F.count(F.lit(1)).alias("events"))


def _micros(duration: str) -> int:
    return pd.Timedelta(duration).value // 1000


def _panes_per_window(size: str, slide: str) -> int | None:
    """How many slides make a window, if they fill it exactly."""
    whole, rest = divmod(_micros(size), _micros(slide))
    return whole if rest == 0 else None


def _over_windows(panes: DataFrame, size: str, slide: str) -> DataFrame:
    """Each row of a pane that begins at ``pane`` once per window it is in.

    ``nth`` counts the panes from ``window_start`` on.
    """
    count = _panes_per_window(size, slide)
    nth = F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("nth")
    start = F.col("pane") - F.col("nth").cast("bigint") * F.lit(_micros(slide))
    return panes.select("*", nth).withColumn("window_start", F.timestamp_micros(start))


def _ends(windows: DataFrame, keys: Sequence[str], size: str, *columns: str) -> DataFrame:
    end = F.timestamp_micros(F.unix_micros("window_start") + F.lit(_micros(size)))
    return windows.select("window_start", end.alias("window_end"), *keys, *columns)


def _hops(events: DataFrame, keys: Sequence[str], size: str, slide: str) -> DataFrame:
    """Sliding windows put together from the counts of their panes.

    Events are counted once per user and pane of one slide.  A user is counted
    in a window at the first pane of the window that has the user: with the
    previous pane ``gap`` slides ago, that is in ``gap`` of the windows around.
    So users are summed per pane and gap, a few rows for each pane, and only
    these are repeated for the windows.
    """
    count = _panes_per_window(size, slide)
    start = F.unix_micros("window.start")
    panes = _per_user(events, keys, slide, None).withColumn("pane", start)
    before = F.lag("pane").over(Window.partitionBy(*keys, "user_id").orderBy("pane"))
    slides = F.least(F.expr(f"(pane - before) div {_micros(slide)}L"), F.lit(count))
    gap = F.coalesce(slides, F.lit(count)).cast("int")
    per_gap = (
        panes.withColumn("before", before)
        .groupBy("pane", *keys, gap.alias("gap"))
        .agg(F.sum("events").alias("events"), F.count("user_id").alias("users"))
    )
    total = (
        _over_windows(per_gap, size, slide)
        .groupBy("window_start", *keys)
        .agg(
            F.sum("events").alias("event_count"),
            F.sum(F.when(F.col("nth") < F.col("gap"), F.col("users")).otherwise(0)).alias("user_count"),
        )
    )
    return _ends(total, keys, size, "event_count", "user_count")


def window_stats(
    events: DataFrame,
    keys: Sequence[str] = ("event_type", "platform"),
    size: str = MINUTE,
    slide: str | None = None,
    panes: bool = True,
) -> DataFrame:
    """Events and distinct users per window and ``keys``; batch or stream.

    Counts go per user first and then over users: each step is a plain sum with
    map-side partials, so neither a hot window nor a hot user lands on one
    task, and no set of users is ever held.  On a stream, give the events a
    watermark and write in append mode.

    Windows that slide are put together from panes of one slide, so an event is
    not repeated for its windows.  On a stream an event is then late once its
    pane has closed.  ``panes=False`` counts per window from the start: every
    event is repeated, and one that is late for its earliest windows still
    counts in those that are open.
    """
    whole = slide is not None and panes and _panes_per_window(size, slide)
    if whole and not events.isStreaming:
        return _hops(events, keys, size, slide)
    users = _per_user(events, keys, slide if whole else size, None if whole else slide)
    if whole:
        window = F.window("window", size, slide)
        users = users.groupBy(window, *keys, "user_id").agg(F.sum("events").alias("events"))
    total = users.groupBy("window", *keys).agg(
        F.sum("events").alias("event_count"),
        F.count("user_id").alias("user_count"),
    )
    return _flat(total, keys)


def tumbling_stats(
    events: DataFrame, keys: Sequence[str] = ("event_type", "platform")
) -> DataFrame:
    """One-minute windows side by side."""
    return window_stats(events, keys, MINUTE)


def hopping_stats(
    events: DataFrame, keys: Sequence[str] = ("event_type", "platform")
) -> DataFrame:
    """Five-minute windows, a new one every minute."""
    return window_stats(events, keys, FIVE_MINUTES, MINUTE)


def approximate_window_stats(
    events: DataFrame,
    keys: Sequence[str] = ("event_type", "platform"),
    size: str = MINUTE,
    slide: str | None = None,
) -> DataFrame:
    """As :func:`window_stats`, with an estimated user count and one shuffle."""
    total = events.groupBy(F.window("event_timestamp", size, slide), *keys).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.approx_count_distinct("user_id").alias("user_count"),
    )
    return _flat(total, keys)


def sketched_panes(
    events: DataFrame,
    keys: Sequence[str] = ("event_type", "platform"),
    slide: str = MINUTE,
    bits: int = SKETCH_BITS,
) -> DataFrame:
    """Events and a sketch of the users per pane, to be stored and combined later.

    One aggregation with map-side partials.  A sketch has at most 2**bits
    registers, whatever the number of users.
    """
    panes = events.groupBy(F.window("event_timestamp", slide), *keys).agg(
        F.count(F.lit(1)).alias("event_count"), F.hll_sketch_agg("user_id", bits).alias("users")
    )
    return panes.select(F.unix_micros("window.start").alias("pane"), *keys, "event_count", "users")


def stats_from_sketches(
    panes: DataFrame,
    keys: Sequence[str] = ("event_type", "platform"),
    size: str = FIVE_MINUTES,
    slide: str = MINUTE,
) -> DataFrame:
    """Windows of any length of whole slides from stored panes, users estimated.

    Sketches unite without their events, so an hour or a day costs a union of
    the panes and no second look at the users.
    """
    if not _panes_per_window(size, slide):
        raise ValueError(f"{size} is not made of whole slides of {slide}")
    total = (
        _over_windows(panes, size, slide)
        .groupBy("window_start", *keys)
        .agg(F.sum("event_count").alias("event_count"), F.hll_union_agg("users").alias("users"))
        .withColumn("user_estimate", F.hll_sketch_estimate("users"))
    )
    return _ends(total, keys, size, "event_count", "user_estimate")
