"""User sessions and their first touch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from touchline import schemas

# Our choice: a pause of 30 minutes or more starts a new session.
SESSION_GAP = 30 * 60


def user_sessions(events: DataFrame, gap: int = SESSION_GAP) -> DataFrame:
    """One row per session with the channel and campaign of its first event.

    Two events in the same ``gap``-long slot are always in one session, so
    events are first reduced to one row per user and slot, before the shuffle.
    What is then ordered per user is bounded by the slots in the time range,
    however many events a user has.
    """
    time = F.col("event_time")
    utm = F.col("utm_params")
    tie = [c for c in ("event_id", *schemas.POSITION) if c in events.columns]
    touch = F.struct(
        utm["utm_source"].alias("first_touch_channel"),
        utm["utm_campaign"].alias("first_touch_campaign"),
    )
    slots = (
        events.where(F.col("user_id").isNotNull() & time.isNotNull())
        .select(
            "user_id",
            F.floor(time / F.lit(gap)).alias("slot"),
            time,
            touch.alias("touch"),
            F.struct(time, *tie).alias("position"),
        )
        .groupBy("user_id", "slot")
        .agg(
            F.min("event_time").alias("first_time"),
            F.max("event_time").alias("last_time"),
            F.min_by("touch", "position").alias("touch"),
        )
    )
    by_user = Window.partitionBy("user_id").orderBy("slot")
    up_to_here = by_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pause = F.col("first_time") - F.lag("last_time").over(by_user)
    starts = slots.withColumn("starts", F.when(pause < gap, 0).otherwise(1))
    numbered = starts.withColumn("session", F.sum("starts").over(up_to_here))
    return (
        numbered.groupBy("user_id", "session")
        .agg(
            F.min("first_time").alias("session_start"),
            F.min_by("touch", "slot").alias("touch"),
        )
        .select(
            "user_id",
            F.concat_ws("-", "user_id", "session_start").alias("session_id"),
            "touch.first_touch_channel",
            "touch.first_touch_campaign",
            F.timestamp_seconds("session_start").alias("session_start"),
        )
    )


def stream_sessions(events: DataFrame, gap: int = SESSION_GAP) -> DataFrame:
    """The sessions of a stream, each once the watermark has closed it.

    ``events`` need a watermark on ``event_timestamp`` and are written in append
    mode.  State holds one row per open session: its bounds and its first touch.
    A session closes once the watermark is ``gap`` after its last event; what
    comes later for it is late and does not count.  The rows are those of
    :func:`user_sessions`.

    Session windows of Spark also join events exactly ``gap`` apart.  Event times
    are whole seconds, so half a second less parts those and no others.
    """
    time, utm = F.col("event_time"), F.col("utm_params")
    tie = [c for c in ("event_id", *schemas.POSITION) if c in events.columns]
    # All that state holds of a session is its least value of this: narrow, and no map is sorted or shuffled.
    first = F.struct(
        time,
        *tie,
        utm["utm_source"].alias("first_touch_channel"),
        utm["utm_campaign"].alias("first_touch_campaign"),
    )
    session = F.session_window("event_timestamp", f"{gap * 1000 - 500} milliseconds")
    return (
        events.where(F.col("user_id").isNotNull() & time.isNotNull())
        .select("user_id", "event_timestamp", first.alias("first"))
        .groupBy(session, "user_id")
        .agg(F.min("first").alias("first"))
        .select(
            "user_id",
            F.concat_ws("-", "user_id", "first.event_time").alias("session_id"),
            "first.first_touch_channel",
            "first.first_touch_campaign",
            F.timestamp_seconds("first.event_time").alias("session_start"),
        )
    )
