"""Attribution of conversions to first- or last-touch channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from touchline.operators.dedup import dedup_events

# Fixed value: the event type that counts as a conversion.
CONVERSION = "conversion"

# Our choice: over how many partitions the conversions of one user are spread.
SALTS = 16


def _conversions(events: DataFrame, event_type: str) -> DataFrame:
    return events.where(F.col("event_type") == event_type)


def _attributed(channel: Column, campaign: Column, model: str) -> list[Column]:
    return [
        F.col("event_id").alias("conversion_id"),
        F.col("user_id"),
        F.col("event_type").alias("conversion_type"),
        F.col("event_time").alias("conversion_time"),
        channel.alias("attributed_channel"),
        campaign.alias("attributed_campaign"),
        F.lit(model).alias("attribution_model"),
    ]


def last_touch(events: DataFrame, event_type: str = CONVERSION) -> DataFrame:
    """Channel and campaign the conversion itself arrived with."""
    utm = F.col("utm_params")
    return _conversions(events, event_type).select(
        *_attributed(utm["utm_source"], utm["utm_campaign"], "last_touch")
    )


def first_touch_join(
    events: DataFrame, sessions: DataFrame, event_type: str = CONVERSION
) -> DataFrame:
    """Conversions joined to ``sessions`` on ``user_id``, without a time bound.

    ``sessions`` may be a stored table and ``events`` a stream.  It should hold
    one row per user: a conversion is repeated for every session it meets.  Use
    :func:`first_touch` when users have several sessions.
    """
    touches = sessions.select("user_id", "first_touch_channel", "first_touch_campaign")
    channel, campaign = F.col("first_touch_channel"), F.col("first_touch_campaign")
    return (
        _conversions(events, event_type)
        .join(touches, "user_id", "inner")
        .select(*_attributed(channel, campaign, "first_touch"))
    )


def first_session(sessions: DataFrame) -> DataFrame:
    """The earliest session of each user."""
    touch = F.struct("first_touch_channel", "first_touch_campaign")
    best = F.min_by(touch, F.struct("session_start", "session_id")).alias("touch")
    return sessions.groupBy("user_id").agg(best).select("user_id", "touch.*")


def unique_conversions(events: DataFrame, event_type: str = CONVERSION) -> DataFrame:
    """One row per conversion id: the earliest copy, as the event dedup keeps it."""
    return dedup_events(_conversions(events, event_type))


def first_touch(
    events: DataFrame,
    sessions: DataFrame,
    event_type: str = CONVERSION,
    salts: int = SALTS,
) -> DataFrame:
    """One row per conversion id: the channel of the user's earliest session.

    Conversions are spread over ``salts`` partitions per user, and the one touch
    of each user is repeated for every salt, so a user with a third of all
    conversions is no single task, whatever the size.
    """
    return _spread_join(unique_conversions(events, event_type), first_session(sessions), salts)


def _spread_join(conversions: DataFrame, touches: DataFrame, salts: int) -> DataFrame:
    """Conversions with the one touch of their user, which is repeated for every salt."""
    spread = F.pmod(F.xxhash64("event_id"), F.lit(salts)).alias("salt")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    salted = touches.select("*", every.alias("salt"))
    return conversions.select("*", spread).join(salted, ["user_id", "salt"]).select(
        *_attributed(F.col("first_touch_channel"), F.col("first_touch_campaign"), "first_touch")
    )


def stream_first_touch(
    events: DataFrame, touches: DataFrame, event_type: str = CONVERSION, salts: int = SALTS
) -> DataFrame:
    """Conversions of a stream joined to a stored table with one row per user.

    ``touches`` has the columns of :func:`first_session`.  No plan is changed at
    run time in a micro-batch, so a hot user's conversions are spread by salt
    here too.  Every copy of a conversion gives a row: write to a
    sink that overwrites by ``conversion_id``, or deduplicate when reading.
    """
    return _spread_join(_conversions(events, event_type), touches, salts)
