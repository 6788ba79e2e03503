"""Computed columns and the projections the sinks expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from touchline import schemas
from touchline.functions import times

# processing_status by sink.
DEDUPLICATED = "deduplicated"
RAW = "raw"
ATTRIBUTED = "attributed"


def with_event_timestamp(events: DataFrame) -> DataFrame:
    return events.withColumn("event_timestamp", times.event_timestamp("event_time"))


def with_processed_time(events: DataFrame, clock: Column | None = None) -> DataFrame:
    return events.withColumn("processed_time", times.processing_clock(clock))


def with_hour_partition(events: DataFrame) -> DataFrame:
    """``dt`` and ``hr`` of the processing time."""
    clock = F.col("processed_time")
    return events.withColumns(
        {"dt": times.partition_date(clock), "hr": times.partition_hour(clock)}
    )


def _processed(events: DataFrame, clock: Column | None) -> DataFrame:
    if clock is None and "processed_time" in events.columns:
        return events
    return with_processed_time(events, clock)


def to_processed_events(events: DataFrame, clock: Column | None = None) -> DataFrame:
    rows = _processed(events, clock).withColumn("processing_status", F.lit(DEDUPLICATED))
    return rows.select(*schemas.PROCESSED_EVENTS)


def to_event_archive(events: DataFrame, clock: Column | None = None) -> DataFrame:
    """Archive rows; on raw input this is the pass-through archive."""
    rows = _processed(events, clock).withColumn("processing_status", F.lit(RAW))
    return with_hour_partition(rows).select(*schemas.EVENT_ARCHIVE)


def to_attributed_archive(events: DataFrame, clock: Column | None = None) -> DataFrame:
    rows = _processed(events, clock).withColumn("processing_status", F.lit(ATTRIBUTED))
    return with_hour_partition(rows).select(*schemas.ATTRIBUTED_ARCHIVE)


def to_exposure_archive(events: DataFrame, clock: Column | None = None) -> DataFrame:
    return with_hour_partition(_processed(events, clock)).select(*schemas.EXPOSURE_ARCHIVE)
