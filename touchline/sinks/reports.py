"""Report tables that overwrite by key: window statistics and attributed conversions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline import schemas
from touchline.schemas import LONG, TEXT, TIME, struct
from touchline.sinks.commits import read_latest, write_commit

# Columns of the two tables.
EVENT_STATS = struct(
    window_start=TIME,
    window_end=TIME,
    event_type=TEXT,
    platform=TEXT,
    event_count=LONG,
    user_count=LONG,
)
ATTRIBUTED_CONVERSIONS = struct(
    conversion_id=TEXT,
    user_id=TEXT,
    conversion_type=TEXT,
    conversion_time=LONG,
    attributed_channel=TEXT,
    attributed_campaign=TEXT,
    attribution_model=TEXT,
)


def put_stats(stats: DataFrame, path: str, commit: str) -> None:
    """Write window statistics; a later commit replaces the row of its key."""
    write_commit(stats.select(*EVENT_STATS.names), path, commit)


def read_stats(spark: SparkSession, *paths: str) -> DataFrame:
    return read_latest(spark, paths, EVENT_STATS, schemas.STATS_KEY)


def put_conversions(conversions: DataFrame, path: str, commit: str) -> None:
    """Write conversions that are unique by id; a later commit replaces them."""
    write_commit(conversions.select(*ATTRIBUTED_CONVERSIONS.names), path, commit)


def read_conversions(spark: SparkSession, *paths: str) -> DataFrame:
    return read_latest(spark, paths, ATTRIBUTED_CONVERSIONS, schemas.CONVERSION_KEY)
