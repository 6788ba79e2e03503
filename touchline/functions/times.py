"""Time expressions: event time, processing time and hour partitions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the archive is partitioned by wall-clock hour at UTC+8.
PARTITION_OFFSET = "INTERVAL 8 HOURS"

# The seconds that a timestamp of four-digit years can hold.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def event_timestamp(seconds: Column | str = "event_time") -> Column:
    """Unix seconds as an instant; NULL outside the years 1 to 9999.

    One record with a time in another unit must not stop a stream.
    """
    number = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.when(number.between(FIRST_SECOND, LAST_SECOND), F.timestamp_seconds(number))


def processing_clock(clock: Column | None = None) -> Column:
    """The processing time cut to milliseconds.

    On a stream, ``current_timestamp`` is the start of the micro-batch and is
    kept in the offset log, so a replayed batch sees the same value.
    """
    return F.date_trunc("MILLISECOND", F.current_timestamp() if clock is None else clock)


def partition_date(clock: Column) -> Column:
    return F.date_format(clock + F.expr(PARTITION_OFFSET), "yyyy-MM-dd")


def partition_hour(clock: Column) -> Column:
    return F.date_format(clock + F.expr(PARTITION_OFFSET), "HH")
