"""Hour-partitioned event archives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from touchline import schemas
from touchline.operators.dedup import RANK, top_rows
from touchline.sinks.commits import (
    COMMIT,
    compact,
    read_commits,
    read_latest,
    write_commit,
)

PARTITIONS = ["dt", "hr"]


def _archive_schema(columns: Sequence[str]) -> T.StructType:
    known = {f.name: f.dataType for f in schemas.ATTRIBUTED_EVENTS.fields}
    known |= {"processed_time": T.TimestampType()}
    return T.StructType([T.StructField(c, known.get(c, T.StringType())) for c in columns])


EVENT_ARCHIVE = _archive_schema(schemas.EVENT_ARCHIVE)
ATTRIBUTED_ARCHIVE = _archive_schema(schemas.ATTRIBUTED_ARCHIVE)


def last_arrivals(rows: DataFrame) -> DataFrame:
    """The last arrival per archive key, for input that was not deduplicated.

    Offsets order records within a partition only, so copies in two partitions go by the
    time of the record where the source gives it, and by partition number where not.
    """
    latest = [F.col(c).desc() for c in (schemas.RECORD_TIME, *schemas.POSITION) if c in rows.columns]
    if not set(schemas.POSITION) & set(rows.columns):
        raise ValueError("arrival order needs the partition and offset columns")
    return top_rows(rows, schemas.ARCHIVE_KEY, latest).drop(RANK)


def upsert_archive(rows: DataFrame, path: str, commit: str) -> None:
    """Upsert rows that are unique by ``(event_id, dt, hr)``."""
    write_commit(rows, path, commit, PARTITIONS)


def read_archive(
    spark: SparkSession, *paths: str, schema: T.StructType = EVENT_ARCHIVE
) -> DataFrame:
    """The archive as its key defines it: one row per event, day and hour."""
    return read_latest(spark, paths, schema, schemas.ARCHIVE_KEY)


def read_compacted(
    spark: SparkSession, path: str, schema: T.StructType = EVENT_ARCHIVE
) -> DataFrame:
    """A compacted archive; it is unique by key, so nothing has to be merged."""
    return read_commits(spark, [path], schema).drop(COMMIT)


def compact_archive(
    spark: SparkSession, path: str, target: str, schema: T.StructType = EVENT_ARCHIVE
) -> None:
    compact(spark, [path], schema, schemas.ARCHIVE_KEY, target, PARTITIONS)


def dedup_archive(archive: DataFrame, keep: str = "first") -> DataFrame:
    """One row per event over all hours.

    The hour is part of the archive key, so a copy that was processed in
    another hour stays in the archive.  This keeps the earliest (or latest)
    event time, and of equal copies the one processed last.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    time = F.asc("event_time") if keep == "first" else F.desc("event_time")
    order = [time, F.desc("processed_time")]
    return top_rows(archive, schemas.EVENT_KEY, order).drop(RANK)


def append_archive(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A keyless append archive by Spark's file sink, which is exactly-once."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*PARTITIONS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
