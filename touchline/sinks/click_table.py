"""The stored clicks as a catalog table: bucketed by key, partitioned by the day of expiry.

A write appends whole items and drops the days that are over, which removes their files without
reading them.  The newest click of a key is found when reading: all items of a key are in one
bucket, so that needs no shuffle.  A repeated write only adds equal items, which are one when read.

Keep the table in a database whose location all executors share.  :func:`compact` folds the small
files of many writes.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline import schemas
from touchline.operators.clicks import last_written, unexpired

# Our choice; fixed once a table exists.
BUCKETS = 64

EXPIRY_DAY = "expire_day"
_NEVER = "never"


def _day(seconds: Column) -> Column:
    """Items without a click time never expire."""
    return F.coalesce(F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd"), F.lit(_NEVER))


def _append(items: DataFrame, table: str, buckets: int) -> None:
    dated = items.withColumn(EXPIRY_DAY, _day(F.col("expire_at")))
    # Dealt as the buckets are, so a task writes one file of one bucket for each day.
    writer = dated.repartition(buckets, *schemas.CLICK_KEY).write.format("parquet").mode("append")
    writer.partitionBy(EXPIRY_DAY).bucketBy(buckets, *schemas.CLICK_KEY).sortBy(
        *schemas.CLICK_KEY
    ).saveAsTable(table)


def purge(spark: SparkSession, table: str, now: datetime) -> None:
    """Drop the days before that of ``now``; all their items have expired."""
    if not spark.catalog.tableExists(table):
        return
    today = now.astimezone(timezone.utc).strftime("%Y-%m-%d")
    names = spark.sql(f"SHOW PARTITIONS {table}").collect()  # one row per day
    for day in (name[0].split("=", 1)[1] for name in names):
        if day != _NEVER and day < today:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({EXPIRY_DAY} = '{day}')")


def put_items(items: DataFrame, table: str, now: datetime, buckets: int = BUCKETS) -> None:
    """Write whole items that are alive at ``now`` and purge what is not."""
    _append(unexpired(last_written(items), F.lit(now)), table, buckets)
    purge(items.sparkSession, table, now)


def read_items(spark: SparkSession, table: str, now: Column | None = None) -> DataFrame:
    """The newest item of each key, if it is alive at ``now``; no shuffle."""
    return unexpired(last_written(spark.table(table)), now)


def compact(spark: SparkSession, table: str, now: datetime, buckets: int = BUCKETS) -> None:
    """Rewrite the table with the living items alone, one file per bucket and day.

    No writer may run meanwhile.  The items are copied aside first, and a table is
    known to the catalog only once it is whole, so what fails can be repeated.
    """
    aside = f"{table}_aside"
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
        _append(read_items(spark, table, F.lit(now)), aside, buckets)
        spark.sql(f"DROP TABLE {table}")
    _append(spark.table(aside).select(*schemas.CLICK_ITEMS), table, buckets)
    spark.sql(f"DROP TABLE {aside}")
