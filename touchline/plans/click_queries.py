"""Queries over click ids."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.operators import clicks
from touchline.plans import adapter
from touchline.plans.catalog import query
from touchline.session import work_dir
from touchline.sinks import click_table as stored

_NOW = "2024-02-29 00:00:00"


def _now():
    return F.lit(_NOW).cast("timestamp")


@query("""
SELECT event_id, pos AS topic_offset, anonymous_id, user_id, event_time, k, v, click_time
FROM entries
""")
def click_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per click id in the map; timestamps and empty ids are no clicks."""
    rows = clicks.explode_clicks(adapter.raw_events(spark, sf_dir))
    return rows.select(
        "event_id",
        F.col("offset").alias("topic_offset"),
        "anonymous_id",
        "user_id",
        "event_time",
        "k",
        "v",
        "click_time",
    )


_LATEST_SQL = """
, latest AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (
      PARTITION BY anonymous_id, k, v
      ORDER BY click_time DESC NULLS LAST, event_time ASC NULLS FIRST, part, pos) AS row_num
    FROM entries)
  WHERE row_num <= 2
)
"""


@query(
    _LATEST_SQL
    + """SELECT event_id, anonymous_id, user_id, utm_source, event_time, k, v, click_time
FROM latest WHERE row_num = 1"""
)
def click_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest sighting of each click id per visitor."""
    rows = clicks.latest_clicks(adapter.raw_events(spark, sf_dir))
    return rows.select(
        "event_id",
        "anonymous_id",
        "user_id",
        F.col("utm_params")["utm_source"].alias("utm_source"),
        "event_time",
        "k",
        "v",
        "click_time",
    )


@query(
    _LATEST_SQL
    + """SELECT event_id, anonymous_id, k, v, click_time, CAST(row_num AS INTEGER) AS row_num,
       row_num = 1 AS is_new_click, CASE WHEN row_num = 1 THEN anonymous_id END AS stored_for
FROM latest"""
)
def click_rank_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winner and runner-up per click id, told apart."""
    rows = clicks.latest_clicks(adapter.raw_events(spark, sf_dir), max_rank=2)
    return rows.select(
        "event_id", "anonymous_id", "k", "v", "click_time", "row_num", "is_new_click", "stored_for"
    )


_INSTANCES_SQL = """
SELECT anonymous_id AS fingerprint, user_id, v AS click_id, k AS click_id_name, click_time,
       utm_source, utm_campaign
FROM (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY anonymous_id, user_id, v, ms
    ORDER BY event_time DESC NULLS LAST, part, pos) AS row_num
  FROM entries)
WHERE row_num = 1
"""


@query(_INSTANCES_SQL)
def click_dedup_instance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last event of each click instance."""
    rows = clicks.click_instances(adapter.raw_events(spark, sf_dir))
    utm = F.col("utm_json")
    return rows.select(
        "fingerprint",
        "user_id",
        "click_id",
        "click_id_name",
        "click_time",
        utm["utm_source"].alias("utm_source"),
        utm["utm_campaign"].alias("utm_campaign"),
    )


_ITEMS_SQL = f"""{_LATEST_SQL}, items AS (
  SELECT anonymous_id AS fingerprint, k AS click_id_name, click_time, user_id, v AS click_id,
         utm_source, utm_campaign,
         CAST(1 + (utm_campaign IS NOT NULL)::INTEGER AS INTEGER) AS utm_entries, event_id,
         CAST(epoch(TIMESTAMP '{_NOW}') * 1000 AS BIGINT) AS updated_at,
         click_time // 1000 + 2592000 AS expire_at
  FROM latest WHERE row_num = 1
)
"""
STORE_SQL = f"""{_ITEMS_SQL}, store AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (
      PARTITION BY fingerprint, click_id_name
      ORDER BY click_time DESC NULLS LAST, event_id DESC NULLS LAST, click_id DESC NULLS LAST,
               user_id DESC NULLS LAST
    ) AS rn FROM items)
  WHERE rn = 1
)
"""


def flat_items(items: DataFrame) -> DataFrame:
    utm = F.col("utm_json")
    return items.select(
        "fingerprint",
        "click_id_name",
        "click_time",
        "user_id",
        "click_id",
        utm["utm_source"].alias("utm_source"),
        utm["utm_campaign"].alias("utm_campaign"),
        F.size("utm_json").alias("utm_entries"),
        "event_id",
        "updated_at",
        "expire_at",
    )


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    winners = clicks.latest_clicks(adapter.raw_events(spark, sf_dir))
    return clicks.click_items(winners, _now())


@query(_ITEMS_SQL + "SELECT * FROM items")
def click_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored item of every winning click."""
    return flat_items(_items(spark, sf_dir))


@query(_ITEMS_SQL + "SELECT * FROM items WHERE click_time % 3 = 2")
def click_items_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items where a third of the winners have no visitor and a third no click-id name: these are not stored."""
    part = F.col("click_time") % 3
    winners = clicks.latest_clicks(adapter.raw_events(spark, sf_dir)).withColumns(
        {"anonymous_id": F.when(part != 0, F.col("anonymous_id")), "k": F.when(part != 1, F.col("k"))}
    )
    return flat_items(clicks.click_items(winners, _now()))


@query(STORE_SQL + "SELECT * FROM store")
def click_store_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One whole item per visitor and click-id name."""
    return flat_items(clicks.last_written(_items(spark, sf_dir)))


@query(
    STORE_SQL
    + f"""SELECT * FROM store
WHERE expire_at IS NULL OR expire_at > CAST(epoch(TIMESTAMP '{_NOW}') AS BIGINT)"""
)
def click_store_unexpired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored items still alive at a given time."""
    return flat_items(clicks.unexpired(clicks.last_written(_items(spark, sf_dir)), _now()))


@query(f"""
SELECT fingerprint, click_id_name, click_time, user_id, click_id FROM (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY fingerprint, click_id_name
    ORDER BY click_time DESC NULLS LAST, click_id DESC NULLS LAST, user_id DESC NULLS LAST) AS rn
  FROM ({_INSTANCES_SQL}))
WHERE rn = 1
""")
def click_store_instance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One whole item per key from click instances."""
    instances = clicks.click_instances(adapter.raw_events(spark, sf_dir))
    stored = clicks.last_written(clicks.instance_items(instances))
    return stored.select("fingerprint", "click_id_name", "click_time", "user_id", "click_id")


@query("""
SELECT anonymous_id AS fingerprint, 'gclid' AS click_id_name,
       TRY_CAST(gclid_ms AS BIGINT) AS click_time, user_id, nullif(gclid, '') AS click_id,
       utm_source, utm_campaign, CAST(1 + (utm_campaign IS NOT NULL)::INTEGER AS INTEGER)
         AS utm_entries,
       CAST(NULL AS VARCHAR) AS event_id,
       CAST(epoch(TIMESTAMP '2024-02-29 00:00:00') * 1000 AS BIGINT) AS updated_at,
       TRY_CAST(gclid_ms AS BIGINT) // 1000 + 2592000 AS expire_at
FROM raw WHERE gclid IS NOT NULL
""")
def click_items_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items for one click-id name, without event ids."""
    return flat_items(clicks.named_click_items(adapter.raw_events(spark, sf_dir), "gclid", _now()))


# A clock before any expiry, then one in the middle of it.
_EARLY, _LATE = "2024-01-20 00:00:00", "2024-02-20 12:00:00"


@query(f"""
, sightings AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY copy, anonymous_id, k, v
    ORDER BY click_time DESC NULLS LAST, event_time ASC NULLS FIRST, part, pos) AS row_num
  FROM entries
), items AS (
  SELECT anonymous_id AS fingerprint, k AS click_id_name, click_time, user_id, v AS click_id, event_id,
         click_time // 1000 + 2592000 AS expire_at
  FROM sightings WHERE row_num = 1
), newest AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY fingerprint, click_id_name
    ORDER BY click_time DESC NULLS LAST, event_id DESC, click_id DESC, user_id DESC) AS rn
  FROM items
)
SELECT fingerprint, click_id_name, click_time, user_id, click_id, event_id, expire_at,
       CAST(0 AS BIGINT) AS expired_days
FROM newest
WHERE rn = 1 AND (expire_at IS NULL OR expire_at > CAST(epoch(TIMESTAMP '{_LATE}') AS BIGINT))
""")
def click_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bucketed click table after three writes, the first of them before any expiry.

    ``expired_days`` counts the days in the table that end before the last write.
    """
    database = f"clicks_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{work_dir(spark, 'clicks')}'")
    table = f"{database}.items"
    clocks = [datetime.fromisoformat(f"{text}+00:00") for text in (_EARLY, _LATE, _LATE)]
    for events, now in zip(adapter.raw_events_by_copy(spark, sf_dir), clocks):
        items = clicks.click_items(clicks.latest_clicks(events), F.lit(now))
        stored.put_items(items, table, now)
    over = spark.table(table).where(F.col(stored.EXPIRY_DAY) < F.lit(_LATE[:10]))
    (days,) = over.agg(F.count_distinct(stored.EXPIRY_DAY)).first()
    alive = stored.read_items(spark, table, F.lit(clocks[-1]))
    fields = "fingerprint", "click_id_name", "click_time", "user_id", "click_id", "event_id", "expire_at"
    return alive.select(*fields, F.lit(days).cast("bigint").alias("expired_days"))
