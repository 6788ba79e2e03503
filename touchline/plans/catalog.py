"""Registry of runnable queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The adapter's rules in SQL, with map entries as plain columns.
EVENTS_SQL = """
WITH base AS (
  SELECT event_id AS id, user_id AS uid, event_type, props,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS n,
         CAST(floor(epoch(ts)) AS BIGINT) AS base_time,
         CAST(round(value * 100) AS BIGINT) AS cents0
  FROM events
),
copies AS (
  SELECT *, 0 AS copy, base_time AS event_time FROM base
  UNION ALL SELECT *, 1, base_time + 30 FROM base WHERE id % 10 = 0
  UNION ALL SELECT *, 2, base_time - 45 FROM base WHERE id % 15 = 0
),
raw AS (
  SELECT CAST(id AS VARCHAR) AS event_id, event_type, id, n, copy, base_time, event_time, props,
         CAST(uid AS VARCHAR) AS user_id, 'a' || (uid % 40) AS anonymous_id,
         's' || (n % 5) AS utm_source,
         CASE WHEN n % 6 <> 0 THEN 'c' || (n % 7) END AS utm_campaign,
         CASE WHEN n % 4 = 0 THEN '' ELSE 'g' || n END AS gclid,
         CASE WHEN n % 20 = 7 THEN 'x' || n ELSE CAST(event_time * 1000 AS VARCHAR) END AS gclid_ms,
         CASE WHEN n % 3 <> 0 THEN 'f' || n END AS fbclid,
         CAST(event_time * 1000 AS VARCHAR) AS fbclid_ms,
         CAST(cents0 + copy * 100 AS VARCHAR) AS cents,
         'p' || (n % 3) AS platform,
         event_time + 3 AS server_time,
         CAST(id % 3 AS INTEGER) AS part, id * 3 + copy AS pos
  FROM copies
),
clicks AS (
  SELECT *, 'gclid' AS k, gclid AS v, gclid_ms AS ms FROM raw
  UNION ALL SELECT *, 'fbclid', fbclid, fbclid_ms FROM raw
),
entries AS (
  SELECT *, TRY_CAST(ms AS BIGINT) AS click_time FROM clicks WHERE v IS NOT NULL AND v <> ''
)
"""

FLAT_SQL = (
    "event_id, event_type, user_id, anonymous_id, utm_source, utm_campaign, "
    "gclid, gclid_ms, fbclid, cents, event_time, server_time"
)


def flat_columns() -> list[str | Column]:
    """The events as scalars: ids, times and looked-up map entries."""
    utm, clid = F.col("utm_params"), F.col("clid_params")
    return [
        "event_id",
        "event_type",
        "user_id",
        "anonymous_id",
        utm["utm_source"].alias("utm_source"),
        utm["utm_campaign"].alias("utm_campaign"),
        clid["gclid"].alias("gclid"),
        clid["gclid_timestamp"].alias("gclid_ms"),
        clid["fbclid"].alias("fbclid"),
        F.col("event_properties")["cents"].alias("cents"),
        "event_time",
        "server_time",
    ]


def plain_time(name: str) -> Column:
    """An instant as a UTC timestamp without zone, as the SQL returns it."""
    return F.col(name).cast("timestamp_ntz").alias(name)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; ``sql`` may use the CTEs above."""

    def register(run: Query) -> Query:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        QUERIES[run.__name__] = configured
        if sql is not None:
            ORACLES[run.__name__] = EVENTS_SQL + sql
        return run

    return register
