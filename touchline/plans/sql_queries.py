"""Reports that a user writes in Spark SQL over the operators' results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.operators.clicks import explode_clicks
from touchline.operators.decode import decode
from touchline.operators.dedup import dedup_events
from touchline.operators.enrich import with_event_timestamp
from touchline.plans import adapter
from touchline.plans.catalog import query
from touchline import schemas


# What each report reads; nothing else is parsed.
_DEDUP_FIELDS = ["event_id", "event_type", "user_id", "event_properties", "event_time"]
_CLICK_FIELDS = ["anonymous_id", "utm_params", "clid_params", "event_time"]


def _decoded(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    topic = adapter.as_topic(adapter.raw_events(spark, sf_dir))
    return with_event_timestamp(decode(topic, schemas.RAW_EVENTS, columns))


@query("""
, firsts AS (
  SELECT event_type, event_time // 3600 AS hour, user_id, cents,
         ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY event_time, part, pos) AS rn FROM raw
)
SELECT event_type, hour, count(*) AS events, count(DISTINCT user_id) AS users,
       CAST(sum(CAST(cents AS BIGINT)) AS BIGINT) AS cents
FROM firsts WHERE rn = 1 GROUP BY event_type, hour HAVING count(*) > 1
""")
def sql_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, users and revenue per hour, in SQL over deduplicated events."""
    dedup_events(_decoded(spark, sf_dir, _DEDUP_FIELDS)).createOrReplaceTempView("distinct_events")
    return spark.sql(
        """
        SELECT event_type, event_time DIV 3600 AS hour, count(*) AS events,
               count(DISTINCT user_id) AS users,
               sum(CAST(event_properties['cents'] AS BIGINT)) AS cents
        FROM IDENTIFIER(:events)
        GROUP BY event_type, hour
        HAVING count(*) > :least
        """,
        args={"events": "distinct_events", "least": 1},
    )


@query("""
SELECT k AS channel, utm_campaign AS campaign, count(*) AS clicks, count(DISTINCT v) AS click_ids,
       count(click_time) AS timed, max(click_time) AS newest
FROM entries GROUP BY k, utm_campaign
""")
def sql_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks per channel and campaign, in SQL over the unnested clicks."""
    entries = explode_clicks(_decoded(spark, sf_dir, _CLICK_FIELDS))
    campaign = F.col("utm_params")["utm_campaign"].alias("campaign")
    entries.select("k", "v", "click_time", campaign).createOrReplaceTempView("click_entries")
    return spark.sql(
        """
        SELECT k AS channel, campaign, count(*) AS clicks, count(DISTINCT v) AS click_ids,
               count(click_time) AS timed, max(click_time) AS newest
        FROM click_entries
        GROUP BY k, campaign
        """
    )
