"""Queries that attribute conversions and count events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.operators import attribution, health, sessions, stats
from touchline.plans import adapter
from touchline.plans.catalog import plain_time, query
from touchline.session import work_dir

# In the provided events a purchase is the conversion.
_CONVERSION = "purchase"

SESSIONS_SQL = """
, marked AS (
  SELECT *, CASE WHEN event_time - lag(event_time) OVER w < 1800 THEN 0 ELSE 1 END AS starts
  FROM raw WINDOW w AS (PARTITION BY user_id ORDER BY event_time, event_id, part, pos)
), numbered AS (
  SELECT *, sum(starts) OVER (
    PARTITION BY user_id ORDER BY event_time, event_id, part, pos
    ROWS UNBOUNDED PRECEDING) AS session FROM marked
), user_sessions AS (
  SELECT user_id, user_id || '-' || event_time AS session_id,
         utm_source AS first_touch_channel, utm_campaign AS first_touch_campaign,
         make_timestamp(event_time * 1000000) AS session_start
  FROM numbered WHERE starts = 1
)
"""


@query(SESSIONS_SQL + "SELECT * FROM user_sessions")
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user with their first touch."""
    rows = sessions.user_sessions(adapter.raw_events(spark, sf_dir))
    return rows.withColumn("session_start", plain_time("session_start"))


@query("""
SELECT event_id AS conversion_id, user_id, event_type AS conversion_type,
       event_time AS conversion_time, c_mktsegment AS attributed_channel,
       c_name AS attributed_campaign, 'first_touch' AS attribution_model
FROM raw JOIN customer ON user_id = CAST(c_custkey AS VARCHAR)
WHERE event_type = 'purchase'
""")
def first_touch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversions joined to a stored table with one row per user."""
    users = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_mktsegment").alias("first_touch_channel"),
        F.col("c_name").alias("first_touch_campaign"),
    )
    return attribution.first_touch_join(adapter.raw_events(spark, sf_dir), users, _CONVERSION)


@query(
    SESSIONS_SQL
    + """, conversions AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (
      PARTITION BY event_id ORDER BY event_time ASC NULLS FIRST, part, pos) AS rn
    FROM raw WHERE event_type = 'purchase') WHERE rn = 1
), first_session AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY session_start, session_id) AS rn
    FROM user_sessions) WHERE rn = 1
)
SELECT event_id AS conversion_id, r.user_id, event_type AS conversion_type,
       event_time AS conversion_time, first_touch_channel AS attributed_channel,
       first_touch_campaign AS attributed_campaign, 'first_touch' AS attribution_model
FROM conversions r JOIN first_session s ON r.user_id = s.user_id
"""
)
def first_touch_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversion with the user's earliest session."""
    events = adapter.raw_events(spark, sf_dir)
    return attribution.first_touch(events, sessions.user_sessions(events), _CONVERSION)


@query("""
SELECT event_id AS conversion_id, user_id, event_type AS conversion_type,
       event_time AS conversion_time, utm_source AS attributed_channel,
       utm_campaign AS attributed_campaign, 'last_touch' AS attribution_model
FROM raw WHERE event_type = 'purchase'
""")
def last_touch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversions with the channel they arrived with."""
    return attribution.last_touch(adapter.raw_events(spark, sf_dir), _CONVERSION)


def _with_platform(events: DataFrame) -> DataFrame:
    return events.withColumn("platform", F.col("event_properties")["platform"])


def _plain(rows: DataFrame) -> DataFrame:
    names = ("window_start", "window_end")
    return rows.withColumns({name: plain_time(name) for name in names})


@query("""
SELECT make_timestamp(event_time // 60 * 60000000) AS window_start,
       make_timestamp((event_time // 60 + 1) * 60000000) AS window_end,
       event_type, platform, count(*) AS event_count, count(DISTINCT user_id) AS user_count
FROM raw GROUP BY ALL
""")
def tumble_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and users per minute, event type and platform."""
    return _plain(stats.tumbling_stats(_with_platform(adapter.raw_events(spark, sf_dir))))


@query("""
SELECT make_timestamp((event_time // 60 - back) * 60000000) AS window_start,
       make_timestamp((event_time // 60 - back + 5) * 60000000) AS window_end,
       event_type, platform, count(*) AS event_count, count(DISTINCT user_id) AS user_count
FROM raw, (SELECT unnest([0, 1, 2, 3, 4]) AS back) GROUP BY ALL
""")
def hop_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and users per sliding five minutes, event type and platform."""
    return _plain(stats.hopping_stats(_with_platform(adapter.raw_events(spark, sf_dir))))


@query("""
SELECT make_timestamp((event_time // 60 - back) * 60000000) AS window_start,
       make_timestamp((event_time // 60 - back + 5) * 60000000) AS window_end,
       event_type, platform, count(*) AS event_count, count(DISTINCT user_id) AS user_count,
       TRUE AS estimate_within_bound
FROM raw, (SELECT unnest([0, 1, 2, 3, 4]) AS back) GROUP BY ALL
""")
def hop_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows from stored sketches, held against the exact count of users.

    An estimate may be off by five standard errors of its sketch.
    """
    events = _with_platform(adapter.raw_events(spark, sf_dir))
    path = work_dir(spark, "panes")
    stats.sketched_panes(events).write.parquet(path)
    rough = stats.stats_from_sketches(spark.read.parquet(path))
    exact = stats.hopping_stats(events)
    on = ["window_start", "window_end", "event_type", "platform"]
    same = [exact[name].eqNullSafe(rough[name]) for name in on]
    off = F.abs(rough["user_estimate"] - exact["user_count"])
    bound = 5 * stats.SKETCH_ERROR * exact["user_count"] + 0.5
    both = exact.join(rough, same)
    agree = both.where(exact["event_count"] == rough["event_count"])
    rows = agree.select(exact["*"], (off <= bound).alias("estimate_within_bound"))
    return _plain(rows)


@query("""
SELECT make_timestamp(event_time // 60 * 60000000) AS period_start,
       make_timestamp((event_time // 60 + 1) * 60000000) AS period_end,
       CAST(sum(n) AS DOUBLE) AS records_per_second_sum,
       CAST(avg(n) AS DOUBLE) AS records_per_second_avg,
       CAST(avg(n * 1000) AS DOUBLE) AS lag_ms_avg,
       CAST(max(n * 1000) AS BIGINT) AS lag_ms_max
FROM raw GROUP BY ALL
""")
def stream_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate and lag by minute, each event read as one progress record."""
    n = F.substring("page_context.url", 4, 9).cast("bigint")
    progress = adapter.raw_events(spark, sf_dir).select(
        F.col("event_timestamp").alias("timestamp"),
        n.cast("double").alias("records_per_second"),
        (n * 1000).alias("lag_ms"),
    )
    report = health.health_report(progress)
    return report.withColumns(
        {name: plain_time(name) for name in ("period_start", "period_end")}
    )
