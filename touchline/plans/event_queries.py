"""Queries over decoded events: decode, projections, dedup, archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline import schemas
from touchline.functions.maps import map_with_null_keys
from touchline.operators import dedup, enrich
from touchline.operators.clicks import with_click
from touchline.operators.decode import decode
from touchline.plans import adapter
from touchline.plans.catalog import FLAT_SQL, flat_columns, plain_time, query

_DECODED_SQL = """
SELECT event_id, event_type, user_id, anonymous_id,
       CASE WHEN pos % 13 = 6 THEN NULL ELSE utm_source END AS utm_source,
       CASE WHEN pos % 13 = 6 THEN NULL ELSE utm_campaign END AS utm_campaign,
       gclid, gclid_ms, fbclid, cents,
       CASE WHEN pos % 13 = 5 THEN NULL WHEN pos % 13 = 9 THEN event_time * 1000000
            ELSE event_time END AS event_time,
       server_time,
       CASE WHEN pos % 13 IN (5, 9) THEN NULL ELSE make_timestamp(event_time * 1000000) END
         AS event_timestamp,
       part AS topic_partition, pos AS topic_offset
FROM raw WHERE pos % 11 NOT IN (3, 4)
"""


@query(_DECODED_SQL)
def decode_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw topic with damaged records to typed columns and source position."""
    topic = adapter.damaged(adapter.as_topic(adapter.raw_events(spark, sf_dir)))
    events = enrich.with_event_timestamp(decode(topic, schemas.RAW_EVENTS))
    return events.select(
        *flat_columns(),
        plain_time("event_timestamp"),
        F.col("partition").alias("topic_partition"),
        F.col("offset").alias("topic_offset"),
    )


_ATTRIBUTION_SQL = """
       CASE WHEN n % 2 = 0 THEN 'google' ELSE 'facebook' END AS source,
       'g' || n AS click_id, event_time - 3600 AS click_time,
       CASE WHEN n % 2 = 0 THEN 'gclid' ELSE 'fbclid' END AS click_id_name,
       CAST(n % 3 = 0 AS INTEGER) AS is_attributed,
       'last_click' AS attribution_model, '7d' AS attribution_window
"""


@query(f"SELECT {FLAT_SQL}, {_ATTRIBUTION_SQL}, pos AS topic_offset FROM raw")
def decode_attributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributed topic to typed columns."""
    topic = adapter.as_topic(adapter.attributed_events(spark, sf_dir))
    events = decode(topic, schemas.ATTRIBUTED_EVENTS)
    fields = schemas.ATTRIBUTION_FIELDS.names
    return events.select(*flat_columns(), *fields, F.col("offset").alias("topic_offset"))


_EXPOSURE_SQL = """
SELECT CAST(id AS VARCHAR) AS event_id, '/p/' || n AS page_url, 'item' || n AS product_id,
       'store' || (n % 10) AS store_id, 'scm' || (n % 4) AS scm,
       CASE WHEN id % 2 = 0 THEN 'impression' ELSE 'impression_end' END AS visible,
       CAST(n AS BIGINT) * 100 AS visible_duration_ms, n / 100.0::DOUBLE AS visible_ratio,
       'v' || uid AS session_id, 'a' || (uid % 40) AS anonymous_id, props AS ext_json,
       base_time AS event_time, base_time + 2 AS report_time, base_time + 3 AS server_time{extra}
FROM base
"""
_EXPOSURE_HOURS_SQL = _EXPOSURE_SQL.format(
    extra=""",
       strftime(make_timestamp((base_time + 28800) * 1000000), '%Y-%m-%d') AS dt,
       strftime(make_timestamp((base_time + 28800) * 1000000), '%H') AS hr"""
)


@query(_EXPOSURE_SQL.format(extra=""))
def decode_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exposure topic to typed columns; the extension stays JSON text."""
    topic = adapter.as_topic(adapter.exposure_events(spark, sf_dir))
    return decode(topic, schemas.EXPOSURE_EVENTS).drop("partition", "offset")


@query("""
SELECT event_id,
       CASE WHEN n % 3 = 0 THEN NULL ELSE 's' || n END AS named,
       CASE WHEN n % 3 = 0 THEN 's' || n END AS unnamed, 'y' AS other,
       CASE WHEN n % 3 = 0 THEN '{"null":"s' || n || '","other":"y"}'
            ELSE '{"' || event_type || '":"s' || n || '","other":"y"}' END AS text
FROM raw
""")
def null_map_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps built with NULL keys, which are written as the literal key."""
    events = adapter.raw_events(spark, sf_dir)
    n = F.substring("page_context.url", 4, 9).cast("int")
    key = F.when(n % 3 != 0, F.col("event_type"))
    built = events.withColumn("keys", F.array(key, F.lit("other"))).withColumn(
        "map", map_with_null_keys("keys", F.array(F.concat(F.lit("s"), n), F.lit("y")))
    )
    return built.select(
        "event_id",
        F.col("map")[F.col("event_type")].alias("named"),
        F.col("map")["null"].alias("unnamed"),
        F.col("map")["other"].alias("other"),
        F.to_json("map").alias("text"),
    )


def _ranked_sql(
    columns: str, order: str, table: str = "raw", keys: str = "event_id", rank: int = 1
) -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, ROW_NUMBER() OVER "
        f"(PARTITION BY {keys} ORDER BY {order}) AS row_num FROM {table}) "
        f"WHERE row_num <= {rank}"
    )


_FIRST = "event_time ASC NULLS FIRST, part, pos"
_LAST = "event_time DESC NULLS LAST, part, pos"
_CLOCK = "TIMESTAMP '2024-02-01 17:30:00.123'"


@query(
    _ranked_sql(
        f"{FLAT_SQL}, {_CLOCK} AS processed_time, 'deduplicated' AS processing_status", _FIRST
    )
)
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earliest copy of each event as the processed-events sink gets it."""
    events = dedup.dedup_events(adapter.raw_events(spark, sf_dir))
    clock = F.lit("2024-02-01 17:30:00.123456").cast("timestamp")
    rows = enrich.to_processed_events(events, clock)
    return rows.select(*flat_columns(), plain_time("processed_time"), "processing_status")


@query(_ranked_sql(FLAT_SQL, _LAST))
def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest copy of each event."""
    events = dedup.dedup_events(adapter.raw_events(spark, sf_dir), keep="last")
    return events.select(*flat_columns())


@query(
    _ranked_sql(
        f"{FLAT_SQL}, {_CLOCK} AS processed_time, 'raw' AS processing_status, "
        "'2024-02-02' AS dt, '01' AS hr",
        _FIRST,
    )
)
def dedup_archive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earliest copy of each event as the archive gets it."""
    events = dedup.dedup_events(adapter.raw_events(spark, sf_dir))
    clock = F.lit("2024-02-01 17:30:00.123456").cast("timestamp")
    rows = enrich.to_event_archive(events, clock)
    return rows.select(
        *flat_columns(), plain_time("processed_time"), "processing_status", "dt", "hr"
    )


@query(
    _ranked_sql(
        f"{FLAT_SQL}, {_ATTRIBUTION_SQL}, 'attributed' AS processing_status, "
        "'2024-02-02' AS dt, '01' AS hr",
        _FIRST,
    )
)
def dedup_attributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earliest copy of each attributed event as its archive gets it."""
    events = dedup.dedup_events(adapter.attributed_events(spark, sf_dir))
    rows = enrich.to_attributed_archive(events, F.lit("2024-02-01 17:30:00").cast("timestamp"))
    fields = schemas.ATTRIBUTION_FIELDS.names
    return rows.select(*flat_columns(), *fields, "processing_status", "dt", "hr")


@query(_ranked_sql(f"{FLAT_SQL}, part AS topic_partition, pos AS topic_offset", "part, pos"))
def dedup_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First arrival of each event, by source position alone."""
    events = adapter.raw_events(spark, sf_dir)
    first = dedup.top_rows(events, ["event_id"], dedup.arrival_order(events))
    return first.select(
        *flat_columns(),
        F.col("partition").alias("topic_partition"),
        F.col("offset").alias("topic_offset"),
    )


@query(f"SELECT {FLAT_SQL} FROM raw WHERE fbclid IS NOT NULL")
def click_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that carry one named click id."""
    return with_click(adapter.raw_events(spark, sf_dir), "fbclid").select(*flat_columns())


_HOURS_SQL = """
       strftime(make_timestamp((event_time + 28800) * 1000000), '%Y-%m-%d') AS dt,
       strftime(make_timestamp((event_time + 28800) * 1000000), '%H') AS hr
"""


@query(f"""
SELECT dt, hr, processing_status, count(*) AS events FROM (
  SELECT {_HOURS_SQL}, 'raw' AS processing_status FROM raw)
GROUP BY ALL
""")
def enrich_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per archive hour when events are processed at their event time."""
    events = adapter.raw_events(spark, sf_dir)
    rows = enrich.to_event_archive(events, F.col("event_timestamp"))
    return rows.groupBy("dt", "hr", "processing_status").agg(F.count(F.lit(1)).alias("events"))


@query(f"""
SELECT {FLAT_SQL}, make_timestamp(event_time * 1000000) AS processed_time,
       'raw' AS processing_status, {_HOURS_SQL} FROM raw
""")
def raw_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every arrival as an archive row, without dedup."""
    events = adapter.raw_events(spark, sf_dir)
    rows = enrich.to_event_archive(events, F.col("event_timestamp"))
    return rows.select(
        *flat_columns(), plain_time("processed_time"), "processing_status", "dt", "hr"
    )


@query(_EXPOSURE_HOURS_SQL)
def exposure_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every exposure as an archive row."""
    events = adapter.exposure_events(spark, sf_dir)
    rows = enrich.to_exposure_archive(events, F.col("event_timestamp"))
    return rows.drop("processed_time")
