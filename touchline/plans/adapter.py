"""The provided ``events`` table as the three topics.

The table has unique ids, no maps and no late rows, so copies and maps are
derived from its columns.  Every row is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline import schemas
from touchline.operators.enrich import with_event_timestamp

_RAW = [*schemas.RAW_EVENTS.names, *schemas.POSITION]
_ATTRIBUTED = [*schemas.ATTRIBUTED_EVENTS.names, *schemas.POSITION]

_BASE = [
    "event_id AS id",
    "user_id AS uid",
    "event_type",
    "CAST(get_json_object(props, '$.k') AS INT) AS n",
    "unix_seconds(CAST(ts AS TIMESTAMP)) AS base_time",
    "CAST(round(value * 100) AS BIGINT) AS cents",
    "props",
]

# Each row, a later copy of every 10th and an earlier copy of every 15th.
_COPY = """
    explode(filter(array(0, 1, 2), c ->
        c = 0 OR (c = 1 AND id % 10 = 0) OR (c = 2 AND id % 15 = 0))) AS copy
"""
_COPY_TIME = "base_time + CASE copy WHEN 1 THEN 30 WHEN 2 THEN -45 ELSE 0 END AS event_time"

_RAW_COLUMNS = [
    "CAST(id AS STRING) AS event_id",
    "CAST(uid AS STRING) AS user_id",
    "concat('a', uid % 40) AS anonymous_id",
    """map('utm_source', concat('s', n % 5),
           'utm_campaign', CASE WHEN n % 6 <> 0 THEN concat('c', n % 7) END) AS utm_params""",
    """map('gclid', CASE WHEN n % 4 = 0 THEN '' ELSE concat('g', n) END,
           'gclid_timestamp',
           CASE WHEN n % 20 = 7 THEN concat('x', n) ELSE CAST(event_time * 1000 AS STRING) END,
           'fbclid', CASE WHEN n % 3 <> 0 THEN concat('f', n) END,
           'fbclid_timestamp', CAST(event_time * 1000 AS STRING)) AS clid_params""",
    "map('url', concat('/p/', n)) AS page_context",
    "CAST(NULL AS MAP<STRING, STRING>) AS user_data",
    """map('cents', CAST(cents + copy * 100 AS STRING),
           'platform', concat('p', n % 3)) AS event_properties""",
    "CAST(NULL AS MAP<STRING, STRING>) AS tracking_cookies",
    "map('sdk_version', CAST(n % 2 AS STRING)) AS retrieval_source",
    "CAST(NULL AS MAP<STRING, STRING>) AS ext_props",
    "concat('d', uid) AS fingerprint",
    "event_time + 2 AS report_time",
    "event_time + 3 AS server_time",
    "CAST(NULL AS STRING) AS gtm_preview_code",
    "CAST(id % 3 AS INT) AS `partition`",
    "id * 3 + copy AS `offset`",
]

_ATTRIBUTION_COLUMNS = [
    "CASE WHEN n % 2 = 0 THEN 'google' ELSE 'facebook' END AS source",
    "concat('g', n) AS click_id",
    "event_time - 3600 AS click_time",
    "CASE WHEN n % 2 = 0 THEN 'gclid' ELSE 'fbclid' END AS click_id_name",
    "CAST(n % 3 = 0 AS INT) AS is_attributed",
    "'last_click' AS attribution_model",
    "'7d' AS attribution_window",
]

_EXPOSURE_COLUMNS = [
    "CAST(id AS STRING) AS event_id",
    "concat('/p/', n) AS page_url",
    "concat('item', n) AS product_id",
    "concat('store', n % 10) AS store_id",
    "concat('scm', n % 4) AS scm",
    "CASE WHEN id % 2 = 0 THEN 'impression' ELSE 'impression_end' END AS visible",
    "CAST(n AS BIGINT) * 100 AS visible_duration_ms",
    "n / 100 AS visible_ratio",
    "concat('v', uid) AS session_id",
    "concat('a', uid % 40) AS anonymous_id",
    "props AS ext_json",
    "base_time AS event_time",
    "base_time + 2 AS report_time",
    "base_time + 3 AS server_time",
    "CAST(id % 3 AS INT) AS `partition`",
    "id AS `offset`",
]


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(*_BASE)


def copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What raw events are made of: ids, numbers and times only, narrow enough to shuffle."""
    return _base(spark, sf_dir).selectExpr("*", _COPY).selectExpr("*", _COPY_TIME).drop("props", "base_time")


def raw_events_of(rows: DataFrame) -> DataFrame:
    """The raw events of rows of :func:`copies`."""
    return with_event_timestamp(rows.selectExpr("*", *_RAW_COLUMNS).select(*_RAW))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events_of(copies(spark, sf_dir))


def raw_events_by_copy(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The raw events in three parts: originals, later copies, earlier copies."""
    rows = copies(spark, sf_dir).selectExpr("*", *_RAW_COLUMNS)
    parts = [rows.where(F.col("copy") == copy) for copy in range(3)]
    return [with_event_timestamp(part.select(*_RAW)) for part in parts]


def unique_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events without copies."""
    return raw_events_by_copy(spark, sf_dir)[0]


def attributed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = copies(spark, sf_dir).selectExpr("*", *_RAW_COLUMNS, *_ATTRIBUTION_COLUMNS)
    return with_event_timestamp(rows.select(*_ATTRIBUTED))


def exposure_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_timestamp(_base(spark, sf_dir).selectExpr(*_EXPOSURE_COLUMNS))


def as_topic(events: DataFrame) -> DataFrame:
    """Rows as JSON topic records; NULL fields are left out."""
    derived = [*schemas.POSITION, "event_timestamp"]
    fields = [c for c in events.columns if c not in derived]
    return events.select(F.to_json(F.struct(*fields)).alias("value"), *schemas.POSITION)


def damaged(topic: DataFrame) -> DataFrame:
    """Records with the defects a decoder meets, chosen by offset.

    Broken and non-object records, a quoted, a fractional and an unusable
    number, a time in microseconds, a map that is text, an unknown field, and
    text after the object.
    """
    value, offset = F.col("value"), F.col("offset")
    time = r'"event_time":(\d+)'
    broken = (
        F.when(offset % 11 == 3, F.concat(F.lit("{bad"), value))
        .when(offset % 11 == 4, F.lit("[]"))
        .when(offset % 13 == 1, F.regexp_replace(value, time, '"event_time":"$1"'))
        .when(offset % 13 == 2, F.regexp_replace(value, time, '"event_time":$1.9'))
        .when(offset % 13 == 5, F.regexp_replace(value, time, '"event_time":"x"'))
        .when(offset % 13 == 6, F.regexp_replace(value, r'"utm_params":\{[^}]*\}', '"utm_params":"t"'))
        .when(offset % 13 == 7, F.regexp_replace(value, r"^\{", '{"unknown":[1],'))
        .when(offset % 13 == 8, F.concat(value, F.lit(" tail")))
        .when(offset % 13 == 9, F.regexp_replace(value, r'(?<="event_time":\d{10})', "000000"))
        .otherwise(value)
    )
    return topic.withColumn("value", broken)
