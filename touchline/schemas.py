"""Explicit schemas of the streams and tables.

Names and types are the public contract of the data, so they are written out
rather than inferred; all fields are nullable.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
TEXT_MAP = T.MapType(TEXT, TEXT)
LONG = T.LongType()
INT = T.IntegerType()
DOUBLE = T.DoubleType()
TIME = T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    """A struct of nullable fields."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Column names and types of the three JSON topics.
RAW_EVENTS = struct(
    event_id=TEXT,
    event_type=TEXT,
    user_id=TEXT,
    anonymous_id=TEXT,
    utm_params=TEXT_MAP,
    clid_params=TEXT_MAP,
    page_context=TEXT_MAP,
    user_data=TEXT_MAP,
    event_properties=TEXT_MAP,
    tracking_cookies=TEXT_MAP,
    retrieval_source=TEXT_MAP,
    ext_props=TEXT_MAP,
    fingerprint=TEXT,
    event_time=LONG,
    report_time=LONG,
    server_time=LONG,
    gtm_preview_code=TEXT,
)

ATTRIBUTION_FIELDS = struct(
    source=TEXT,
    click_id=TEXT,
    click_time=LONG,
    click_id_name=TEXT,
    is_attributed=INT,
    attribution_model=TEXT,
    attribution_window=TEXT,
)

ATTRIBUTED_EVENTS = T.StructType(RAW_EVENTS.fields + ATTRIBUTION_FIELDS.fields)

EXPOSURE_EVENTS = struct(
    event_id=TEXT,
    page_url=TEXT,
    product_id=TEXT,
    store_id=TEXT,
    scm=TEXT,
    visible=TEXT,
    visible_duration_ms=LONG,
    visible_ratio=DOUBLE,
    session_id=TEXT,
    anonymous_id=TEXT,
    ext_json=TEXT,
    event_time=LONG,
    report_time=LONG,
    server_time=LONG,
)

# What a Kafka scan yields, and what a file export of a topic must look like.
TOPIC_RECORDS = struct(
    value=TEXT,
    partition=INT,
    offset=LONG,
)

# Where a record stood in its topic; read but never written.
POSITION = ["partition", "offset"]

# When the topic took a record, where the source tells; read but never written.
RECORD_TIME = "record_time"
TIMED_RECORDS = T.StructType([*TOPIC_RECORDS.fields, T.StructField(RECORD_TIME, TIME)])

# Columns of the sinks, in the order they are declared.
PROCESSED_EVENTS = [
    *[f.name for f in RAW_EVENTS.fields if f.name != "gtm_preview_code"],
    "processed_time",
    "gtm_preview_code",
    "processing_status",
]
EVENT_ARCHIVE = [*PROCESSED_EVENTS, "dt", "hr"]
ATTRIBUTED_ARCHIVE = [
    *PROCESSED_EVENTS[:-1],
    *ATTRIBUTION_FIELDS.names,
    "processing_status",
    "dt",
    "hr",
]
EXPOSURE_ARCHIVE = [*EXPOSURE_EVENTS.names, "processed_time", "dt", "hr"]
CLICK_ITEMS = [
    "fingerprint",
    "click_id_name",
    "click_time",
    "user_id",
    "click_id",
    "utm_json",
    "event_id",
    "updated_at",
    "expire_at",
]

# Keys by which the sinks overwrite.
EVENT_KEY = ["event_id"]
ARCHIVE_KEY = ["event_id", "dt", "hr"]
CLICK_KEY = ["fingerprint", "click_id_name"]
CONVERSION_KEY = ["conversion_id"]
STATS_KEY = ["window_start", "event_type", "platform"]
