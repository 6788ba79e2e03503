"""Queries that write through the sinks and run the streaming jobs.

Each writes below the shared folder of the cluster and returns what a reader of
the sink finds.  The topics are the whole adapted tables, exported as files.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from touchline import schemas
from touchline.operators import attribution, dedup, enrich, health, stats
from touchline.operators.decode import decode
from touchline.plans import adapter
from touchline.plans.catalog import FLAT_SQL, flat_columns, plain_time, query
from touchline.plans.click_queries import STORE_SQL, flat_items
from touchline.plans.report_queries import SESSIONS_SQL
from touchline.session import work_dir
from touchline.sinks import archive, changelog, click_store, reports
from touchline.sinks.commits import commit_id
from touchline.sources import topics
from touchline.streaming import jobs, windows
from touchline.streaming.health import read_progress, recorded
from touchline.streaming.best_rows import BestRows

# Long enough that no key expires while a topic is drained.
_NO_EXPIRY = 7 * 24 * 60 * 60
_MICRO_BATCHES = 3
_START = datetime(2024, 2, 1, tzinfo=timezone.utc)
_STATS_FIELDS = ["event_type", "user_id", "event_time"]
_BEFORE_ANY_EXPIRY = "2024-01-01 00:00:00"


def _export(spark: SparkSession, topic: DataFrame) -> tuple[str, int]:
    """The topic as files, and how many of them make a third of it."""
    per_batch = spark.sparkContext.defaultParallelism
    path = work_dir(spark, "topic")
    # Dealt by content: without columns, Spark would sort all rows first.
    topic.repartition(per_batch * _MICRO_BATCHES, "value", "offset").write.parquet(path)
    return path, per_batch


def _export_by_time(spark: SparkSession, sf_dir: str, late: Callable[[DataFrame], Column] | None = None) -> tuple[str, int]:
    """The raw events as files in thirds of the time; rows that are ``late`` come with the last."""
    # Derived once: the bounds and each third read it again.
    stored, made = work_dir(spark, "copies"), adapter.copies(spark, sf_dir)
    made.write.parquet(stored)
    events = spark.read.schema(made.schema).parquet(stored)
    first, last = events.agg(F.min("event_time"), F.max("event_time")).first()
    span = (last - first) // _MICRO_BATCHES + 1
    third = F.floor((F.col("event_time") - first) / span)
    if late is not None:
        third = F.when(late(events), _MICRO_BATCHES - 1).otherwise(third)
    parted = events.withColumn("third", third)
    per_batch = spark.sparkContext.defaultParallelism
    path = work_dir(spark, "topic")
    for k in range(_MICRO_BATCHES):
        _append(parted.where(F.col("third") == k).drop("third"), path, per_batch, per_batch * (k + 1))
    return path, per_batch


def _append(rows: DataFrame, path: str, files: int, total: int) -> None:
    """Add the raw events of ``rows`` as ``files`` files, after which the folder has ``total``."""
    spark = rows.sparkSession
    # Dealt by content, since Spark would sort rows to deal them in turn, and before they become
    # wide: records are then built by all tasks alike, and none is shuffled.
    topic = adapter.as_topic(adapter.raw_events_of(rows.repartition(files, *rows.columns)))
    topic.write.mode("append").parquet(path)
    # A file that got no rows is not written: one without rows stands in for it.
    for _ in range(total - len(spark.read.schema(topic.schema).parquet(path).inputFiles())):
        spark.createDataFrame([], topic.schema).write.mode("append").parquet(path)


def _to_table(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """Run an appending query over what is there and read its table."""
    out = work_dir(spark, label)
    writer = rows.writeStream.format("parquet").option("path", out)
    _drain(writer.option("checkpointLocation", work_dir(spark, "state")))
    return spark.read.schema(rows.schema).parquet(out)


def _delayed(events: DataFrame) -> Column:
    """Some events of the first eight days; ``events`` are rows of :func:`adapter.copies`."""
    start = events.agg(F.min("event_time")).first()[0]
    return (F.col("event_time") < start + 8 * 86400) & (F.col("id").cast("bigint") % 7 == 0)


def _drain(writer: DataStreamWriter) -> None:
    stream = writer.trigger(availableNow=True).start()
    stream.awaitTermination()


# What the damaged topic decodes to: broken records gone, some times NULL.
_DECODABLE_SQL = """
, decodable AS (
  SELECT * REPLACE (CASE WHEN pos % 13 = 5 THEN NULL WHEN pos % 13 = 9 THEN event_time * 1000000
                         ELSE event_time END AS event_time,
                    CASE WHEN pos % 13 = 6 THEN NULL ELSE utm_source END AS utm_source,
                    CASE WHEN pos % 13 = 6 THEN NULL ELSE utm_campaign END AS utm_campaign)
  FROM raw WHERE pos % 11 NOT IN (3, 4)
), winners AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (
      PARTITION BY event_id ORDER BY event_time ASC NULLS FIRST, part, pos) AS rn
    FROM decodable)
  WHERE rn = 1
)
"""


def _damaged_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = adapter.damaged(adapter.as_topic(adapter.raw_events(spark, sf_dir)))
    path, per_batch = _export(spark, topic)
    return topics.exported_stream(spark, path, max_files=per_batch)


@query(f"{_DECODABLE_SQL} SELECT {FLAT_SQL}, 'raw' AS processing_status FROM winners")
def event_stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event job over a damaged topic in several micro-batches: its archive."""
    sinks = jobs.EventSinks(archive=work_dir(spark, "archive"))
    records = _damaged_stream(spark, sf_dir)
    _drain(jobs.event_job(records, sinks, work_dir(spark, "state"), ttl_seconds=_NO_EXPIRY))
    # Hours are wall-clock hours, so a run over midnight spans two keys.
    rows = archive.dedup_archive(archive.read_archive(spark, sinks.archive))
    return rows.select(*flat_columns(), "processing_status")


@query(f"""{_DECODABLE_SQL}
SELECT '{{"event_id":"' || event_id || '"}}' AS key, event_id, event_type, event_time,
       utm_source, gclid, 'deduplicated' AS processing_status FROM winners
""")
def event_stream_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event job over a damaged topic: the last change-log value per key."""
    log = work_dir(spark, "changelog")
    sinks = jobs.EventSinks(
        publish=lambda rows, batch_id: rows.write.mode("overwrite").parquet(
            f"{log}/batch={batch_id}"
        )
    )
    records = _damaged_stream(spark, sf_dir)
    _drain(jobs.event_job(records, sinks, work_dir(spark, "state"), ttl_seconds=_NO_EXPIRY))
    latest = dedup.top_rows(spark.read.parquet(log), ["key"], [F.desc("batch")])
    value = F.from_json("value", schemas.RAW_EVENTS)
    status = F.get_json_object("value", "$.processing_status").alias("processing_status")
    rows = latest.select("key", value.alias("event"), status)
    return rows.select(
        "key",
        "event.event_id",
        "event.event_type",
        "event.event_time",
        F.col("event.utm_params")["utm_source"].alias("utm_source"),
        F.col("event.clid_params")["gclid"].alias("gclid"),
        "processing_status",
    )


@query(STORE_SQL + "SELECT * EXCLUDE (updated_at) FROM store")
def click_stream_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event job with the click store over several micro-batches."""
    path, per_batch = _export(spark, adapter.as_topic(adapter.raw_events(spark, sf_dir)))
    sinks = jobs.EventSinks(clicks=work_dir(spark, "clicks"))
    records = topics.exported_stream(spark, path, per_batch)
    _drain(jobs.event_job(records, sinks, work_dir(spark, "state"), ttl_seconds=_NO_EXPIRY))
    now = F.lit(_BEFORE_ANY_EXPIRY).cast("timestamp")
    return flat_items(click_store.read_items(spark, sinks.clicks, now=now)).drop("updated_at")


@query("""
, attributed AS (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY event_id ORDER BY event_time ASC NULLS FIRST, part, pos) AS rn FROM raw
)
SELECT event_id, event_time, cents, 'g' || n AS click_id, event_time - 3600 AS click_time,
       CAST(n % 3 = 0 AS INTEGER) AS is_attributed, 'attributed' AS processing_status
FROM attributed WHERE rn = 1
""")
def attributed_stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributed job in several micro-batches: its archive."""
    topic = adapter.as_topic(adapter.attributed_events(spark, sf_dir))
    path, per_batch = _export(spark, topic)
    records, out = topics.exported_stream(spark, path, per_batch), work_dir(spark, "archive")
    _drain(jobs.attributed_job(records, out, work_dir(spark, "state"), _NO_EXPIRY))
    stored = archive.read_archive(spark, out, schema=archive.ATTRIBUTED_ARCHIVE)
    return archive.dedup_archive(stored).select(
        "event_id",
        "event_time",
        F.col("event_properties")["cents"].alias("cents"),
        "click_id",
        "click_time",
        "is_attributed",
        "processing_status",
    )


@query("""
SELECT CAST(id AS VARCHAR) AS event_id, '/p/' || n AS page_url, n / 100.0::DOUBLE AS visible_ratio,
       props AS ext_json, base_time AS event_time FROM base
""")
def exposure_stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exposure job in several micro-batches: its append archive."""
    topic = adapter.as_topic(adapter.exposure_events(spark, sf_dir))
    path, per_batch = _export(spark, topic)
    records, out = topics.exported_stream(spark, path, per_batch), work_dir(spark, "archive")
    _drain(jobs.exposure_job(records, out, work_dir(spark, "state")))
    rows = spark.read.parquet(out)
    return rows.select("event_id", "page_url", "visible_ratio", "ext_json", "event_time")


@query("""
SELECT make_timestamp(event_time // 60 * 60000000) AS window_start,
       make_timestamp((event_time // 60 + 1) * 60000000) AS window_end,
       event_type, count(*) AS event_count, count(DISTINCT user_id) AS user_count
FROM raw
WHERE (event_time // 60 + 1) * 60 <= (SELECT max(event_time) - 5 FROM raw)
GROUP BY ALL
""")
def tumble_stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute windows of a stream that the watermark has closed."""
    path, per_batch = _export_by_time(spark, sf_dir)
    events = decode(topics.exported_stream(spark, path, per_batch), schemas.RAW_EVENTS, _STATS_FIELDS)
    rows = _to_table(spark, windows.stream_stats(events, ["event_type"]), "stats")
    return rows.withColumns({name: plain_time(name) for name in ("window_start", "window_end")})


def _archive_three_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Originals, later copies (twice over) and, an hour on, earlier copies."""
    path = work_dir(spark, "archive")
    originals, later, earlier = adapter.raw_events_by_copy(spark, sf_dir)
    steps = [(originals, 0, 0), (later, 1, 1), (later, 1, 1), (earlier, 60, 2)]
    for events, minutes, batch_id in steps:
        now = _START + timedelta(minutes=minutes)
        hours = enrich.with_hour_partition(enrich.with_processed_time(events, F.lit(now)))
        rows = enrich.to_event_archive(archive.last_arrivals(hours))
        archive.upsert_archive(rows, path, commit_id(0, batch_id))
    return archive.read_archive(spark, path)


_ARCHIVED_SQL = """
, archived AS (
  SELECT *, '2024-02-01' AS dt, CASE WHEN copy = 2 THEN '09' ELSE '08' END AS hr
  FROM (SELECT *, ROW_NUMBER() OVER (
    PARTITION BY event_id, copy = 2 ORDER BY copy DESC) AS rn FROM raw)
  WHERE rn = 1
)
"""


@query(f"{_ARCHIVED_SQL} SELECT {FLAT_SQL}, dt, hr FROM archived")
def archive_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later copies replace what the same hour holds; another hour is another key."""
    return _archive_three_batches(spark, sf_dir).select(*flat_columns(), "dt", "hr")


@query(f"""{_ARCHIVED_SQL}
SELECT {FLAT_SQL} FROM (SELECT * EXCLUDE (rn), ROW_NUMBER() OVER (
  PARTITION BY event_id ORDER BY event_time ASC NULLS FIRST) AS rn FROM archived)
WHERE rn = 1
""")
def archive_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies archived in different hours merged into one row per event."""
    return archive.dedup_archive(_archive_three_batches(spark, sf_dir)).select(*flat_columns())


@query(STORE_SQL + """
, firsts AS (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY raw.event_id ORDER BY event_time ASC NULLS FIRST, part, pos) AS rn FROM raw
)
SELECT sink, event_id AS key, event_type AS detail, event_time AS time
FROM firsts, (SELECT unnest(['archive', 'changelog']) AS sink) WHERE rn = 1
UNION ALL
SELECT 'clicks', fingerprint || '/' || click_id_name, click_id, click_time FROM store
""")
def event_stream_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event job feeding archive, change-log and click store over several micro-batches."""
    path, per_batch = _export(spark, adapter.as_topic(adapter.raw_events(spark, sf_dir)))
    log = work_dir(spark, "changelog")
    sinks = jobs.EventSinks(
        archive=work_dir(spark, "archive"),
        clicks=work_dir(spark, "clicks"),
        publish=lambda rows, batch_id: rows.write.mode("overwrite").parquet(
            f"{log}/batch={batch_id}"
        ),
    )
    records = topics.exported_stream(spark, path, per_batch)
    _drain(jobs.event_job(records, sinks, work_dir(spark, "state"), ttl_seconds=_NO_EXPIRY))

    def rows(table: DataFrame, sink: str, key: str, detail: str, time: str) -> DataFrame:
        names = F.expr(key).alias("key"), F.expr(detail).alias("detail"), F.expr(time).alias("time")
        return table.select(F.lit(sink).alias("sink"), *names)

    stored = archive.dedup_archive(archive.read_archive(spark, sinks.archive))
    # One pass over each value, before the ranking, which then moves no whole values.
    fields = ["event_id", "event_type", "event_time"]
    logged = spark.read.parquet(log).select("key", "batch", F.json_tuple("value", *fields).alias(*fields))
    latest = dedup.top_rows(logged, ["key"], [F.desc("batch")])
    events = latest.withColumn("event_time", F.col("event_time").cast("bigint"))
    now = F.lit(_BEFORE_ANY_EXPIRY).cast("timestamp")
    items = click_store.read_items(spark, sinks.clicks, now=now)
    click = "concat(fingerprint, '/', click_id_name)"
    return (
        rows(stored, "archive", "event_id", "event_type", "event_time")
        .union(rows(events, "changelog", "event_id", "event_type", "event_time"))
        .union(rows(items, "clicks", click, "click_id", "click_time"))
    )


@query("""
SELECT event_id, event_time FROM (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY event_id ORDER BY event_time DESC NULLS LAST, part, pos) AS rn FROM raw)
WHERE rn = 1
""")
def event_stream_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event job that keeps the latest copy, over several micro-batches."""
    path, per_batch = _export(spark, adapter.as_topic(adapter.raw_events(spark, sf_dir)))
    sinks = jobs.EventSinks(archive=work_dir(spark, "archive"))
    records = topics.exported_stream(spark, path, per_batch)
    state = work_dir(spark, "state")
    _drain(jobs.event_job(records, sinks, state, keep="last", ttl_seconds=_NO_EXPIRY))
    rows = archive.read_archive(spark, sinks.archive)
    return archive.dedup_archive(rows, keep="last").select("event_id", "event_time")


@query("""
SELECT 0 AS batch, event_id, event_time FROM raw WHERE copy = 0
UNION ALL SELECT 2, event_id, event_time FROM raw WHERE copy = 1
UNION ALL SELECT 3, event_id, event_time FROM raw WHERE copy = 2
""")
def event_stream_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What goes out per batch when keys live for two minutes, on a given clock.

    Later copies are no improvement after a minute, and new keys once the first
    copy has expired; earlier copies are an improvement in any case.
    """
    originals, later, earlier = adapter.raw_events_by_copy(spark, sf_dir)
    order = [("event_time", "asc"), *jobs.ARRIVAL]
    best = BestRows(work_dir(spark, "state"), schemas.EVENT_KEY, order)
    out = work_dir(spark, "sent")
    for batch_id, (rows, seconds) in enumerate([(originals, 0), (later, 60), (later, 130), (earlier, 180)]):
        winners = best.winners(rows, batch_id, _START + timedelta(seconds=seconds)).persist()
        sent = best.improved(winners).select("event_id", "event_time")
        sent.write.parquet(f"{out}/batch={batch_id}")
        best.save(winners, batch_id)
        winners.unpersist()
    return spark.read.parquet(out).select("batch", "event_id", "event_time")


_LATE_SQL = """
, timed AS (
  SELECT *, event_time < (SELECT min(event_time) FROM raw) + 8 * 86400
           AND CAST(event_id AS BIGINT) % 7 = 0 AS delayed
  FROM raw
), on_time AS (SELECT * FROM timed WHERE NOT delayed)
SELECT make_timestamp((event_time // 60 - back) * 60000000) AS window_start,
       make_timestamp((event_time // 60 - back + 5) * 60000000) AS window_end,
       event_type, count(*) AS event_count, count(DISTINCT user_id) AS user_count
FROM on_time, (SELECT unnest([0, 1, 2, 3, 4]) AS back)
WHERE (event_time // 60 - back + 5) * 60 <= (SELECT max(event_time) - 5 FROM raw)
GROUP BY ALL
"""


@query(_LATE_SQL)
def hop_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows of a stream in time order, whose delayed rows come too late to count.

    The topic comes in thirds of the time; some rows of the first days come with the last.
    """
    path, per_batch = _export_by_time(spark, sf_dir, _delayed)
    events = decode(topics.exported_stream(spark, path, per_batch), schemas.RAW_EVENTS, _STATS_FIELDS)
    rows = _to_table(spark, windows.stream_stats(events, ["event_type"], "5 minutes", "1 minute"), "stats")
    return rows.withColumns({name: plain_time(name) for name in ("window_start", "window_end")})


@query(SESSIONS_SQL + """
, bounds AS (
  SELECT user_id || '-' || min(event_time) AS session_id, max(event_time) AS last_time
  FROM numbered GROUP BY user_id, session
)
SELECT user_sessions.* FROM user_sessions JOIN bounds USING (session_id)
WHERE last_time + 1800 <= (SELECT max(event_time) - 5 FROM raw)
""")
def session_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a stream in time order that the watermark has closed."""
    path, per_batch = _export_by_time(spark, sf_dir)
    fields = ["event_id", "user_id", "utm_params", "event_time"]
    events = decode(topics.exported_stream(spark, path, per_batch), schemas.RAW_EVENTS, fields)
    rows = _to_table(spark, windows.stream_sessions(events), "sessions")
    return rows.withColumn("session_start", plain_time("session_start"))


_DELAYED_SQL = _LATE_SQL[: _LATE_SQL.index(", on_time")]


@query(f"""{_DELAYED_SQL}
SELECT 'minute stats' AS query, (SELECT count(*) FROM raw) AS records,
       (SELECT count(*) FROM (
          SELECT DISTINCT event_time // 60, event_type, user_id FROM timed WHERE delayed)) AS late_groups
""")
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the health report of a recorded run says was read and came too late.

    Minute statistics run over several micro-batches; some rows of the first days come last.
    """
    path, per_batch = _export_by_time(spark, sf_dir, _delayed)
    events = decode(topics.exported_stream(spark, path, per_batch), schemas.RAW_EVENTS, _STATS_FIELDS)
    counts = windows.stream_stats(events, ["event_type"]).writeStream.format("noop")
    progress = work_dir(spark, "progress")
    with recorded(spark, progress):
        _drain(counts.queryName("minute stats").option("checkpointLocation", work_dir(spark, "state")))
    report = health.query_report(read_progress(spark, progress))
    sums = [F.sum(name).alias(name) for name in ("records", "late_groups")]
    return report.where("query = 'minute stats'").groupBy("query").agg(*sums)


@query("""
, hot AS (SELECT *, CASE WHEN id % 3 = 0 THEN '1' ELSE user_id END AS uid FROM raw)
SELECT event_id AS conversion_id, uid AS user_id, event_type AS conversion_type,
       event_time AS conversion_time, c_mktsegment AS attributed_channel,
       c_name AS attributed_campaign, 'first_touch' AS attribution_model
FROM hot JOIN customer ON uid = CAST(c_custkey AS VARCHAR)
WHERE event_type = 'purchase'
""")
def first_touch_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversions of a stream, a third of them of one user, with that of a stored table."""
    raw = adapter.raw_events(spark, sf_dir)
    hot = raw.withColumn("user_id", F.when(F.col("event_id").cast("bigint") % 3 == 0, "1").otherwise(F.col("user_id")))
    path, per_batch = _export(spark, adapter.as_topic(hot))
    fields = ["event_id", "event_type", "user_id", "event_time"]
    events = decode(topics.exported_stream(spark, path, per_batch), schemas.RAW_EVENTS, fields)
    touches = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_mktsegment").alias("first_touch_channel"),
        F.col("c_name").alias("first_touch_campaign"),
    )
    return _to_table(spark, attribution.stream_first_touch(events, touches, "purchase"), "conversions")


@query("""
SELECT 0 AS batch, event_id, event_time FROM raw WHERE copy = 0
UNION ALL SELECT 2, event_id, event_time FROM raw WHERE copy = 2
""")
def event_stream_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the event job with its two minutes of memory publishes in each micro-batch.

    Originals, later copies and earlier copies come one after another, within two minutes.  A
    later copy is no improvement, so the second micro-batch publishes nothing.
    """
    per_batch = spark.sparkContext.defaultParallelism
    path, log = work_dir(spark, "topic"), work_dir(spark, "changelog")
    for events in adapter.raw_events_by_copy(spark, sf_dir):
        adapter.as_topic(events).repartition(per_batch).write.mode("append").parquet(path)
    sinks = jobs.EventSinks(
        publish=lambda rows, batch_id: rows.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")
    )
    _drain(jobs.event_job(topics.exported_stream(spark, path, per_batch), sinks, work_dir(spark, "state")))
    value = F.from_json("value", schemas.struct(event_id=schemas.TEXT, event_time=schemas.LONG))
    return spark.read.parquet(log).select("batch", value.alias("event")).select("batch", "event.*")


def _in_two_commits(spark: SparkSession, sf_dir: str, report, put, label: str) -> str:
    """A report over the originals, then over all events, the second written over the first."""
    path = work_dir(spark, label)
    for batch_id, events in enumerate(
        [adapter.raw_events_by_copy(spark, sf_dir)[0], adapter.raw_events(spark, sf_dir)]
    ):
        put(report(events), path, commit_id(0, batch_id))
    return path


@query("""
SELECT make_timestamp(event_time // 60 * 60000000) AS window_start,
       make_timestamp((event_time // 60 + 1) * 60000000) AS window_end,
       event_type, platform, count(*) AS event_count, count(DISTINCT user_id) AS user_count
FROM raw GROUP BY ALL
""")
def stats_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute statistics in a table that overwrites by window, type and platform."""

    def report(events: DataFrame) -> DataFrame:
        platform = F.col("event_properties")["platform"]
        return stats.tumbling_stats(events.withColumn("platform", platform))

    path = _in_two_commits(spark, sf_dir, report, reports.put_stats, "stats")
    names = ("window_start", "window_end")
    return reports.read_stats(spark, path).withColumns({name: plain_time(name) for name in names})


@query("""
SELECT event_id AS conversion_id, user_id, event_type AS conversion_type,
       event_time AS conversion_time, utm_source AS attributed_channel,
       utm_campaign AS attributed_campaign, 'last_touch' AS attribution_model
FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY event_id ORDER BY event_time ASC NULLS FIRST, part, pos) AS rn
      FROM raw WHERE event_type = 'purchase') WHERE rn = 1
""")
def conversions_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last-touch conversions in a table that overwrites by conversion id."""

    def report(events: DataFrame) -> DataFrame:
        firsts = attribution.unique_conversions(events, "purchase")
        return attribution.last_touch(firsts, "purchase")

    path = _in_two_commits(spark, sf_dir, report, reports.put_conversions, "conversions")
    return reports.read_conversions(spark, path)
