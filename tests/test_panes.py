"""Windows from panes, sketches, narrowed decode, closed sessions, recorded runs, the click table."""

import glob
import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from streams import add_file, drain, event, subfolder
from touchline import schemas
from touchline.operators import attribution, clicks, enrich, health, sessions, stats
from touchline.operators.decode import decode
from touchline.plans import adapter, stream_queries
from touchline.sinks import archive, click_table
from touchline.sources import topics, views
from touchline.streaming import app, jobs, windows
from touchline.streaming.health import read_progress, recorded

SF_DIR = "/root/testdata/sf0.001"


def plan(frame, kind="executedPlan"):
    return getattr(frame._jdf.queryExecution(), kind)().toString()


# ---- sliding windows -----------------------------------------------------------------------------


def timed(spark, rows):
    table = spark.createDataFrame(rows, "event_time bigint, event_type string, user_id string")
    return enrich.with_event_timestamp(table)


def random_rows(n, seed, span):
    rng = random.Random(seed)
    users = ["hot"] * 4 + ["u", "v", "w", None]
    return [(rng.randrange(-span, span), rng.choice(["a", "b", None]), rng.choice(users)) for _ in range(n)]


def brute_windows(rows, size, slide):
    found = {}
    for time, kind, user in rows:
        start = time // slide * slide
        while start + size > time:
            found.setdefault((start, start + size, kind), []).append(user)
            start -= slide
    return {key: (len(users), len({u for u in users if u is not None})) for key, users in found.items()}


@pytest.mark.parametrize("size, slide", [(300, 60), (60, 60), (120, 60), (3600, 60), (90, 60)])
@pytest.mark.parametrize("span", [300, 20_000])
def test_sliding_windows_match_brute_force(spark, size, slide, span):
    rows = random_rows(400, size + span, span)
    found = stats.window_stats(timed(spark, rows), ["event_type"], f"{size} seconds", f"{slide} seconds")
    seconds = [F.unix_seconds(name).alias(name) for name in ("window_start", "window_end")]
    got = found.select(*seconds, "event_type", "event_count", "user_count").collect()
    assert {tuple(r[:3]): (r.event_count, r.user_count) for r in got} == brute_windows(rows, size, slide)
    assert len(got) == len(brute_windows(rows, size, slide))


def test_panes_do_not_repeat_events(spark):
    rows = timed(spark, random_rows(50, 1, 300))
    direct = stats.window_stats(rows, ["event_type"], "5 minutes", "1 minute", panes=False)
    panes = stats.hopping_stats(rows, ["event_type"])
    assert "Expand" in plan(direct) and "Expand" not in plan(panes)
    # Panes are repeated for their windows only after users have been counted.
    text = plan(panes)
    assert text.index("Generate explode") < text.index("count(user_id") < text.index("Window [lag")


def test_sketches_of_panes_unite_over_windows(spark):
    rows = [(i % 600, "a", f"u{i % 5000}") for i in range(30_000)] + [(7, "b", None), (8, None, "u1")]
    panes = stats.sketched_panes(timed(spark, rows), ["event_type"])
    for size in ("5 minutes", "1 hour"):
        exact = stats.window_stats(timed(spark, rows), ["event_type"], size, "1 minute")
        rough = stats.stats_from_sketches(panes, ["event_type"], size)
        same = exact["event_type"].eqNullSafe(rough["event_type"]) & (exact["window_start"] == rough["window_start"])
        both = exact.join(rough, same).select(exact["event_count"], rough["event_count"], "user_count", "user_estimate").collect()
        assert len(both) == exact.count() == rough.count()
        for events, counted, users, estimate in both:
            assert events == counted
            assert abs(users - estimate) <= 5 * stats.SKETCH_ERROR * users + 0.5
    with pytest.raises(ValueError, match="whole"):
        stats.stats_from_sketches(panes, ["event_type"], "90 seconds")


def stream(spark, folder, *files):
    for nth, rows in enumerate(files):
        add_file(spark, subfolder(folder, "topic"), rows, 1000 * nth)
    return decode(topics.exported_stream(spark, subfolder(folder, "topic"), max_files=1), schemas.RAW_EVENTS)


def written(spark, folder, rows, name="out"):
    writer = rows.writeStream.format("parquet").option("path", subfolder(folder, name))
    drain(writer.option("checkpointLocation", subfolder(folder, f"{name}-cp")))
    return spark.read.schema(rows.schema).parquet(subfolder(folder, name))


def test_an_event_late_for_its_pane_counts_only_without_panes(spark, folder):
    minute = 1704067200
    files = [
        [event("a", minute, user_id="u"), event("b", minute + 130, user_id="u")],
        # What is late is told by the watermark of the micro-batch before the last.
        [event("filler", minute + 400)],
        [event("late", minute + 61, user_id="v"), event("c", minute + 410)],
        [event("end", minute + 3600)],
    ]
    events = stream(spark, folder, *files)
    counted = {}
    for panes in (True, False):
        counts = windows.stream_stats(events, ["event_type"], "5 minutes", "1 minute", panes)
        found = written(spark, folder, counts, f"panes-{panes}").where(F.unix_seconds("window_start") == minute)
        counted[panes] = [(r.event_count, r.user_count) for r in found.collect()]
    # The minute of the late event has closed, the five minutes around it have not.
    assert counted == {True: [(2, 1)], False: [(3, 2)]}


# ---- narrowed decode -----------------------------------------------------------------------------

FIELDS = ["event_time", "event_id", "utm_params"]


def test_narrowed_decode_equals_the_full_one_on_damaged_records(spark):
    topic = adapter.damaged(adapter.as_topic(adapter.raw_events(spark, SF_DIR)))
    full = decode(topic, schemas.RAW_EVENTS).select("event_id", F.to_json("utm_params").alias("utm"), "event_time", "offset")
    few = decode(topic, schemas.RAW_EVENTS, FIELDS)
    assert few.columns == ["event_id", "utm_params", "event_time", *schemas.POSITION]
    narrow = few.select("event_id", F.to_json("utm_params").alias("utm"), "event_time", "offset")
    assert full.exceptAll(narrow).count() == 0 and narrow.exceptAll(full).count() == 0
    assert narrow.count() > 0


@pytest.mark.parametrize("text", ['{"event_id":"a","user_id":{"x":[1', "[]", "null", "", '{"user_id":3} tail', '{"user_data":"t","event_id":"a"}'])
def test_which_records_are_objects_does_not_depend_on_the_fields(spark, text):
    records = spark.createDataFrame([(text,)], "value string")
    assert decode(records, schemas.RAW_EVENTS).count() == decode(records, schemas.RAW_EVENTS, ["event_id"]).count()


def test_only_named_fields_are_parsed(spark):
    topic = adapter.as_topic(adapter.raw_events(spark, SF_DIR))
    views.create_topic_view(topic, "raw_events", FIELDS)
    text = plan(spark.sql("SELECT event_id, event_timestamp FROM raw_events"))
    parser = text[text.index("from_json(StructField") :]
    parser = parser[: parser.index("columnNameOfCorruptRecord")]
    assert all(f"StructField({name}," in parser for name in FIELDS)
    assert not any(f"StructField({name}," in parser for name in set(schemas.RAW_EVENTS.names) - set(FIELDS))
    with pytest.raises(ValueError, match="unknown"):
        decode(topic, schemas.RAW_EVENTS, ["event_id", "unknown"])
    views.create_topic_view(topic, "raw_events", ["event_id"])
    assert spark.table("raw_events").columns == ["event_id", *schemas.POSITION]


# ---- sessions of a stream ------------------------------------------------------------------------


def test_streamed_sessions_close_part_and_drop_late_events(spark, folder):
    def touch(name):
        return {"utm_params": {"utm_source": name}}

    files = [
        [event("a", 10_000, user_id="u", **touch("x")), event("b", 9_000, user_id="u", **touch("first"))],
        # Exactly a gap later is a session of its own, a second less is not.
        [event("c", 10_000 + 1799, user_id="v", **touch("y")), event("d", 10_000, user_id="v", **touch("z"))],
        [event("e", 10_000 + 1800, user_id="u", **touch("next")), event("n", 10_000, **touch("nobody"))],
        [event("f", 60_000, user_id="w", **touch("open"))],
        [event("filler", 60_000, user_id="w")],
        [event("late", 10_001, user_id="u", **touch("late")), event("g", 60_001, user_id="w")],
        [event("h", 59_000, user_id="w", **touch("earlier"))],
    ]
    found = written(spark, folder, windows.stream_sessions(stream(spark, folder, *files)))
    rows = {tuple(r) for r in found.select("user_id", "session_id", "first_touch_channel", F.unix_seconds("session_start")).collect()}
    assert rows == {("u", "u-9000", "first", 9_000), ("u", "u-11800", "next", 11_800), ("v", "v-10000", "z", 10_000)}
    assert found.columns == sessions.user_sessions(stream(spark, folder)).columns


# ---- recorded runs -------------------------------------------------------------------------------


def test_recorded_runs_count_records_and_late_groups(spark, folder):
    minute = 1704067200
    files = [
        [event(str(i), minute + i, user_id="u") for i in range(5)],
        [event("far", minute + 900, user_id="u")],
        [event("filler", minute + 900, user_id="u")],
        [event("x", minute + 1, user_id="u"), event("y", minute + 2, user_id="u"), event("z", minute + 3, user_id="v")],
    ]
    counts = windows.stream_stats(stream(spark, folder, *files), ["event_type"])
    writer = counts.writeStream.format("noop").queryName("counted")
    with recorded(spark, subfolder(folder, "progress")):
        drain(writer.option("checkpointLocation", subfolder(folder, "cp")))
    progress = read_progress(spark, subfolder(folder, "progress"))
    report = health.query_report(progress).groupBy("query").agg(F.sum("records"), F.sum("late_groups"), F.max("watermark")).collect()
    # Two late events of one user and minute are one group.
    (row,) = [tuple(r) for r in report if r["query"] == "counted"]
    assert row[:3] == ("counted", 10, 2)
    assert row[3].timestamp() == minute + 900 - 5 or row[3] == datetime.fromtimestamp(minute + 895)


# ---- click table ---------------------------------------------------------------------------------


@pytest.fixture
def table(spark, folder):
    spark.sql(f"CREATE DATABASE click_test LOCATION '{folder}/db'")
    yield "click_test.items"
    spark.sql("DROP DATABASE click_test CASCADE")


DAY = 86_400


def items(spark, *rows):
    seen = spark.createDataFrame(rows, "anonymous_id string, k string, v string, click_time bigint, event_id string")
    return clicks.click_items(
        seen.withColumns({"user_id": F.lit("u"), "utm_params": F.lit(None).cast("map<string,string>")}), F.timestamp_seconds(F.lit(0))
    )


def at(seconds):
    return datetime.fromtimestamp(seconds, timezone.utc)


def alive(spark, table, seconds):
    rows = click_table.read_items(spark, table, F.lit(at(seconds))).collect()
    return sorted((r.fingerprint, r.click_id_name, r.click_id) for r in rows)


def test_click_table_keeps_the_newest_and_purges_on_write(spark, table):
    day = DAY * 1000
    first = items(spark, ("v", "g", "old", day, "1"), ("v", "g", "new", 3 * day, "2"), ("w", "g", "w", day, "3"), ("x", "f", "timeless", None, "4"))
    for _ in range(2):  # a repeated micro-batch
        click_table.put_items(first, table, at(5 * DAY), buckets=4)
    assert alive(spark, table, 5 * DAY) == [("v", "g", "new"), ("w", "g", "w"), ("x", "f", "timeless")]
    # An older click loses, whenever it is written; w expires after day 31.
    click_table.put_items(items(spark, ("v", "g", "older", 2 * day, "5"), (None, "g", "nobody", 2 * day, "6")), table, at(31 * DAY + 5), buckets=4)
    assert alive(spark, table, 31 * DAY + 5) == [("v", "g", "new"), ("x", "f", "timeless")]
    click_table.put_items(items(spark, ("y", "g", "y", 32 * day, "7")), table, at(32 * DAY + 5), buckets=4)
    days = {r[0] for r in spark.table(table).select(click_table.EXPIRY_DAY).distinct().collect()}
    assert days == {"never", "1970-02-02", "1970-02-03", "1970-03-04"}  # 1970-02-01 is over
    # An item that has expired is not written at all.
    click_table.put_items(items(spark, ("z", "g", "z", day, "8")), table, at(32 * DAY + 5), buckets=4)
    assert ("z", "g", "z") not in alive(spark, table, 0)


def test_click_table_is_read_without_a_shuffle_and_compacted(spark, table):
    rows = [(f"v{i}", "g", f"c{j}", (i + j) * 1000, f"{i}-{j}") for i in range(30) for j in range(4)]
    for part in (rows[::2], rows[1::2]):
        click_table.put_items(items(spark, *part), table, at(0), buckets=4)
    found = click_table.read_items(spark, table, F.lit(at(0)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "Exchange" not in plan(found) and "Bucketed: true" in plan(found)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    before = alive(spark, table, 0)
    assert before == sorted((f"v{i}", "g", "c3") for i in range(30))
    click_table.compact(spark, table, at(0), buckets=4)
    assert alive(spark, table, 0) == before and spark.table(table).count() == 30
    click_table.put_items(items(spark, ("v0", "g", "later", 99_000, "z")), table, at(0), buckets=4)
    assert ("v0", "g", "later") in alive(spark, table, 0)


def test_event_job_keeps_a_click_table(spark, folder, table):
    now = int(datetime.now(timezone.utc).timestamp())

    def click(name, age):
        seen = now - age
        params = {"gclid": name, "gclid_timestamp": str(seen * 1000)}
        return event(name, seen, anonymous_id="v", clid_params=params)

    source = subfolder(folder, "topic")
    add_file(spark, source, [click("older", 500), click("expired", 40 * DAY)])
    add_file(spark, source, [click("newest", 10), click("between", 90)], 10)
    sinks = jobs.EventSinks(click_table=table)
    drain(jobs.event_job(topics.exported_stream(spark, source, max_files=1), sinks, subfolder(folder, "cp")))
    assert alive(spark, table, now) == [("v", "gclid", "newest")]
    assert spark.table(table).where("click_id = 'expired'").count() == 0


# ---- stream joins and the starter ----------------------------------------------------------------


def test_a_hot_user_of_a_stream_is_spread_over_tasks(spark):
    rows = [(f"e{i}", "conversion", "hot" if i % 3 else f"u{i % 50}", i) for i in range(3000)]
    events = spark.createDataFrame(rows, "event_id string, event_type string, user_id string, event_time bigint")
    users = [(u, "ads", "c") for u in ["hot", *(f"u{i}" for i in range(50))]]
    touches = spark.createDataFrame(users, "user_id string, first_touch_channel string, first_touch_campaign string")
    kept = {name: spark.conf.get(name) for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        for name, value in zip(kept, ("-1", "8", "false")):
            spark.conf.set(name, value)
        joined = attribution.stream_first_touch(events, touches).withColumn("task", F.spark_partition_id())
        tasks = [r["count"] for r in joined.groupBy("task").count().collect()]
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert sum(tasks) == 3000 and len(tasks) == 8 and max(tasks) < 3000 / 2.5


def test_the_starter_hands_tables_to_the_jobs(spark, folder, monkeypatch):
    seen = {}
    monkeypatch.setattr(app.jobs, "event_job", lambda records, sinks, checkpoint: seen.update(sinks=sinks))
    monkeypatch.setattr(app.jobs, "attributed_job", lambda *a, archive_table: seen.update(attributed=archive_table))
    monkeypatch.setattr(app.jobs, "exposure_job", lambda *a: None)
    app.topic_jobs(lambda topic: None, None, folder, store_clicks=True, archive_table="c.e", attributed_table="c.a", click_table="c.k")
    assert (seen["sinks"].archive_table, seen["attributed"], seen["sinks"].click_table) == ("c.e", "c.a", "c.k")
    assert seen["sinks"].clicks is None


@pytest.mark.parametrize("timed", [True, False])
def test_the_last_arrival_goes_by_the_time_of_the_record(spark, folder, timed):
    """Two copies in two partitions: partition 0 took the last one."""
    rows = [('{"event_id":"a","event_time":1}', 0, 5, at(200)), ('{"event_id":"a","event_time":2}', 1, 9, at(100))]
    spark.createDataFrame(rows, schemas.TIMED_RECORDS).write.parquet(subfolder(folder, "topic"))
    schema = schemas.TIMED_RECORDS if timed else schemas.TOPIC_RECORDS
    records = topics.exported_stream(spark, subfolder(folder, "topic"), schema=schema)
    sinks = jobs.EventSinks(archive=subfolder(folder, "archive"))
    drain(jobs.event_job(records, sinks, subfolder(folder, "cp"), archive_all=True))
    (row,) = archive.read_archive(spark, sinks.archive).collect()
    assert row.event_time == (1 if timed else 2)
    assert "record_time" not in archive.read_archive(spark, sinks.archive).columns


def test_thirds_of_the_time_have_as_many_files_each_and_shuffle_no_records(spark, folder):
    start = datetime(2024, 1, 1)
    # Few rows, and none of them in the second third of the time.
    seconds = [1, 2, 3, 4, 5, 900, 901, 902, 903]
    rows = [(i + 1, start + timedelta(seconds=s), i % 3, "view", 1.5, '{"k": 4}') for i, s in enumerate(seconds)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/events.parquet")
    path, per_batch = stream_queries._export_by_time(spark, folder)
    files = sorted(glob.glob(f"{path}/part-*.parquet"), key=os.path.getmtime)
    assert len(files) == 3 * per_batch
    found = [spark.read.parquet(*files[k * per_batch : (k + 1) * per_batch]) for k in range(3)]
    time = F.get_json_object("value", "$.event_time").cast("long")
    times = [sorted(r[0] - 1704067200 for r in part.select(time).collect()) for part in found]
    assert times == [[1, 2, 3, 4, 5], [], [900, 901, 902, 903]]


def test_streamed_sessions_keep_one_narrow_value_each(spark, folder):
    rows = windows.stream_sessions(stream(spark, folder, [event("a", 1704067200, user_id="u")]))
    aggregate = next(line for line in plan(rows, "analyzed").splitlines() if "Aggregate" in line)
    assert aggregate.count("min(") == 1 and "min_by" not in aggregate
