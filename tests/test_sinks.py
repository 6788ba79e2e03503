"""Sinks: replays change nothing, the newest write per key is read."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from streams import add_file, drain, event
from touchline import schemas
from touchline.operators import enrich
from touchline.sinks import archive, changelog, click_store, commits
from touchline.sources import topics
from touchline.streaming import jobs

NOW = datetime(2024, 1, 1, 15, 59, 30, 120000, tzinfo=timezone.utc)


def raw(spark, *rows):
    """Raw events from (event_id, event_time)."""
    base = spark.createDataFrame(rows, "event_id string, event_time bigint")
    missing = [f for f in schemas.RAW_EVENTS.fields if f.name not in base.columns]
    return base.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def put(spark, path, batch_id, now, *rows, generation=0):
    out = enrich.to_event_archive(raw(spark, *rows), F.lit(now))
    archive.upsert_archive(out, path, commits.commit_id(generation, batch_id))


def stored(table):
    return sorted((r.event_id, r.event_time, r.dt, r.hr) for r in table.collect())


def test_archive_upserts_within_the_hour_and_survives_replay(spark, folder):
    put(spark, folder, 0, NOW, ("a", 100), ("b", 100))
    for _ in range(2):
        put(spark, folder, 1, NOW + timedelta(seconds=20), ("a", 50), ("c", 1))
    expected = [
        ("a", 50, "2024-01-01", "23"), ("b", 100, "2024-01-01", "23"), ("c", 1, "2024-01-01", "23"),
    ]
    assert stored(archive.read_archive(spark, folder)) == expected
    assert commits.read_commits(spark, [folder], archive.EVENT_ARCHIVE).count() == 4
    # The next batch falls in the next local hour, which is another key.
    put(spark, folder, 2, NOW + timedelta(seconds=60), ("a", 20))
    both = stored(archive.read_archive(spark, folder))
    assert both == sorted([*expected, ("a", 20, "2024-01-02", "00")])
    merged = archive.dedup_archive(archive.read_archive(spark, folder))
    assert [(i, t) for i, t, *_ in stored(merged)] == [("a", 20), ("b", 100), ("c", 1)]


def test_a_new_query_over_the_same_archive_loses_nothing(spark, folder):
    put(spark, folder, 0, NOW, ("a", 1))
    second = commits.generation(spark, f"{folder}-cp", [folder])
    assert second == 1 == commits.generation(spark, f"{folder}-cp", [folder])
    put(spark, folder, 0, NOW + timedelta(seconds=5), ("b", 2), generation=second)
    assert [i for i, *_ in stored(archive.read_archive(spark, folder))] == ["a", "b"]


def test_compacted_archive_reads_the_same_and_takes_later_commits(spark, folder):
    live, target = f"{folder}/live", f"{folder}/compact"
    put(spark, live, 0, NOW, ("a", 100), ("b", 100))
    put(spark, live, 1, NOW + timedelta(seconds=1), ("a", 50))
    before = stored(archive.read_archive(spark, live))
    archive.compact_archive(spark, live, target)
    assert stored(archive.read_archive(spark, target)) == before
    assert stored(archive.read_compacted(spark, target)) == before
    put(spark, live, 2, NOW + timedelta(seconds=2), ("b", 7))
    assert [t for _, t, *_ in stored(archive.read_archive(spark, target, live))] == [50, 7]


def test_a_clock_that_steps_back_does_not_change_the_order_of_writes(spark, folder):
    put(spark, folder, 0, NOW, ("a", 100))
    put(spark, folder, 1, NOW - timedelta(seconds=5), ("a", 50))
    assert [t for _, t, *_ in stored(archive.read_archive(spark, folder))] == [50]


def test_archive_dedup_rejects_an_unknown_rule(spark, folder):
    put(spark, folder, 0, NOW, ("a", 100))
    with pytest.raises(ValueError):
        archive.dedup_archive(archive.read_archive(spark, folder), keep="any")


def test_last_arrivals_need_a_source_position(spark):
    rows = enrich.to_event_archive(raw(spark, ("a", 1)), F.lit(NOW))
    with pytest.raises(ValueError):
        archive.last_arrivals(rows)


def test_partition_filters_prune_the_archive(spark, folder):
    put(spark, folder, 0, NOW, ("a", 1))
    put(spark, folder, 1, NOW + timedelta(hours=1), ("b", 1))
    hour = archive.read_archive(spark, folder).where("dt = '2024-01-01' AND hr = '23'")
    plan = hour._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert [i for i, *_ in stored(hour)] == ["a"]


def test_changelog_text(spark):
    rows = enrich.to_processed_events(raw(spark, ("a", 5)), F.lit(NOW))
    rows = rows.withColumn("utm_params", F.expr("map('k', 'v', 'n', null)"))
    row = changelog.to_changelog(rows).first()
    assert row.key == '{"event_id":"a"}'
    assert row.value.startswith('{"event_id":"a","event_type":null,')
    assert '"utm_params":{"k":"v","n":null}' in row.value
    assert '"event_time":5' in row.value
    assert '"processed_time":"2024-01-01 15:59:30.12"' in row.value
    assert row.value.endswith('"processing_status":"deduplicated"}')


def items(spark, *rows):
    names = "fingerprint string, click_id_name string, click_time bigint, user_id string"
    table = spark.createDataFrame(rows, names)
    missing = [f for f in click_store.ITEM_SCHEMA.fields if f.name not in table.columns]
    table = table.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    return table.withColumn("expire_at", F.expr("click_time div 1000 + 10"))


def test_click_store_replaces_whole_items(spark, folder):
    ids = [commits.commit_id(0, batch_id) for batch_id in range(4)]
    both = items(spark, ("v", "g", 9000, "u"), ("v", "g", 8000, "w"))
    click_store.put_items(both, folder, ids[0])
    for _ in range(2):
        click_store.put_items(items(spark, ("x", "g", 1000, "u")), folder, ids[1])
    at = F.timestamp_seconds(F.lit(0))
    found = {(r.fingerprint, r.user_id) for r in click_store.read_items(spark, folder, now=at).collect()}
    assert found == {("v", "u"), ("x", "u")}
    # An older click in a later batch loses; of one click the last write counts, NULLs too.
    click_store.put_items(items(spark, ("v", "g", 5000, "w")), folder, ids[2])
    (v,) = click_store.read_items(spark, folder, now=at).where("fingerprint = 'v'").collect()
    assert (v.click_time, v.user_id) == (9000, "u")
    click_store.put_items(items(spark, ("v", "g", 9000, None)), folder, ids[3])
    (v,) = click_store.read_items(spark, folder, now=at).where("fingerprint = 'v'").collect()
    assert (v.click_time, v.user_id) == (9000, None)
    # At 12 s the item of x, alive until 11 s, is gone; compacting purges it.
    at = F.timestamp_seconds(F.lit(12))
    assert [r.fingerprint for r in click_store.read_items(spark, folder, now=at).collect()] == ["v"]
    target = f"{folder}-compact"
    click_store.compact_items(spark, folder, target, at)
    rows = commits.read_commits(spark, [target], click_store.ITEM_SCHEMA).collect()
    assert [r.fingerprint for r in rows] == ["v"]


def test_jobs_merge_into_a_catalog_table(spark, folder):
    """No format with MERGE is installed, so the statement must reach Spark and be refused."""
    spark.sql(f"CREATE TABLE merged_events (event_id STRING) USING parquet LOCATION '{folder}/t'")
    try:
        for kind, job in (
            ("raw", lambda r: jobs.event_job(r, jobs.EventSinks(archive_table="merged_events"), f"{folder}/a")),
            ("attributed", lambda r: jobs.attributed_job(r, "", f"{folder}/b", archive_table="merged_events")),
        ):
            add_file(spark, f"{folder}/{kind}", [event("a", 1)])
            with pytest.raises(Exception, match="MERGE"):
                drain(job(topics.exported_stream(spark, f"{folder}/{kind}")))
    finally:
        spark.sql("DROP TABLE merged_events")


def test_merge_into_a_catalog_table_needs_a_format_with_merge(spark, folder):
    spark.sql(f"CREATE TABLE plain_events (event_id STRING) USING parquet LOCATION '{folder}/t'")
    try:
        with pytest.raises(Exception, match="MERGE"):
            commits.merge_into(
                spark.createDataFrame([("a",)], "event_id string"), "plain_events", ["event_id"]
            )
    finally:
        spark.sql("DROP TABLE plain_events")
