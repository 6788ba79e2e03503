"""Operators on small literals and against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from touchline.operators import attribution, clicks, dedup, enrich, health, sessions, stats

EVENT = (
    "event_id string, event_type string, user_id string, anonymous_id string, "
    "utm_params map<string,string>, clid_params map<string,string>, event_time bigint, "
    "partition int, offset bigint"
)


def events(spark, *rows):
    """Rows given as dicts; the offset is the position."""
    names = [part.split(" ")[0] for part in EVENT.split(", ")]
    full = [{"partition": 0, "offset": i, **row} for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], EVENT)


def clock(text):
    return F.lit(text).cast("timestamp")


def test_dedup_ties_nulls_and_last(spark):
    rows = events(
        spark,
        {"event_id": "a", "event_time": 5},
        {"event_id": "a", "event_time": 5},
        {"event_id": "b", "event_time": 1},
        {"event_id": "b"},
        {"event_time": 9},
        {"event_time": 8},
    )
    first = {r.event_id: r.offset for r in dedup.dedup_events(rows).collect()}
    last = {r.event_id: r.offset for r in dedup.dedup_events(rows, keep="last").collect()}
    assert first == {"a": 0, "b": 3, None: 5}
    assert last == {"a": 0, "b": 2, None: 4}
    with pytest.raises(ValueError):
        dedup.dedup_events(rows, keep="any")


def test_dedup_matches_brute_force_with_one_hot_id(spark):
    rng = random.Random(7)
    rows = [
        {"event_id": "hot" if i % 3 == 0 else f"e{rng.randrange(40)}", "event_time": rng.randrange(60)}
        for i in range(600)
    ]
    best = {}
    for i, row in enumerate(rows):
        rank = (row["event_time"], i)
        best[row["event_id"]] = min(best.get(row["event_id"], rank), rank)
    out = dedup.dedup_events(events(spark, *rows).repartition(6)).collect()
    assert {r.event_id: (r.event_time, r.offset) for r in out} == best
    assert len(out) == len(best)


def test_dedup_limits_each_key_before_the_shuffle(spark):
    plan = dedup.dedup_events(events(spark, {"event_id": "a"}))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_hour_partition_is_eight_hours_ahead(spark):
    rows = enrich.with_processed_time(
        spark.createDataFrame([(1,)], "x int"), clock("2024-01-01 17:30:00.123456")
    )
    row = enrich.with_hour_partition(rows).first()
    assert (row.dt, row.hr, row.processed_time.microsecond) == ("2024-01-02", "01", 123000)


def test_click_entries(spark):
    params = {
        "gclid": "g1", "gclid_timestamp": "x1", "gclidtimestamp": "7", "timestamp": "8",
        "fbclid": "", "ttclid": None, "msclkid": "m", "msclkid_timestamp": "12",
    }
    rows = events(spark, {"event_id": "a", "clid_params": params}, {"clid_params": {}}, {})
    out = {(r.k, r.v, r.click_time) for r in clicks.explode_clicks(rows).collect()}
    # "_" in the pattern matches any character but needs one.
    assert out == {("gclid", "g1", None), ("timestamp", "8", None), ("msclkid", "m", 12)}
    assert [r.event_id for r in clicks.with_click(rows, "gclid").collect()] == ["a"]


def click(time, **fields):
    return {"anonymous_id": "v", "clid_params": {"g": "1", "g_timestamp": str(time)}, **fields}


def test_newest_click_wins_then_earliest_event(spark):
    rows = events(
        spark,
        click(100, event_id="old", event_time=1),
        click(200, event_id="late", event_time=9),
        click(200, event_id="early", event_time=3),
        click("bad", event_id="untimed", event_time=0),
        click(100, event_id="other", event_time=1, anonymous_id="w"),
    )
    assert {r.event_id for r in clicks.latest_clicks(rows).collect()} == {"early", "other"}
    two = clicks.latest_clicks(rows, max_rank=2).collect()
    assert {(r.event_id, r.is_new_click) for r in two} == {
        ("early", True), ("late", False), ("other", True),
    }
    assert {r.event_id for r in clicks.click_items(clicks.latest_clicks(rows, 2)).collect()} == {
        "early", "other",
    }


def test_click_instances_ignore_the_name_and_use_the_time_text(spark):
    both = {"g": "1", "g_timestamp": "5", "h": "1", "h_timestamp": "5"}
    rows = events(
        spark,
        {"anonymous_id": "v", "clid_params": both, "event_time": 1},
        {"anonymous_id": "v", "clid_params": {"g": "1", "g_timestamp": "05"}, "event_time": 2},
        {"anonymous_id": "v", "clid_params": {"g": "1"}, "event_time": 3},
    )
    out = [r.click_time for r in clicks.click_instances(rows).collect()]
    assert sorted(out, key=str) == [5, 5, None]


def test_items(spark):
    rows = events(
        spark,
        click(3500000000, event_id="a", user_id="", utm_params={"utm_source": "", "x": "1"}),
        click(-1, event_id="b", anonymous_id=None),
        click("none", event_id="", anonymous_id="w", utm_params={"utm_source": ""}),
    )
    items = clicks.click_items(clicks.latest_clicks(rows), clock("1970-01-01 00:00:02.5"))
    a, w = items.orderBy("fingerprint").collect()
    assert tuple(a) == ("v", "g", 3500000000, None, "1", {"x": "1"}, "a", 2500, 6092000)
    assert tuple(w) == ("w", "g", None, None, "1", None, None, 2500, None)


def test_expiry_truncates_towards_zero_and_untimed_items_stay(spark):
    items = spark.createDataFrame([(-1,), (999,), (None,)], "click_time bigint").select(
        "click_time", clicks.fx.expire_at(F.col("click_time")).alias("expire_at")
    )
    assert [r.expire_at for r in items.collect()] == [2592000, 2592000, None]
    alive = clicks.unexpired(items, F.timestamp_seconds(F.lit(2592000))).collect()
    assert [r.click_time for r in alive] == [None]


def test_last_touch_and_literal_join(spark):
    rows = events(
        spark,
        {"event_id": "c", "event_type": "conversion", "user_id": "u", "event_time": 4,
         "utm_params": {"utm_source": "s"}},
        {"event_id": "d", "event_type": "conversion", "user_id": "x"},
        {"event_id": "e", "event_type": "view", "user_id": "u"},
    )
    last = {tuple(r) for r in attribution.last_touch(rows).collect()}
    assert last == {
        ("c", "u", "conversion", 4, "s", None, "last_touch"),
        ("d", "x", "conversion", None, None, None, "last_touch"),
    }
    table = spark.createDataFrame(
        [("u", "one", "k1"), ("u", "two", "k2")],
        "user_id string, first_touch_channel string, first_touch_campaign string",
    )
    joined = attribution.first_touch_join(rows, table).collect()
    assert sorted((r.conversion_id, r.attributed_channel) for r in joined) == [
        ("c", "one"), ("c", "two"),
    ]


def random_events(n, seed=3):
    rng = random.Random(seed)
    return [
        {
            "event_id": f"e{i}",
            "event_type": rng.choice(["view", "conversion"]),
            "user_id": "hot" if i % 3 == 0 else rng.choice(["u", "v", "w", None]),
            "event_time": rng.randrange(0, 40000),
            "utm_params": {"utm_source": f"s{rng.randrange(5)}"},
        }
        for i in range(n)
    ]


def brute_sessions(rows, gap):
    users = {}
    for i, r in enumerate(rows):
        if r["user_id"] is not None:
            users.setdefault(r["user_id"], []).append((r["event_time"], r["event_id"], 0, i, r))
    out = []
    for user, seen in users.items():
        previous = None
        for time, *_, row in sorted(seen, key=lambda s: s[:4]):
            if previous is None or time - previous >= gap:
                out.append((user, f"{user}-{time}", row["utm_params"]["utm_source"], time))
            previous = time
    return sorted(out)


@pytest.mark.parametrize("gap", [1, 60, 900, 100000])
def test_sessions_match_brute_force(spark, gap):
    rows = random_events(300)
    out = sessions.user_sessions(events(spark, *rows), gap).select(
        "user_id", "session_id", "first_touch_channel", F.unix_seconds("session_start")
    )
    assert sorted(map(tuple, out.collect())) == brute_sessions(rows, gap)


@pytest.mark.parametrize("salts", [1, 7])
def test_first_touch_gives_one_row_per_conversion(spark, salts):
    rows = random_events(300)
    table = events(spark, *rows)
    out = attribution.first_touch(table.union(table), sessions.user_sessions(table, 600), salts=salts)
    first = {}
    for user, _, channel, time in brute_sessions(rows, 600):
        if user not in first or time < first[user][0]:
            first[user] = (time, channel)
    expected = sorted(
        (r["event_id"], first[r["user_id"]][1])
        for r in rows
        if r["event_type"] == "conversion" and r["user_id"] is not None
    )
    got = sorted((r.conversion_id, r.attributed_channel) for r in out.collect())
    assert got == expected


def timed(spark, *rows):
    table = spark.createDataFrame(rows, "event_time bigint, event_type string, user_id string")
    return enrich.with_event_timestamp(table)


def test_window_counts(spark):
    rows = timed(spark, (0, "a", "u"), (59, "a", "u"), (60, "a", "v"), (61, "a", None), (61, "b", "v"))
    tumble = stats.tumbling_stats(rows, ["event_type"]).orderBy("window_start", "event_type")
    assert [(r.event_type, r.event_count, r.user_count) for r in tumble.collect()] == [
        ("a", 2, 1), ("a", 2, 1), ("b", 1, 1),
    ]
    hop = stats.hopping_stats(rows.where("event_type = 'a'"), ["event_type"])
    starts = [
        (r.s, r.event_count, r.user_count)
        for r in hop.withColumn("s", F.unix_seconds("window_start")).orderBy("s").collect()
    ]
    assert starts == [(-240, 2, 1), (-180, 4, 2), (-120, 4, 2), (-60, 4, 2), (0, 4, 2), (60, 2, 1)]
    near = stats.approximate_window_stats(rows, ["event_type"]).collect()
    assert sorted((r.event_count, r.user_count) for r in near) == [(1, 1), (2, 1), (2, 1)]


def test_health_report_covers_ten_minutes(spark):
    rows = spark.createDataFrame(
        [(0, 9.0, 9), (60, 1.0, 100), (90, 3.0, None), (660, 5.0, 7)],
        "t bigint, records_per_second double, lag_ms bigint",
    ).withColumn("timestamp", F.timestamp_seconds("t"))
    now = F.timestamp_seconds(F.lit(660))
    out = health.health_report(rows, now).collect()
    assert [tuple(r)[2:] for r in out] == [(4.0, 2.0, 100.0, 100)]
    assert health.health_report(rows).count() == 3


def test_named_items_and_empty_keys(spark):
    rows = events(
        spark,
        click(5, anonymous_id="v", user_id="u", event_id="a"),
        click(5, anonymous_id="", event_id="b"),
        {"anonymous_id": "w", "clid_params": {"h": "1"}},
    )
    out = clicks.named_click_items(rows, "g", clock("1970-01-01 00:00:01")).collect()
    assert [tuple(r) for r in out] == [("v", "g", 5, "u", "1", None, None, 1000, 2592000)]
    assert clicks.click_items(clicks.latest_clicks(rows)).count() == 2
