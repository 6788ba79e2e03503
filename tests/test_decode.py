"""Decode: which records survive, and what a bad field does."""

import json

import pytest
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.maps import clean_map, clean_text, map_with_null_keys
from touchline.operators.decode import decode
from touchline.operators.enrich import with_event_timestamp
from touchline.sources import topics


def decoded(spark, *values, schema=schemas.RAW_EVENTS):
    records = spark.createDataFrame([(v,) for v in values], "value string").coalesce(1)
    return decode(records, schema).collect()


@pytest.mark.parametrize(
    "value",
    ["{bad", "[]", "null", "", "  ", None, '"text"', "12", '[{"event_id":"a"}]',
     '{"event_id":"a","event_time":', '{"event_id":"a","utm_params":{"k":tru}}'],
)
def test_records_that_are_no_object_are_dropped(spark, value):
    assert decoded(spark, value, '{"event_id":"next"}')[0].event_id == "next"


@pytest.mark.parametrize(
    "text, expected",
    [("12", 12), ('"12"', 12), ('" 12 "', 12), ("1.9", 1), ("1e3", 1000), ("-1.9", -1),
     ('"xx"', None), ("null", None), ("true", None), ('""', None), ("{}", None),
     ("9223372036854775807", 2**63 - 1), ("9223372036854775808", None),
     ('"2024-01-01 10:00:00.000"', None)],
)
def test_whole_numbers(spark, text, expected):
    (row,) = decoded(spark, f'{{"event_id":"a","event_time":{text},"user_id":"u"}}')
    assert (row.event_id, row.event_time, row.user_id) == ("a", expected, "u")


def test_missing_unknown_and_nested_fields(spark):
    (row,) = decoded(spark, '\n\t{"event_id":{"q":[1]},"device_id":"d","user_id":7} tail')
    assert (row.event_id, row.user_id, row.event_type) == ('{"q":[1]}', "7", None)
    assert row.utm_params is None


@pytest.mark.parametrize(
    "text, expected",
    [('{"a":5,"b":null,"c":{"q":1},"d":true}', {"a": "5", "b": None, "c": '{"q":1}', "d": "true"}),
     ("{}", {}), ("null", None), ('"text"', None), ("[1]", None),
     ('{"a":"1","a":"2"}', {"a": "2"})],
)
def test_maps(spark, text, expected):
    (row,) = decoded(spark, f'{{"event_id":"a","clid_params":{text},"event_time":3}}')
    assert (row.event_id, row.clid_params, row.event_time) == ("a", expected, 3)


def test_record_with_other_fields_and_text_times(spark):
    record = {
        "event_id": "a", "user_id": "user_1", "device_id": "device_1", "event_type": "click",
        "properties": {"source": "paid"}, "platform": "web",
        "event_time": "2024-01-01 10:00:00.123", "server_time": "2024-01-01 10:00:00.123",
    }
    (row,) = decoded(spark, json.dumps(record))
    assert (row.event_id, row.user_id, row.event_time, row.server_time) == (
        "a", "user_1", None, None,
    )


def test_exposure_fields(spark):
    value = '{"visible_ratio":"0.25","visible_duration_ms":1500,"ext_json":{"a":[1]}}'
    (row,) = decoded(spark, value, schema=schemas.EXPOSURE_EVENTS)
    assert (row.visible_ratio, row.visible_duration_ms, row.ext_json) == (0.25, 1500, '{"a":[1]}')


def test_attributed_fields(spark):
    value = '{"is_attributed":"1","click_time":1700000000,"attribution_window":"7d"}'
    (row,) = decoded(spark, value, schema=schemas.ATTRIBUTED_EVENTS)
    assert (row.is_attributed, row.click_time, row.attribution_window) == (1, 1700000000, "7d")


def test_source_position_is_kept_and_schema_is_exact(spark):
    records = spark.createDataFrame([('{"event_id":"a"}', 2, 7)], schemas.TOPIC_RECORDS)
    events = decode(records, schemas.RAW_EVENTS)
    assert events.columns == [*schemas.RAW_EVENTS.names, "partition", "offset"]
    kinds = {f.name: f.dataType for f in events.schema.fields}
    assert all(kinds[f.name] == f.dataType for f in schemas.RAW_EVENTS.fields)
    row = events.first()
    assert (row.partition, row.offset) == (2, 7)


def test_each_record_is_parsed_once(spark):
    records = spark.createDataFrame([('{"event_id":"a"}',)], "value string")
    events = decode(records, schemas.RAW_EVENTS)
    plan = events._jdf.queryExecution().executedPlan().toString()
    # One full parse; the second is the map test for records flagged malformed.
    assert plan.count("from_json(StructField") == 1
    assert plan.count("from_json(MapType") == 1


def test_json_lines_and_binary_values(spark, folder):
    spark.createDataFrame([('{"event_id":"a"}',), ("{",)], "value string").write.text(
        f"{folder}/lines"
    )
    lines = topics.json_lines(spark, f"{folder}/lines")
    assert [r.event_id for r in decode(lines, schemas.RAW_EVENTS).collect()] == ["a"]
    binary = lines.select(F.col("value").cast("binary").alias("value"))
    assert [r.event_id for r in decode(binary, schemas.RAW_EVENTS).collect()] == ["a"]


def test_event_timestamp(spark):
    rows = with_event_timestamp(spark.createDataFrame([(0,), (None,)], "event_time bigint"))
    values = [r.t for r in rows.select(F.col("event_timestamp").cast("string").alias("t")).collect()]
    assert values == ["1970-01-01 00:00:00", None]


def test_null_map_keys_become_a_literal(spark):
    rows = spark.createDataFrame(
        [([None, "a", "null"], ["1", "2", None]), (["a", "a"], ["1", "2"]), ([], []), (None, None)],
        "k array<string>, v array<string>",
    )
    maps = [r.m for r in rows.select(map_with_null_keys("k", F.col("v")).alias("m")).collect()]
    assert maps == [{"a": "2", "null": None}, {"a": "2"}, {}, None]


def test_cleaning(spark):
    rows = spark.createDataFrame(
        [("", {"a": "", "b": None}), ("x", {"a": "1", "b": ""}), (None, None), ("y", {})],
        "t string, m map<string,string>",
    )
    out = rows.select(clean_text(F.col("t")).alias("t"), clean_map(F.col("m")).alias("m"))
    assert [tuple(r) for r in out.collect()] == [
        (None, None), ("x", {"a": "1"}), (None, None), ("y", None),
    ]


def test_kafka_options():
    options = topics.kafka_options("b:9092", "raw-events", max_records=100,
                                   **{"kafka.security.protocol": "SASL_SSL"})
    assert options == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "raw-events",
        "startingOffsets": "latest", "maxOffsetsPerTrigger": "100",
        "kafka.security.protocol": "SASL_SSL",
    }
