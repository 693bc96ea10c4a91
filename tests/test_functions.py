"""Pure functions: schemas, derivations, payloads."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tierline import derive, payload, schema
from tierline.spec import Field, SpecError

from .conftest import rows

TELEMETRY = json.dumps({
    "type": "record", "name": "T", "fields": [
        {"name": "sensor_id", "type": {"type": "string", "arg.properties": {"regex": "x"}}},
        {"name": "timestamp", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "plain", "type": "long", "logicalType": "timestamp-millis"},
        {"name": "temperature", "type": ["null", "float"], "default": None},
        {"name": "tags", "type": {"type": "array", "items": {"type": "long", "logicalType": "timestamp-millis"}}},
        {"name": "days", "type": {"type": "map", "values": {"type": "int", "logicalType": "date"}}},
        {"name": "inner", "type": {"type": "record", "name": "I", "fields": [{"name": "at", "type": {"type": "long", "logicalType": "timestamp-micros"}}]}},
        {"name": "kafka_topic", "type": "string"},
    ],
})


def test_fields_to_schema(spark):
    got = schema.from_fields([Field("a"), Field("b", "INTEGER"), Field("c", "double"), Field("d", "timestamp"), Field("e", "decimal(10,2)")])
    assert got.simpleString() == "struct<a:string,b:int,c:double,d:timestamp,e:decimal(10,2)>"
    assert all(f.nullable for f in got)
    assert schema.from_fields([]) is None
    with pytest.raises(SpecError):
        schema.from_fields([Field("a", "nonsense")])


def test_avro_schema():
    got = schema.from_avro_json(TELEMETRY)
    assert got.simpleString() == (
        "struct<sensor_id:string,timestamp:timestamp,plain:bigint,temperature:float,"
        "tags:array<timestamp>,days:map<string,date>,inner:struct<at:timestamp>,kafka_topic:string>"
    )
    for bad in ("nonsense", '{"type":"int"}', '{"type":"record","name":"r","fields":[{"name":"a","type":["int","string"]}]}'):
        with pytest.raises(SpecError):
            schema.from_avro_json(bad)


def test_merge_orders_and_refuses_conflicts(spark):
    from pyspark.sql import types as T

    a = T.StructType().add("x", "integer").add("p", "integer")
    b = T.StructType().add("x", "integer").add("y", "string").add("p", "integer")
    assert schema.merge([a, b], ["p"]).names == ["x", "y", "p"]
    nested = [T.StructType.fromDDL(d) for d in ("s struct<a:int,l:array<struct<b:int>>>", "s struct<c:string,l:array<struct<d:int>>>")]
    assert schema.merge(nested).simpleString() == "struct<s:struct<a:int,l:array<struct<b:int,d:int>>,c:string>>"
    with pytest.raises(schema.SchemaConflict, match="X"):
        schema.merge([a, T.StructType().add("X", "string")])


@pytest.mark.parametrize("value,kind,unit,expected", [
    ("2024-01-31 10:00:00", "string", "seconds", datetime(2024, 1, 31, 10)),
    ("nonsense", "string", "seconds", None),
    (1_700_000_000, "bigint", "seconds", datetime(2023, 11, 14, 22, 13, 20)),
    (1_700_000_000_000, "bigint", "millis", datetime(2023, 11, 14, 22, 13, 20)),
    (1_700_000_000_000_000, "bigint", "micros", datetime(2023, 11, 14, 22, 13, 20)),
    (9_223_372_036_854_775_807, "bigint", "seconds", None),
    (1.5, "double", "seconds", datetime(1970, 1, 1, 0, 0, 1, 500000)),
    (None, "string", "seconds", None),
])
def test_ensure_timestamp(spark, value, kind, unit, expected):
    df = spark.createDataFrame([(value,)], f"t {kind}")
    assert derive.ensure_timestamp(df, "t", unit).first().t == expected


def test_ensure_timestamp_leaves_temporal_columns(spark):
    df = spark.sql("select date'2024-01-01' as a, timestamp_ntz'2024-01-01 00:00:00' as b, timestamp'2024-01-01 00:00:00' as c")
    for name in df.columns:
        assert derive.ensure_timestamp(df, name).schema == df.schema
    with pytest.raises(TypeError):
        derive.ensure_timestamp(spark.sql("select true as a"), "a")


def test_date_parts(spark):
    df = spark.createDataFrame([("2024-02-29 01:00:00",), ("bad",)], "t string")
    got = derive.date_parts(df, "t", {"y": "year", "m": "month", "d": "day"})
    assert rows(got, "y", "m", "d") == [(2024, 2, 29), (None, None, None)]
    assert derive.date_parts(df, "absent", {"y": "year"}).columns == ["t"]
    assert derive.listed_parts(["day", "region"]) == {"day": "day"}


def test_envelope_decode_flatten(spark):
    text = json.dumps({
        "sensor_id": "s", "timestamp": 1_700_000_000_000, "plain": 5, "temperature": 1.5, "tags": [0, 1000], "days": {"a": 1},
        "inner": {"at": 1_000_000}, "kafka_topic": "mine",
    })
    messages = spark.createDataFrame(
        [(b"k", text.encode(), "topic", 1, 2, datetime(2024, 1, 1), 0), (None, None, "topic", 1, 3, datetime(2024, 1, 1), 0)],
        payload.MESSAGE_SCHEMA,
    )
    flat = payload.flatten(payload.decode(payload.envelope(messages), TELEMETRY, "json"), TELEMETRY)
    assert flat.columns[:7] == list(payload.ENVELOPE) and flat.columns[-1] == "payload_kafka_topic"
    first, second = flat.orderBy("kafka_offset").collect()
    assert (first.kafka_key, first.kafka_topic, first.payload_kafka_topic) == ("k", "topic", "mine")
    assert (first.timestamp, first.plain) == (datetime(2023, 11, 14, 22, 13, 20), 5)
    assert first.tags == [datetime(1970, 1, 1), datetime(1970, 1, 1, 0, 0, 1)]
    assert first.days == {"a": date(1970, 1, 2)} and first.inner.at == datetime(1970, 1, 1, 0, 0, 1)
    assert second.sensor_id is None and second.kafka_offset == 3
    by_day = derive.ingestion_day(flat, ["ingestion_date"])
    assert dict(by_day.dtypes)["ingestion_date"] == "date" and derive.ingestion_day(flat, ["kafka_topic"]) is flat
    assert payload.raw_schema(TELEMETRY, ["ingestion_date", "kafka_topic"]).names == [
        *[c for c in flat.columns if c != "kafka_topic"], "ingestion_date", "kafka_topic"
    ]


def test_malformed_payload_fails(spark):
    messages = spark.createDataFrame([(b"k", b"{not json", "t", 0, 0, datetime(2024, 1, 1), 0)], payload.MESSAGE_SCHEMA)
    with pytest.raises(Exception, match="MALFORMED"):
        payload.flatten(payload.decode(payload.envelope(messages), TELEMETRY, "json"), TELEMETRY).collect()


def test_json_payload_is_parsed_once(spark):
    messages = spark.createDataFrame([], payload.MESSAGE_SCHEMA)
    flat = payload.flatten(payload.decode(payload.envelope(messages), TELEMETRY, "json"), TELEMETRY)
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 1


def test_basename(spark):
    from tierline import ledger

    df = spark.createDataFrame([("file:///l/a%20b+c%25.csv",)], "u string")
    assert df.select(ledger.basename(F.col("u"))).first()[0] == "a b+c%.csv"
