"""Avro without its package: values by column, container files by ranges, messages and landing."""

import io
import json
import random

import numpy as np
import pyarrow as pa
import pytest

from tierline import DatasetSpec, Field, jobs, sources
from tierline.functions import avro
from tierline.plans import jobs as plans

from .conftest import rows

RECORD = json.dumps({"type": "record", "name": "r", "fields": [
    {"name": "id", "type": "long"}, {"name": "n", "type": ["null", "int"]}, {"name": "f", "type": "float"}, {"name": "d", "type": ["double", "null"]},
    {"name": "s", "type": "string"}, {"name": "b", "type": "bytes"}, {"name": "ok", "type": "boolean"},
    {"name": "e", "type": {"type": "enum", "name": "e", "symbols": ["A", "B"]}}, {"name": "x", "type": {"type": "fixed", "name": "x", "size": 3}},
    {"name": "l", "type": {"type": "array", "items": ["null", "string"]}}, {"name": "m", "type": {"type": "map", "values": "long"}},
    {"name": "in", "type": {"type": "record", "name": "i", "fields": [{"name": "ll", "type": {"type": "array", "items": {"type": "array", "items": "int"}}}]}},
    {"name": "t", "type": {"type": "long", "logicalType": "timestamp-millis"}}, {"name": "day", "type": {"type": "int", "logicalType": "date"}},
    {"name": "w", "type": ["int", "long"]},
]})


def record(rng, i):
    return {
        "id": rng.choice([0, -1, 1, 2**62, -(2**63), 2**63 - 1, i]), "n": rng.choice([None, 5, -(2**31)]), "f": 0.5, "d": rng.choice([None, 1e300]),
        "s": rng.choice(["", "é" * 70, "x"]), "b": bytes(rng.randrange(256) for _ in range(rng.choice([0, 3, 200]))), "ok": rng.random() < 0.5,
        "e": rng.choice("AB"), "x": b"\x00\xff\x01", "l": [rng.choice([None, "q", ""]) for _ in range(rng.choice([0, 1, 5]))],
        "m": {f"k{j}": j for j in range(rng.choice([0, 2]))}, "in": {"ll": [[1] * rng.randrange(3) for _ in range(rng.randrange(4))]},
        "t": 1704445200123 + i, "day": 19000 + i, "w": 7,
    }


def plain(value):
    """What a decoded record is as a row that was encoded."""
    row = dict(value)
    row["t"], row["day"], row["m"] = int(row["t"].timestamp() * 1000 + 0.5), (row["day"] - row["day"].replace(1970, 1, 1)).days, dict(row["m"])
    return row


def encoded(values):
    node = json.loads(RECORD)
    node["fields"][-1]["type"] = ["int", "long"]
    return [None if v is None else avro.encode(v, node) for v in values]


@pytest.mark.parametrize("seed", range(5))
def test_messages_come_back(seed):
    rng = random.Random(seed)
    values = [None if rng.random() < 0.2 else record(rng, i) for i in range(rng.choice([0, 1, 60]))]
    messages = pa.array([v if v is None else v + b"more" for v in encoded(values)], pa.binary())
    found = avro.decode_messages(messages, RECORD)
    assert [v and plain(v) for v in found.to_pylist()] == values
    assert [v and plain(v) for v in avro.decode_messages(messages.slice(1), RECORD).to_pylist()] == values[1:]


def test_blocks_of_items_with_their_sizes_and_in_several_parts():
    data = avro._number(-2) + avro._number(4) + b"\x02\x04" + avro._number(1) + b"\x06" + b"\0"
    found, after = avro.decode(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]), {"type": "array", "items": "int"})
    assert found.to_pylist() == [[1, 2, 3]] and after[0] == len(data)


def test_what_is_not_as_the_schema_says_is_refused():
    rng = random.Random(1)
    good = encoded([record(rng, 1)])[0]
    for cut in range(len(good)):
        with pytest.raises(avro.Malformed):
            avro.decode_messages(pa.array([good, good[:cut]], pa.binary()), RECORD)
    for kind, data in (("int", avro._number(2**40)), ("long", b"\xff" * 11), ("boolean", b"\x02"), ("string", b"\x02\xff"), (["null", "int"], b"\x04"), ("bytes", b"\x01")):
        with pytest.raises(avro.Malformed):
            avro.decode(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]), kind)


@pytest.mark.parametrize("codec", ["null", "deflate", "snappy", "zstandard"])
def test_ranges_of_a_file_hold_each_row_once(codec):
    rng = random.Random(4)
    values = [record(rng, i) for i in range(90)]
    data = avro.container(values, RECORD, codec, block_rows=7)
    for size in (1, 50, 1000, len(data)):
        found = []
        for start in range(0, len(data), size):
            held = list(avro.blocks(io.BytesIO(data), start, start + size))
            found += avro.rows_of_blocks(held, RECORD).to_pylist() if held else []
        assert sorted(map(repr, map(plain, found))) == sorted(map(repr, values))
    with pytest.raises(avro.Malformed):
        list(avro.blocks(io.BytesIO(data[:-1]), 0, len(data)))
    with pytest.raises(avro.Malformed):
        avro.header(io.BytesIO(b"PAR1" + data))


def avro_schema(*fields):
    return json.dumps({"type": "record", "name": "r", "fields": [{"name": n, "type": t} for n, t in fields]})


def write(place, name, values, schema):
    import os

    os.makedirs(os.path.dirname(place(name)), exist_ok=True)
    with open(place(name), "wb") as file:
        file.write(avro.container(values, schema, block_rows=2))


def test_landing_of_changing_writers(spark, place):
    spec = DatasetSpec(
        name="a", format="avro", landing=place("landing"), raw=place("raw"), archive=place("archive"), checkpoint=place("check"), mode="append",
        fields=(Field("id"), Field("n", "bigint"), Field("gone", "double")), evolution="add_new_columns",
    )
    write(place, "landing/a +b.avro", [{"id": "1", "n": 5}, {"id": "2", "n": 6}, {"id": "3", "n": 7}], avro_schema(("id", "string"), ("n", "int")))
    jobs.landing_to_raw(spark, spec)
    write(place, "landing/c.avro", [{"new": [1.5], "N": 9, "id": "4"}], avro_schema(("new", {"type": "array", "items": "double"}), ("N", "long"), ("id", "string")))
    assert jobs.landing_to_raw(spark, spec).rows == 1
    raw = sources.read_raw(spark, spec)
    assert rows(raw, "id", "n", "gone", "new") == [("1", 5, None, None), ("2", 6, None, None), ("3", 7, None, None), ("4", 9, None, [1.5])]
    assert {r.source_filename.rsplit("/", 1)[1] for r in raw.collect()} == {"a%20+b.avro", "c.avro"}
    fixed = sources.read_files(spark, spec.with_(evolution="none"), [place("archive/c.avro")])
    assert fixed.columns == ["id", "n", "gone", "source_filename"] and rows(fixed, "id", "n", "gone") == [("4", 9, None)]
    write(place, "landing/d.avro", [], avro_schema(("id", "string")))
    assert jobs.landing_to_raw(spark, spec).status == "ok"
    with open(place("landing/e.avro"), "wb") as file:
        file.write(b"Obj\x01not a header")
    with pytest.raises(Exception, match="Malformed|malformed|cut short"):
        jobs.landing_to_raw(spark, spec)


def test_messages_in_avro_reach_raw_and_bad_ones_fail(spark, place):
    schema = avro_schema(("id", "long"), ("name", ["null", "string"]), ("at", {"type": "long", "logicalType": "timestamp-millis"}))
    node = json.loads(schema)
    spec = DatasetSpec(
        name="m", kind="messages", raw=place("raw"), checkpoint=place("check"), message_format="parquet", message_options={"path": place("topic")},
        avro_schema=schema, codec="avro", partition_by=("ingestion_date", "kafka_topic"),
    )

    def send(values):
        data = [(b"k", v, "t", 0, i, None, 0) for i, v in enumerate(values)]
        spark.createDataFrame(data, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int").write.mode("append").parquet(place("topic"))

    send([avro.encode({"id": i, "name": None if i % 2 else "x", "at": 1704445200000 + i}, node) for i in range(5)])
    assert plans.JOBS["messages_to_raw"](spark, spec).rows == 5
    raw = sources.read_raw(spark, spec)
    assert rows(raw.selectExpr("id", "name", "unix_millis(at) - 1704445200000")) == [(i, None if i % 2 else "x", i) for i in range(5)]
    send([b"\x02"])
    with pytest.raises(Exception, match="cut short"):
        plans.JOBS["messages_to_raw"](spark, spec)


def test_a_container_is_made_a_block_at_a_time():
    taken = []

    def values():
        for i in range(1000):
            taken.append(i)
            yield {"n": i}

    schema = json.dumps({"type": "record", "name": "R", "fields": [{"name": "n", "type": "long"}]})
    parts = avro.container_parts(values(), schema, block_rows=10)
    head, first = next(parts), next(parts)
    assert len(taken) == 10
    assert head + first + b"".join(parts) == avro.container([{"n": i} for i in range(1000)], schema, block_rows=10)
