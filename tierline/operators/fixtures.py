"""Landing files and messages made from a table's rows."""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions import avro
from tierline.listing import Files


def land(df: DataFrame, landing: str, fmt: str) -> None:
    """Add rows to a landing directory as files of ``fmt``."""
    options = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"} if fmt == "csv" else {}
    df.write.mode("append").format(fmt).options(**options).save(landing)


def as_messages(df: DataFrame, topic: str | Column, key: str, offset: str) -> DataFrame:
    """Rows as keyed messages with a JSON payload, in the columns a topic has."""
    payload = [c for c in df.columns if c != offset]
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*payload)).cast("binary").alias("value"),
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col(offset).cast("long").alias("offset"),
        F.timestamp_seconds(F.lit(1735689600)).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def avro_payload(messages: DataFrame, avro_schema: str) -> DataFrame:
    """Messages with a JSON payload, the payload in Avro."""
    node = json.loads(avro_schema)
    names = [f["name"] for f in node["fields"]]

    @F.arrow_udf("binary")
    def encoded(values: pa.Array) -> pa.Array:
        return pa.array([avro.encode({**dict.fromkeys(names), **json.loads(v)}, node) for v in values.to_pylist()], pa.binary())

    return messages.withColumn("value", encoded("value"))


def land_avro(df: DataFrame, landing: str, avro_schema: str) -> None:
    """Rows, times in them as numbers, as Avro container files of a landing directory; each task writes one, block by block."""

    def write(batches):
        rows = (row for batch in batches for row in batch.to_pylist())
        path = f"{landing.rstrip('/')}/{uuid.uuid4().hex}.avro"
        Files(path).write(path, avro.container_parts(rows, avro_schema))
        yield pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

    df.mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()
