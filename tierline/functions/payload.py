"""Message payloads: envelope (P6), decoding (P7), flattening."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline import storage
from tierline.functions import avro
from tierline.functions import schema as schemas

PAYLOAD = "payload"

MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

# The envelope columns of the raw layer.
ENVELOPE = (
    "kafka_key",
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
    "kafka_timestamp",
    "kafka_timestampType",
    "ingestion_timestamp_raw",
)


def envelope(messages: DataFrame) -> DataFrame:
    """Name the message metadata and stamp the ingestion moment; ``value`` stays encoded."""
    return messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("timestampType").alias("kafka_timestampType"),
        F.current_timestamp().alias("ingestion_timestamp_raw"),
        "value",
    )


def decode(df: DataFrame, avro_schema: str, codec: str = "avro") -> DataFrame:
    """``value`` becomes the ``payload`` struct; a malformed message fails the query."""
    if codec == "avro":
        if storage.has_source(df.sparkSession, "avro"):
            from pyspark.sql.avro.functions import from_avro

            payload = from_avro(F.col("value"), avro_schema, {"mode": "FAILFAST"})
        else:
            payload = _by_arrow(avro_schema)(F.col("value"))
    elif codec == "json":
        record = schemas.parse_avro_json(avro_schema)
        wire = F.from_json(F.col("value").cast("string"), _wire_type(record), {"mode": "FAILFAST"})
        df = df.withColumn("value", wire)
        payload = _from_wire(F.col("value"), record) if _converts(record) else F.col("value")
    else:
        raise ValueError(f"codec must be avro or json, not {codec!r}")
    return df.withColumn(PAYLOAD, payload).drop("value")


def _by_arrow(avro_schema: str):
    from pyspark.sql.functions import arrow_udf

    kind = schemas.from_avro_json(avro_schema)

    @arrow_udf(kind)
    def decoded(values: pa.Array) -> pa.Array:
        return avro.decode_messages(values, avro_schema)

    return decoded


def payload_names(avro_schema: str) -> dict[str, str]:
    """Payload field to its raw column; a field named like an envelope column gets a prefix."""
    fields = schemas.from_avro_json(avro_schema).names
    named = {f: f"payload_{f}" if f in ENVELOPE else f for f in fields}
    if len(set(named.values())) != len(named):
        raise ValueError(f"payload fields collide after renaming: {sorted(named.values())}")
    return named


def flatten(df: DataFrame, avro_schema: str) -> DataFrame:
    """Envelope columns, then the payload's fields as columns."""
    fields = [F.col(f"{PAYLOAD}.`{f}`").alias(name) for f, name in payload_names(avro_schema).items()]
    return df.select(*ENVELOPE, *fields)


def raw_schema(avro_schema: str, partition_by=()) -> T.StructType:
    """The raw layer's schema of a message dataset, known without reading a file."""
    metadata = [
        T.StructField("kafka_key", T.StringType()),
        T.StructField("kafka_topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("kafka_timestampType", T.IntegerType()),
        T.StructField("ingestion_timestamp_raw", T.TimestampType()),
    ]
    names = payload_names(avro_schema)
    fields = [T.StructField(names[f.name], f.dataType) for f in schemas.from_avro_json(avro_schema)]
    day = [T.StructField("ingestion_date", T.DateType())] if "ingestion_date" in partition_by else []
    return schemas.merge([T.StructType(metadata + fields + day)], partition_by)


# In JSON a logical timestamp or date travels as its Avro number, so it is read as that
# number and converted, at any depth.
_NUMERIC_LOGICAL = {
    "timestamp-millis": F.timestamp_millis,
    "timestamp-micros": F.timestamp_micros,
    "local-timestamp-millis": lambda c: F.timestamp_millis(c).cast("timestamp_ntz"),
    "local-timestamp-micros": lambda c: F.timestamp_micros(c).cast("timestamp_ntz"),
    "date": F.date_from_unix_date,
}


def _wire_type(node) -> T.DataType:
    node = schemas.avro_core(node)
    if node.get("logicalType") in _NUMERIC_LOGICAL:
        return T.IntegerType() if node["logicalType"] == "date" else T.LongType()
    if node["type"] == "record":
        return T.StructType([T.StructField(f["name"], _wire_type(f["type"])) for f in node["fields"]])
    if node["type"] == "array":
        return T.ArrayType(_wire_type(node["items"]))
    if node["type"] == "map":
        return T.MapType(T.StringType(), _wire_type(node["values"]))
    return schemas.avro_type(node)


def _converts(node) -> bool:
    node = schemas.avro_core(node)
    if node["type"] == "record":
        return any(_converts(f["type"]) for f in node["fields"])
    if node["type"] in ("array", "map"):
        return _converts(node["items" if node["type"] == "array" else "values"])
    return node.get("logicalType") in _NUMERIC_LOGICAL


def _from_wire(value: Column, node) -> Column:
    node = schemas.avro_core(node)
    if not _converts(node):
        return value
    if node["type"] == "record":
        converted = value
        for f in node["fields"]:
            if _converts(f["type"]):
                converted = converted.withField(f"`{f['name']}`", _from_wire(value.getField(f["name"]), f["type"]))
        return converted
    if node["type"] == "array":
        return F.transform(value, lambda item: _from_wire(item, node["items"]))
    if node["type"] == "map":
        return F.transform_values(value, lambda _, item: _from_wire(item, node["values"]))
    return _NUMERIC_LOGICAL[node["logicalType"]](value)
