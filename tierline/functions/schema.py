"""Schemas from declarations: configured fields (H1), message schemas (H6), timestamp patterns (H7)."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

from tierline.spec import Field, SpecError

# The declared type vocabulary.
DECLARED_TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}

DEFAULT_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Avro primitive and logical type names.
_AVRO_PRIMITIVES = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}
_AVRO_LOGICAL = {
    "date": T.DateType(),
    "timestamp-millis": T.TimestampType(),
    "timestamp-micros": T.TimestampType(),
    "local-timestamp-millis": T.TimestampNTZType(),
    "local-timestamp-micros": T.TimestampNTZType(),
}


def declared_type(name: str) -> T.DataType:
    """The Spark type of a declared type name; any Spark DDL type is accepted."""
    known = DECLARED_TYPES.get(name.lower())
    if known is not None:
        return known
    try:
        return T.StructType.fromDDL(f"c {name}")[0].dataType
    except Exception as error:
        raise SpecError(f"unknown column type {name!r}") from error


def from_fields(fields: Iterable[Field]) -> T.StructType | None:
    """H1: the schema of the declared fields, all nullable; ``None`` when none are declared."""
    columns = [T.StructField(f.name, declared_type(f.type), True) for f in fields]
    return T.StructType(columns) if columns else None


@dataclass(frozen=True)
class TimestampPlan:
    """How declared timestamps are parsed: by the reader, or as text afterwards."""

    schema: T.StructType
    reader_format: str | None
    parse_after: Mapping[str, str]


def timestamp_formats(fields: Iterable[Field], options: Mapping[str, str]) -> TimestampPlan | None:
    """H7: one pattern is left to the reader; several are parsed per column after the read.

    A ``timestampFormat`` already among the reader options applies to every field.
    """
    fields = tuple(fields)
    schema = from_fields(fields)
    if schema is None:
        return None
    stamps = [f for f in fields if isinstance(schema[f.name].dataType, T.TimestampType)]
    if "timestampFormat" in options:
        return TimestampPlan(schema, options["timestampFormat"], {})
    formats = {f.name: f.format or DEFAULT_TIMESTAMP_FORMAT for f in stamps}
    if len(set(formats.values())) <= 1:
        return TimestampPlan(schema, next(iter(formats.values()), DEFAULT_TIMESTAMP_FORMAT), {})
    as_text = T.StructType([T.StructField(c.name, T.StringType()) if c.name in formats else c for c in schema])
    return TimestampPlan(as_text, None, formats)


def parse_avro_json(text: str) -> dict:
    """The message schema as a dict; it must describe a record."""
    try:
        parsed = json.loads(text)
    except json.JSONDecodeError as error:
        raise SpecError("the message schema is not valid JSON") from error
    if not isinstance(parsed, dict) or parsed.get("type") != "record":
        raise SpecError("the message schema must be a record")
    return parsed


def from_avro_json(text: str) -> T.StructType:
    """H6: the Spark schema of a message schema given as Avro JSON."""
    return avro_type(parse_avro_json(text))


def avro_type(node) -> T.DataType:
    """The Spark type of one Avro schema node."""
    if isinstance(node, list):
        return avro_type(_union_member(node))
    if isinstance(node, str):
        node = {"type": node}
    kind = node["type"]
    if isinstance(kind, (dict, list)):
        return avro_type(kind)
    logical = node.get("logicalType")
    if logical == "decimal":
        return T.DecimalType(node["precision"], node.get("scale", 0))
    if logical in _AVRO_LOGICAL:
        return _AVRO_LOGICAL[logical]
    if kind == "record":
        # logicalType written beside a field's "type" belongs to the field, not to the type.
        return T.StructType([T.StructField(f["name"], avro_type(f["type"]), True) for f in node["fields"]])
    if kind == "array":
        return T.ArrayType(avro_type(node["items"]))
    if kind == "map":
        return T.MapType(T.StringType(), avro_type(node["values"]))
    if kind == "enum":
        return T.StringType()
    if kind == "fixed":
        return T.BinaryType()
    if kind in _AVRO_PRIMITIVES:
        return _AVRO_PRIMITIVES[kind]
    raise SpecError(f"unsupported Avro type {kind!r}")


def avro_core(node):
    """The node that decides a value's type: nullable unions and nested ``type`` unwrapped."""
    if isinstance(node, list):
        return avro_core(_union_member(node))
    if isinstance(node, str):
        return {"type": node}
    return avro_core(node["type"]) if isinstance(node["type"], (dict, list)) else node


def _union_member(members: list):
    present = [m for m in members if m != "null"]
    if len(present) == 1:
        return present[0]
    if set(map(str, present)) == {"int", "long"}:
        return "long"
    if set(map(str, present)) == {"float", "double"}:
        return "double"
    raise SpecError(f"unsupported Avro union {members}")


class SchemaConflict(ValueError):
    """Two writes give one column different types."""


def merge(schemas: Iterable[T.StructType], partition_by: Iterable[str] = ()) -> T.StructType:
    """Columns of all schemas in order of first appearance, partition columns last.

    Structs are merged field by field, at any depth. Everything becomes nullable, as what one
    schema has may be missing under another.
    """
    merged: dict[str, T.StructField] = {}
    for schema in schemas:
        for column in schema.fields:
            seen = merged.get(column.name.lower())
            name, kind = (seen.name, seen.dataType) if seen else (column.name, column.dataType)
            merged[column.name.lower()] = T.StructField(name, _unite(kind, column.dataType, column.name), True)
    last = {name.lower() for name in partition_by}
    columns = list(merged.items())
    return T.StructType([c for n, c in columns if n not in last] + [merged[n] for n in map(str.lower, partition_by) if n in merged])


def _unite(stored: T.DataType, new: T.DataType, name: str) -> T.DataType:
    if isinstance(stored, T.StructType) and isinstance(new, T.StructType):
        return merge([stored, new])
    if isinstance(stored, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_unite(stored.elementType, new.elementType, name), True)
    if isinstance(stored, T.MapType) and isinstance(new, T.MapType) and stored.keyType == new.keyType:
        return T.MapType(stored.keyType, _unite(stored.valueType, new.valueType, name), True)
    if stored != new:
        raise SchemaConflict(f"column {name!r} is {new.simpleString()} here but {stored.simpleString()} in what is already stored")
    return stored
