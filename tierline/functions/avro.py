"""Avro binary on Arrow batches (P7, S4), for sessions without Spark's Avro package.

Values are decoded a column at a time: an array of cursors, one for each message or block, moves over the
bytes, and every step reads one field at all cursors. What is cut short, or is not what the schema says, fails.
"""

from __future__ import annotations

import decimal
import json
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tierline.functions import schema as schemas

MAGIC = b"Obj\x01"


class Malformed(ValueError):
    """Bytes that do not hold what their schema says."""


def _need(fine: bool | np.bool_, what: str) -> None:
    if not fine:
        raise Malformed(what)


def _longs(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The zigzag number at each cursor, and the cursors after it."""
    value, at, live = np.zeros(len(at), np.uint64), at.copy(), np.arange(len(at))
    for shift in range(0, 70, 7):
        _need((at[live] < end[live]).all(), "a number is cut short")
        byte = data[at[live]]
        value[live] |= (byte & 0x7F).astype(np.uint64) << np.uint64(shift)
        at[live] += 1
        live = live[byte > 127]
        if not len(live):
            return (value >> np.uint64(1)).astype(np.int64) ^ -(value & np.uint64(1)).astype(np.int64), at
    raise Malformed("a number has more than ten bytes")


def _slices(data: np.ndarray, at: np.ndarray, end: np.ndarray, size: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """``size`` bytes at each cursor."""
    _need((size >= 0).all() and (at + size <= end).all(), "bytes are cut short")
    offsets = np.concatenate([[0], np.cumsum(size)])
    inner = data[np.repeat(at - offsets[:-1], size) + np.arange(offsets[-1])]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(inner)]), at + size


def _fixed_width(data, at, end, kind: str) -> tuple[np.ndarray, np.ndarray]:
    size = np.dtype(kind).itemsize
    _need((at + size <= end).all(), "a number is cut short")
    return data[at[:, None] + np.arange(size)].view(kind).ravel(), at + size


_STAMPS = {"timestamp-millis": (1000, "UTC"), "timestamp-micros": (1, "UTC"), "local-timestamp-millis": (1000, None), "local-timestamp-micros": (1, None)}


def decode(data: np.ndarray, at: np.ndarray, end: np.ndarray, node) -> tuple[pa.Array, np.ndarray]:
    """The value at each cursor that schema ``node`` describes, and the cursors after it."""
    if isinstance(node, list):
        return _union(data, at, end, node)
    if isinstance(node, str):
        node = {"type": node}
    kind, logical = node["type"], node.get("logicalType")
    if isinstance(kind, (dict, list)):
        return decode(data, at, end, kind)
    if kind == "record":
        columns = []
        for field in node["fields"]:
            column, at = decode(data, at, end, field["type"])
            columns.append(column)
        return pa.StructArray.from_arrays(columns, [f["name"] for f in node["fields"]]), at
    if kind in ("array", "map"):
        return _repeated(data, at, end, node)
    if kind == "null":
        return pa.nulls(len(at)), at
    if kind == "boolean":
        byte, at = _fixed_width(data, at, end, "u1")
        _need((byte < 2).all(), "a boolean is neither 0 nor 1")
        return pa.array(byte.astype(bool)), at
    if kind in ("float", "double"):
        value, at = _fixed_width(data, at, end, "<f4" if kind == "float" else "<f8")
        return pa.array(value), at
    if kind in ("int", "long"):
        value, at = _longs(data, at, end)
        if logical in _STAMPS:
            scale, zone = _STAMPS[logical]
            return pa.array(value * scale).cast(pa.timestamp("us", tz=zone)), at
        if kind == "int":
            _need((value == value.astype(np.int32)).all(), "an int has more than 32 bits")
            return pa.array(value.astype(np.int32)).cast(pa.date32() if logical == "date" else pa.int32()), at
        return pa.array(value), at
    if kind == "enum":
        value, at = _longs(data, at, end)
        _need(((value >= 0) & (value < len(node["symbols"]))).all(), "no such enum symbol")
        return pa.array(node["symbols"], pa.string()).take(pa.array(value)), at
    if kind in ("bytes", "string", "fixed"):
        size, at = (np.full(len(at), node["size"]), at) if kind == "fixed" else _longs(data, at, end)
        value, at = _slices(data, at, end, size)
        if logical == "decimal":
            scale = node.get("scale", 0)
            exact = [decimal.Decimal(int.from_bytes(v.as_py(), "big", signed=True)).scaleb(-scale, decimal.Context(prec=60)) for v in value]
            return pa.array(exact, pa.decimal128(node["precision"], scale)), at
        try:
            return value.cast(pa.large_string()).cast(pa.string()) if kind == "string" else value.cast(pa.binary()), at
        except pa.ArrowInvalid as error:
            raise Malformed("a string is not UTF-8") from error
    raise schemas.SpecError(f"unsupported Avro type {kind!r}")


def _union(data, at, end, members: list) -> tuple[pa.Array, np.ndarray]:
    which, at = _longs(data, at, end)
    _need(((which >= 0) & (which < len(members))).all(), "no such branch of a union")
    parts, place, count = [], np.empty(len(at), np.int64), 0
    kind = arrow_type(members)
    at = at.copy()
    for number, member in enumerate(members):
        rows = np.flatnonzero(which == number)
        value, after = decode(data, at[rows], end[rows], member)
        at[rows] = after
        parts.append(pa.nulls(len(rows), kind) if value.type == pa.null() else value.cast(kind))
        place[rows] = count + np.arange(len(rows))
        count += len(rows)
    return pa.concat_arrays(parts).take(pa.array(place)), at


def _repeated(data, at, end, node) -> tuple[pa.Array, np.ndarray]:
    """Arrays and maps: blocks of counted items until an empty block."""
    inner = {"type": "record", "fields": [{"name": "key", "type": "string"}, {"name": "value", "type": node.get("values")}]}
    inner = inner if node["type"] == "map" else node["items"]
    at, live = at.copy(), np.arange(len(at))
    parts, owners = [decode(data, at[:0], end[:0], inner)[0]], [np.zeros(0, np.int64)]
    while len(live):
        count, at[live] = _longs(data, at[live], end[live])
        sized = live[count < 0]
        _, at[sized] = _longs(data, at[sized], end[sized])
        count = np.abs(count)
        live, count = live[count > 0], count[count > 0]
        left = count.copy()
        while (left > 0).any():
            some = live[left > 0]
            value, at[some] = decode(data, at[some], end[some], inner)
            _need((at[some] <= end[some]).all() and left.max() <= len(data), "more items than bytes")
            parts.append(value)
            owners.append(some)
            left[left > 0] -= 1
    owner = np.concatenate(owners)
    values = pa.concat_arrays(parts).take(pa.array(np.argsort(owner, kind="stable")))
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(at)))]).astype(np.int32))
    if node["type"] == "map":
        return pa.MapArray.from_arrays(offsets, values.field("key"), values.field("value")), at
    return pa.ListArray.from_arrays(offsets, values), at


def arrow_type(node) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(schemas.avro_type(node), timestamp_utc=True)


def decode_messages(values: pa.Array, schema: str) -> pa.Array:
    """Payloads as structs, null ones as null; what follows a record in its message is not looked at."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    there = pc.indices_nonzero(values.is_valid()).to_numpy()
    values = values.cast(pa.large_binary())
    present = values.take(pa.array(there)) if len(there) < len(values) else values
    raw = present.buffers()[2]
    offsets = np.frombuffer(present.buffers()[1], np.int64)[present.offset : present.offset + len(present) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    node = schemas.parse_avro_json(schema)
    found, _ = decode(data, offsets[:-1], offsets[1:], node)
    found = found.cast(arrow_type(node))
    if len(present) == len(values):
        return found
    place = np.zeros(len(values), np.int64)
    place[there] = np.arange(len(there))
    return found.take(pa.array(place, mask=~values.is_valid().to_numpy(zero_copy_only=False)))


# --- container files -----------------------------------------------------------------------


def _one_long(data: bytes, at: int) -> tuple[int, int]:
    value, after = _longs(np.frombuffer(data, np.uint8), np.array([at]), np.array([len(data)]))
    return int(value[0]), int(after[0])


def header(file) -> tuple[str, str, bytes, int]:
    """Schema, codec and sync marker of a container file, and where its first block begins."""
    file.seek(0)
    data, size = file.read(1 << 16), 1 << 16
    while True:
        try:
            _need(data[:4] == MAGIC, "not an Avro container file")
            meta, after = decode(np.frombuffer(data, np.uint8), np.array([4]), np.array([len(data)]), {"type": "map", "values": "bytes"})
            at = int(after[0])
            _need(at + 16 <= len(data), "the header is cut short")
            facts = dict(meta[0].as_py())
            return facts["avro.schema"].decode(), facts.get("avro.codec", b"null").decode(), data[at : at + 16], at + 16
        except Malformed:
            more = file.read(size) if data[:4] == MAGIC else b""
            if not more:
                raise
            data, size = data + more, size * 2


def _inflated(data: bytes, codec: str) -> bytes:
    if codec == "null":
        return data
    if codec == "deflate":
        return zlib.decompress(data, -15)
    if codec == "zstandard":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    if codec == "snappy":
        body, size, shift, at = data[:-4], 0, 0, 0
        while True:  # the length stands first, seven bits a byte
            size |= (body[at] & 0x7F) << shift
            shift, at = shift + 7, at + 1
            if body[at - 1] < 128:
                break
        out = pa.Codec("snappy").decompress(body, size).to_pybytes()
        _need(zlib.crc32(out) == struct.unpack(">I", data[-4:])[0], "a block's checksum differs")
        return out
    raise schemas.SpecError(f"unsupported Avro codec {codec!r}")


def blocks(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Count and bytes of the blocks whose sync marker before them begins in ``start`` to ``end``."""
    _, codec, sync, first = header(file)
    if start == 0:
        at = first - 16
    else:
        at, held = -1, b""
        file.seek(start)
        while at < 0 and start < end:
            held += file.read(1 << 20)
            found = held.find(sync)
            if found >= 0:
                at = start + found
            elif len(held) < 1 << 20:
                return
            else:
                start, held = start + len(held) - 15, held[-15:]
    while 0 <= at < end:
        file.seek(at + 16)
        head = file.read(20)
        if not head:
            return
        count, after = _one_long(head, 0)
        size, after = _one_long(head, after)
        _need(count >= 0 and size >= 0, "a block has a negative size")
        file.seek(at + 16 + after)
        data = file.read(size + 16)
        _need(len(data) == size + 16 and data[size:] == sync, "a block is cut short")
        yield count, _inflated(data[:size], codec)
        at += 16 + after + size


def rows_of_blocks(held: list[tuple[int, bytes]], schema: str) -> pa.Array:
    """The records of some blocks: the first of each, then the second of each, and so on."""
    node = schemas.parse_avro_json(schema)
    data = np.frombuffer(b"".join(b for _, b in held), np.uint8)
    sizes = np.array([len(b) for _, b in held])
    end = np.cumsum(sizes)
    at, left = end - sizes, np.array([n for n, _ in held])
    parts = [decode(data, at[:0], end[:0], node)[0]]
    while (left > 0).any():
        live = np.flatnonzero(left > 0)
        value, at[live] = decode(data, at[live], end[live], node)
        parts.append(value)
        left[live] -= 1
    _need((at == end).all(), "a block holds more than its records")
    return pa.concat_arrays(parts).cast(arrow_type(node))


# --- encoding, for topics and files made from tables ----------------------------------------


def _number(value: int) -> bytes:
    value, out = (value << 1) ^ (value >> 63), bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def encode(value, node) -> bytes:
    """One value in Avro's binary form; times are numbers already."""
    if isinstance(node, list):
        number = next(i for i, m in enumerate(node) if (m == "null") == (value is None))
        return _number(number) + encode(value, node[number])
    kind = node if isinstance(node, str) else node["type"]
    if isinstance(kind, (dict, list)):
        return encode(value, kind)
    if kind == "null":
        return b""
    if kind == "record":
        return b"".join(encode(value[f["name"]], f["type"]) for f in node["fields"])
    if kind == "array":
        return (_number(len(value)) + b"".join(encode(v, node["items"]) for v in value) if value else b"") + b"\0"
    if kind == "map":
        return (_number(len(value)) + b"".join(encode(k, "string") + encode(v, node["values"]) for k, v in value.items()) if value else b"") + b"\0"
    if kind == "boolean":
        return bytes([bool(value)])
    if kind in ("int", "long"):
        return _number(int(value))
    if kind in ("float", "double"):
        return struct.pack("<f" if kind == "float" else "<d", value)
    if kind == "enum":
        return _number(node["symbols"].index(value))
    value = value.encode() if isinstance(value, str) else value
    return value if kind == "fixed" else _number(len(value)) + value


def container_parts(rows: Iterable[dict], schema: str, codec: str = "deflate", block_rows: int = 1000, sync: bytes = b"tierline-sync-16") -> Iterator[bytes]:
    """A container file of some rows, its header and then a block at a time; no more than a block's rows are held."""
    meta = {"avro.schema": schema.encode(), "avro.codec": codec.encode()}
    node, rows = json.loads(schema), iter(rows)
    yield MAGIC + encode(meta, {"type": "map", "values": "bytes"}) + sync
    while part := list(islice(rows, block_rows)):
        data = b"".join(encode(r, node) for r in part)
        if codec == "deflate":
            packer = zlib.compressobj(wbits=-15)
            data = packer.compress(data) + packer.flush()
        elif codec == "snappy":
            data = pa.Codec("snappy").compress(data).to_pybytes() + struct.pack(">I", zlib.crc32(data))
        elif codec == "zstandard":
            import zstandard

            data = zstandard.compress(data)
        yield _number(len(part)) + _number(len(data)) + data + sync


def container(rows: list[dict], schema: str, codec: str = "deflate", block_rows: int = 1000, sync: bytes = b"tierline-sync-16") -> bytes:
    """A container file of some rows."""
    return b"".join(container_parts(rows, schema, codec, block_rows, sync))
