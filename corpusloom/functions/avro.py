"""Avro object container files: schema, records and blocks as bytes.

Only what tables of mails need: records of null, boolean, int, long, float, double, bytes,
string, arrays of these, and unions of one of them with null.
"""

from __future__ import annotations

import io
import json
import struct
import sys
import zlib
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- fixed values: the file format ---------------------------------------------
MAGIC = b"Obj\x01"
SYNC_BYTES = 16
CODECS = ("null", "deflate")
PRIMITIVES = {
    T.BooleanType: "boolean", T.IntegerType: "int", T.LongType: "long", T.FloatType: "float", T.DoubleType: "double",
    T.BinaryType: "bytes", T.StringType: "string",
}
# --- end of fixed values -------------------------------------------------------

Writer = Callable[[Any, bytearray], None]
Reader = Callable[[io.BytesIO], Any]


def avro_type(kind: T.DataType, nullable: bool) -> Any:
    if isinstance(kind, T.ArrayType):
        own: Any = {"type": "array", "items": avro_type(kind.elementType, kind.containsNull)}
    elif type(kind) in PRIMITIVES:
        own = PRIMITIVES[type(kind)]
    else:
        raise TypeError(f"{kind.simpleString()} has no place in these files")
    return ["null", own] if nullable else own


def avro_schema(schema: T.StructType, name: str) -> dict:
    fields = [{"name": f.name, "type": avro_type(f.dataType, f.nullable)} for f in schema.fields]
    return {"type": "record", "name": name, "fields": fields}


def spark_type(kind: Any) -> tuple[T.DataType, bool]:
    """Spark type of an Avro type, and whether it may be null."""
    if isinstance(kind, list):
        own = [k for k in kind if k != "null"]
        if len(own) != 1:
            raise TypeError(f"{kind} is not a union of one type with null")
        return spark_type(own[0])[0], len(own) < len(kind)
    if isinstance(kind, dict) and kind["type"] == "array":
        return T.ArrayType(*spark_type(kind["items"])), False
    name = kind["type"] if isinstance(kind, dict) else kind
    for spark_kind, avro_name in PRIMITIVES.items():
        if avro_name == name:
            return spark_kind(), False
    raise TypeError(f"{kind} is not supported")


def spark_schema(schema: dict) -> T.StructType:
    return T.StructType([T.StructField(f["name"], *spark_type(f["type"])) for f in schema["fields"]])


# --- values --------------------------------------------------------------------


def put_long(n: int, out: bytearray) -> None:
    n = (n << 1) ^ (n >> 63)
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)


def get_long(data: io.BytesIO) -> int:
    n = shift = 0
    while True:
        byte = data.read(1)[0]
        n |= (byte & 0x7F) << shift
        if byte < 0x80:
            return (n >> 1) ^ -(n & 1)
        shift += 7


def _put_bytes(value: bytes, out: bytearray) -> None:
    put_long(len(value), out)
    out += value


def writer(kind: Any) -> Writer:
    if isinstance(kind, list):
        place = {branch if isinstance(branch, str) else branch["type"]: i for i, branch in enumerate(kind)}
        branch = next(b for b in kind if b != "null")
        inner, own, none = writer(branch), kind.index(branch), place.get("null")

        def put_union(value: Any, out: bytearray) -> None:
            put_long(none if value is None else own, out)
            if value is not None:
                inner(value, out)

        return put_union
    if isinstance(kind, dict) and kind["type"] == "array":
        item = writer(kind["items"])

        def put_array(value: Any, out: bytearray) -> None:
            if len(value):
                put_long(len(value), out)
                for v in value:
                    item(v, out)
            put_long(0, out)

        return put_array
    return {
        "null": lambda value, out: None,
        "boolean": lambda value, out: out.append(bool(value)),
        "int": put_long,
        "long": put_long,
        "float": lambda value, out: out.extend(struct.pack("<f", value)),
        "double": lambda value, out: out.extend(struct.pack("<d", value)),
        "bytes": _put_bytes,
        "string": lambda value, out: _put_bytes(value.encode(), out),
    }[kind if isinstance(kind, str) else kind["type"]]


def reader(kind: Any) -> Reader:
    if isinstance(kind, list):
        branches = [reader(k) for k in kind]
        return lambda data: branches[get_long(data)](data)
    if isinstance(kind, dict) and kind["type"] == "array":
        item = reader(kind["items"])

        def get_array(data: io.BytesIO) -> list:
            found = []
            while n := get_long(data):
                if n < 0:  # the size of the items in bytes follows
                    n = -n
                    get_long(data)
                found += [item(data) for _ in range(n)]
            return found

        return get_array
    return {
        "null": lambda data: None,
        "boolean": lambda data: data.read(1) != b"\0",
        "int": get_long,
        "long": get_long,
        "float": lambda data: struct.unpack("<f", data.read(4))[0],
        "double": lambda data: struct.unpack("<d", data.read(8))[0],
        "bytes": lambda data: data.read(get_long(data)),
        "string": lambda data: data.read(get_long(data)).decode(),
    }[kind if isinstance(kind, str) else kind["type"]]


# --- files ---------------------------------------------------------------------


def header(schema: dict, codec: str, sync: bytes) -> bytes:
    meta = {"avro.schema": json.dumps(schema).encode(), "avro.codec": codec.encode()}
    out = bytearray(MAGIC)
    put_long(len(meta), out)
    for key, value in meta.items():
        _put_bytes(key.encode(), out)
        _put_bytes(value, out)
    put_long(0, out)
    return bytes(out + sync)


def block(count: int, records: bytes, codec: str, sync: bytes) -> bytes:
    if codec == "deflate":
        packer = zlib.compressobj(wbits=-15)
        records = packer.compress(records) + packer.flush()
    out = bytearray()
    put_long(count, out)
    _put_bytes(records, out)
    return bytes(out + sync)


def read_header(data: io.BytesIO) -> tuple[dict, str, bytes]:
    """Schema, codec and sync mark of a file."""
    if data.read(4) != MAGIC:
        raise ValueError("this is no Avro file")
    meta: dict[str, bytes] = {}
    while n := get_long(data):
        if n < 0:
            n = -n
            get_long(data)
        for _ in range(n):
            key = data.read(get_long(data)).decode()
            meta[key] = data.read(get_long(data))
    return json.loads(meta["avro.schema"]), meta.get("avro.codec", b"null").decode(), data.read(SYNC_BYTES)


def blocks(data: io.BytesIO, codec: str, sync: bytes):
    """``count, records`` of every block of a file whose header has been read."""
    if codec not in CODECS:
        raise ValueError(f"codec {codec} is not supported")
    while head := data.read(1):
        data.seek(-len(head), io.SEEK_CUR)
        count = get_long(data)
        records = data.read(get_long(data))
        if data.read(SYNC_BYTES) != sync:
            raise ValueError("a block is damaged: its sync mark is missing")
        yield count, io.BytesIO(zlib.decompress(records, -15) if codec == "deflate" else records)
