"""Protobuf bytes to a typed struct, driven by a compiled descriptor set."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from ..errors import InvalidPipelineError

try:
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
    from google.protobuf.message import DecodeError
except ImportError:  # optional dependency, reported when a pipeline asks for it
    descriptor_pb2 = None

TIMESTAMP = "google.protobuf.Timestamp"


def _descriptor(descriptor_set: bytes, message_type: str):
    """Message descriptor from a serialized descriptor set."""
    if descriptor_pb2 is None:
        raise InvalidPipelineError("parse_protobuf needs the protobuf Python package")
    try:
        files = descriptor_pb2.FileDescriptorSet.FromString(descriptor_set)
        pool = descriptor_pool.DescriptorPool()
        for file in files.file:
            pool.Add(file)
        return pool.FindMessageTypeByName(message_type)
    except (DecodeError, KeyError, TypeError) as cause:
        raise InvalidPipelineError(f"message type {message_type!r} not available: {cause}") from cause


def _is_map(field) -> bool:
    message = field.message_type
    return message is not None and message.GetOptions().map_entry


def _value_types(field, seen: tuple[str, ...]) -> tuple[T.DataType, pa.DataType]:
    kinds = {
        field.CPPTYPE_BOOL: (T.BooleanType(), pa.bool_()),
        field.CPPTYPE_FLOAT: (T.DoubleType(), pa.float64()),
        field.CPPTYPE_DOUBLE: (T.DoubleType(), pa.float64()),
    }
    if field.cpp_type == field.CPPTYPE_MESSAGE:
        if field.message_type.full_name == TIMESTAMP:
            return T.StringType(), pa.string()
        return _message_types(field.message_type, seen)
    if field.type == field.TYPE_BYTES:
        return T.BinaryType(), pa.binary()
    if field.cpp_type == field.CPPTYPE_STRING:
        return T.StringType(), pa.string()
    return kinds.get(field.cpp_type, (T.LongType(), pa.int64()))


def _message_types(descriptor, seen: tuple[str, ...] = ()) -> tuple[T.StructType, pa.DataType]:
    """Spark and Arrow struct types of a message."""
    if descriptor.full_name in seen:
        raise InvalidPipelineError(f"recursive message type {descriptor.full_name!r} has no fixed schema")
    seen = seen + (descriptor.full_name,)
    spark_fields, arrow_fields = [], []
    for field in descriptor.fields:
        if _is_map(field):
            spark, arrow = _value_types(field.message_type.fields_by_name["value"], seen)
            spark, arrow = T.MapType(T.StringType(), spark), pa.map_(pa.string(), arrow)
        else:
            spark, arrow = _value_types(field, seen)
            if field.is_repeated:
                spark, arrow = T.ArrayType(spark), pa.list_(arrow)
        spark_fields.append(T.StructField(field.name, spark))
        arrow_fields.append(pa.field(field.name, arrow))
    return T.StructType(spark_fields), pa.struct(arrow_fields)


def message_schema(descriptor_set: bytes, message_type: str) -> T.StructType:
    """Spark schema of the decoded message."""
    return _message_types(_descriptor(descriptor_set, message_type))[0]


def _plain(field, value):
    if field.cpp_type == field.CPPTYPE_MESSAGE:
        if field.message_type.full_name == TIMESTAMP:
            moment = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(
                seconds=value.seconds + value.nanos // 1_000_000_000
            )
            return f"{moment:%Y-%m-%dT%H:%M:%S}.{value.nanos % 1_000_000_000:09d}Z"
        return _populated(value)
    if field.cpp_type == field.CPPTYPE_UINT64 and value >= 1 << 63:
        return value - (1 << 64)
    return value


def _key_text(key) -> str:
    return str(key).lower() if isinstance(key, bool) else str(key)


def _populated(message) -> dict:
    """Set fields only; absent ones stay out and become NULL."""
    result = {}
    for field, value in message.ListFields():
        if _is_map(field):
            item = field.message_type.fields_by_name["value"]
            result[field.name] = [(_key_text(k), _plain(item, value[k])) for k in value]
        elif field.is_repeated:
            result[field.name] = [_plain(field, v) for v in value]
        else:
            result[field.name] = _plain(field, value)
    return result


def decode_protobuf(data: Column, descriptor_set: bytes, message_type: str) -> Column:
    """Struct of the decoded message; NULL when the bytes are empty or malformed.

    Unset fields are NULL. Integers and enums become BIGINT, floats DOUBLE,
    timestamps text with nine fraction digits, map keys text.
    """
    schema = message_schema(descriptor_set, message_type)
    prepared: list = []  # filled once per task

    @F.arrow_udf(schema)
    def run(batch: pa.Array) -> pa.Array:
        if not prepared:
            descriptor = _descriptor(descriptor_set, message_type)
            prepared.append(message_factory.GetMessageClass(descriptor))
            prepared.append(_message_types(descriptor)[1])
        factory, arrow_type = prepared

        def read(raw: bytes | None):
            if not raw:
                return None
            try:
                return _populated(factory.FromString(raw))
            except (DecodeError, OverflowError, ValueError):
                return None

        return pa.array([read(item) for item in batch.to_pylist()], arrow_type)

    return run(data)
