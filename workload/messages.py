"""Message envelopes derived from the given tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.codecs import check_offsets
from millrace.sources.envelopes import spread


ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def work_folder(spark: SparkSession) -> str:
    """A new folder below the one in ``spark.checkpoint.dir``, which all executors share.

    Only a session of a single process may go without one: it gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), f"millrace-{spark.sparkContext.applicationId}")
    return f"{root.rstrip('/')}/millrace-{uuid.uuid4().hex}"


def utc(column: str) -> Column:
    return F.col(column).cast("timestamp")


def iso(column: str) -> Column:
    return F.date_format(utc(column), ISO)


def envelope(df: DataFrame, subject: Column, sequence: Column, stored_at: Column, payload: Column) -> DataFrame:
    # The tables come in few row groups, and building a message costs more than moving its row.
    return spread(df).select(
        subject.alias("subject"),
        sequence.cast("bigint").alias("sequence"),
        stored_at.alias("stored_at"),
        payload.cast("binary").alias("payload"),
    )


def event_fields() -> list[Column]:
    return [
        F.col("event_id"),
        iso("ts").alias("ts"),
        F.col("user_id"),
        F.col("event_type"),
        F.col("value"),
        F.parse_json("props").alias("props"),
    ]


def event_subject() -> Column:
    return F.concat(F.lit("events."), "event_type", F.lit("."), F.col("user_id").cast("string"))


def event_messages(spark: SparkSession, sf_dir: str, payload: Column | None = None) -> DataFrame:
    """One JSON message per event."""
    events = table(spark, sf_dir, "events")
    body = F.to_json(F.struct(*event_fields())) if payload is None else payload
    return envelope(events, event_subject(), F.col("event_id"), utc("ts"), body)


def flawed_event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose kind decides what is wrong with the message.

    Refunds and errors are cut off, views lack the value, signups are empty, and
    purchases carry a bad time.
    """
    kind = F.col("event_type")
    text = F.to_json(F.struct(*event_fields()))
    bare = F.to_json(F.struct("event_id", iso("ts").alias("ts"), "user_id", "event_type"))
    late = F.to_json(F.struct("event_id", F.lit("soon").alias("ts"), "event_type", "value"))
    payload = (
        F.when(kind == "error", F.substr(text, F.lit(1), F.length(text) - 1))
        .when(kind == "view", bare)
        .when(kind == "signup", "")
        .when(kind == "purchase", late)
        .otherwise(text)
    )
    return event_messages(spark, sf_dir, payload)


def pack(values: Column, code: str) -> Column:
    """Numbers of an array packed into bytes, to have packed payloads to read."""

    @F.arrow_udf(T.BinaryType())
    def run(batch: pa.Array) -> pa.Array:
        width = np.dtype(code).itemsize
        counts = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
        data = pc.list_flatten(batch).to_numpy(zero_copy_only=False).astype(code).tobytes()
        check_offsets(int(counts.sum()) * width)
        offsets = np.zeros(len(batch) + 1, dtype=np.int32)
        np.cumsum(counts * width, out=offsets[1:])
        return pa.Array.from_buffers(
            pa.binary(), len(batch), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        )

    return run(values)


def event_descriptor() -> bytes:
    """Descriptor set of a small event message, built without a compiler.

    Its numbers and texts have presence (``optional``), so that a zero is on the wire and
    a missing one is not.
    """
    from google.protobuf import descriptor_pb2

    kinds = descriptor_pb2.FieldDescriptorProto
    file = descriptor_pb2.FileDescriptorProto(name="event.proto", package="feed", syntax="proto3")
    message = file.message_type.add(name="Event")
    simple = [("id", kinds.TYPE_UINT64), ("kind", kinds.TYPE_STRING), ("value", kinds.TYPE_DOUBLE), ("ts_us", kinds.TYPE_INT64)]
    for number, (name, kind) in enumerate(simple, 1):
        message.oneof_decl.add(name=f"_{name}")
        message.field.add(name=name, number=number, type=kind, label=1, proto3_optional=True, oneof_index=number - 1)
    entry = message.nested_type.add(name="BlobsEntry")
    entry.options.map_entry = True
    entry.field.add(name="key", number=1, type=kinds.TYPE_INT64, label=1)
    entry.field.add(name="value", number=2, type=kinds.TYPE_STRING, label=1)
    message.field.add(name="blobs", number=5, type=kinds.TYPE_MESSAGE, label=3, type_name=".feed.Event.BlobsEntry")
    return descriptor_pb2.FileDescriptorSet(file=[file]).SerializeToString()


def event_protobuf(descriptor_set: bytes, ts_us: Column) -> Column:
    """Events as protobuf bytes, to have messages to decode."""

    @F.arrow_udf(T.BinaryType())
    def run(ids: pa.Array, kinds: pa.Array, values: pa.Array, times: pa.Array, users: pa.Array) -> pa.Array:
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

        pool = descriptor_pool.DescriptorPool()
        for file in descriptor_pb2.FileDescriptorSet.FromString(descriptor_set).file:
            pool.Add(file)
        event = message_factory.GetMessageClass(pool.FindMessageTypeByName("feed.Event"))
        out = []
        for i, kind, value, at, user in zip(*[c.to_pylist() for c in (ids, kinds, values, times, users)]):
            message = event(id=i, kind=kind, value=value, ts_us=at)
            message.blobs[user] = kind
            out.append(message.SerializeToString())
        return pa.array(out, pa.binary())

    return run(F.col("event_id"), F.col("event_type"), F.col("value"), ts_us, F.col("user_id"))
