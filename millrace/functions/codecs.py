"""Byte codecs: gzip both ways and packed numeric arrays.

Spark SQL has no expression for these, so they are Arrow functions working on
whole batches. Everything else in the library stays inside the JVM.
"""

from __future__ import annotations

import math
import sys
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

from ..errors import InvalidPipelineError

# Element type -> numpy code and width in bytes.
PACKED_TYPES: dict[str, tuple[str, int]] = {
    "int8": ("i1", 1),
    "int16": ("i2", 2),
    "int32": ("i4", 4),
    "int64": ("i8", 8),
    "uint8": ("u1", 1),
    "uint16": ("u2", 2),
    "uint32": ("u4", 4),
    "uint64": ("u8", 8),
    "float32": ("f4", 4),
    "float64": ("f8", 8),
}
BYTE_ORDERS = {"little": "<", "big": ">"}
# Arrow's list and binary columns count their content with 32 bits.
OFFSET_LIMIT = 2**31 - 1


def check_offsets(total: int) -> None:
    """Fail instead of letting the offsets of an output batch wrap around."""
    if total > OFFSET_LIMIT:
        raise OverflowError(
            f"an Arrow batch grows to {total} values or bytes; lower spark.sql.execution.arrow.maxRecordsPerBatch"
        )


def binary_array(items: list[bytes | None]) -> pa.Array:
    check_offsets(sum(len(item) for item in items if item is not None))
    return pa.array(items, pa.binary())


def _inflate(data: bytes | None) -> bytes | None:
    """Decompress every member of a gzip text; None when any byte of it is bad."""
    if not data:
        return data
    parts = []
    rest = data
    while rest:
        member = zlib.decompressobj(wbits=31)
        try:
            parts.append(member.decompress(rest))
        except zlib.error:
            return None
        if not member.eof:
            return None
        rest = member.unused_data
    return b"".join(parts)


def gunzip(data: Column) -> Column:
    """Decompressed bytes; empty input passes through, corrupt input gives NULL."""

    @F.arrow_udf(T.BinaryType())
    def run(batch: pa.Array) -> pa.Array:
        return binary_array([_inflate(item) for item in batch.to_pylist()])

    return run(data)


def gzip(data: Column, level: int = 6) -> Column:
    """Gzip-compressed bytes."""

    @F.arrow_udf(T.BinaryType())
    def run(batch: pa.Array) -> pa.Array:
        def deflate(item: bytes | None) -> bytes | None:
            if item is None:
                return None
            stream = zlib.compressobj(level, zlib.DEFLATED, 31)
            return stream.compress(item) + stream.flush()

        return binary_array([deflate(item) for item in batch.to_pylist()])

    return run(data)


def unpacked_type(type_name: str, scaled: bool) -> str:
    """``floats`` or ``ints``: what an unpacked array holds."""
    return "floats" if scaled or type_name.startswith("float") else "ints"


def check_scale(scale: object) -> float:
    if isinstance(scale, bool) or not isinstance(scale, (int, float)):
        raise InvalidPipelineError(f"scale must be a number, got {scale!r}")
    if not math.isfinite(scale) or scale == 0:
        raise InvalidPipelineError("scale must be finite and non-zero")
    return float(scale)


def _decode(raw: pa.Array, usable: np.ndarray, dtype: str, out: str, scale) -> pa.Array:
    """Read the usable rows of a binary array as one contiguous run of numbers."""
    width = np.dtype(dtype).itemsize
    sizes = pc.fill_null(pc.binary_length(raw), 0).to_numpy(zero_copy_only=False)
    counts = np.where(usable, sizes // width, 0).astype(np.int64)
    data = b"".join(raw.filter(pa.array(usable)).to_pylist())
    values = np.frombuffer(data, dtype=dtype).astype(out)
    if scale is not None:
        values = values * (np.repeat(scale, counts) if isinstance(scale, np.ndarray) else scale)
    check_offsets(int(counts.sum()))
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(values), mask=pa.array(~usable)
    )


def unpack(
    data: Column,
    type_name: str,
    endianness: str | None = None,
    scale: float | None = None,
    scale_column: Column | None = None,
) -> Column:
    """Fixed-width numbers packed in bytes to an array.

    Integers give ``array<bigint>`` (uint64 wraps); floats and anything scaled give
    ``array<double>``, widened before the multiplication. NULL when the byte length
    is no multiple of the width or the row's scale is unusable.
    """
    if type_name not in PACKED_TYPES:
        raise InvalidPipelineError(f"unpack type must be one of {', '.join(PACKED_TYPES)}")
    if endianness is not None and endianness not in BYTE_ORDERS:
        raise InvalidPipelineError("unpack endianness must be 'little' or 'big'")
    if scale is not None:
        scale = check_scale(scale)
    code, width = PACKED_TYPES[type_name]
    scaled = scale is not None or scale_column is not None
    is_float = unpacked_type(type_name, scaled) == "floats"
    result = T.ArrayType(T.DoubleType() if is_float else T.LongType())
    out = "f8" if is_float else "i8"

    def usable_rows(batch: pa.Array) -> np.ndarray:
        sizes = pc.fill_null(pc.binary_length(batch), 1 if width > 1 else 0)
        whole = sizes.to_numpy(zero_copy_only=False) % width == 0
        return whole & batch.is_valid().to_numpy(zero_copy_only=False)

    def dtype() -> str:
        # Host order is a property of the machine that decodes, so resolve it there.
        return BYTE_ORDERS[endianness or sys.byteorder] + code

    if scale_column is None:

        @F.arrow_udf(result)
        def run(batch: pa.Array) -> pa.Array:
            return _decode(batch, usable_rows(batch), dtype(), out, scale)

        return run(data)

    @F.arrow_udf(result)
    def run_scaled(batch: pa.Array, scales: pa.Array) -> pa.Array:
        factor = pc.fill_null(scales.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
        usable = usable_rows(batch) & np.isfinite(factor) & (factor != 0)
        return _decode(batch, usable, dtype(), out, np.where(usable, factor, 1.0))

    return run_scaled(data, scale_column)


def encode_payload(
    columns: list[Column], chain: tuple[str, ...] = ("json", "gzip", "base64"), level: int = 6
) -> Column:
    """Turn columns into a payload: a JSON object, optionally compressed and armoured.

    The first stage is always ``json``; the result is STRING after ``json`` and
    ``base64``, BINARY after ``gzip``.
    """
    if not chain or chain[0] != "json":
        raise InvalidPipelineError("the encode chain starts with 'json'")
    stages: dict[str, Callable[[Column], Column]] = {
        "gzip": lambda c: gzip(c.cast("binary"), level),
        # Spark breaks base64 into lines; a payload is one line.
        "base64": lambda c: F.replace(F.base64(c.cast("binary")), F.lit("\r\n"), F.lit("")),
    }
    value = F.to_json(F.struct(*columns))
    previous = "json"
    for stage in chain[1:]:
        if stage not in stages:
            raise InvalidPipelineError(f"unknown encode stage {stage!r}")
        if stage == "gzip" and previous == "base64":
            raise InvalidPipelineError("gzip takes text or JSON, not base64 text")
        value = stages[stage](value)
        previous = stage
    return value
