"""Envelope, output column types and the names the library reserves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .errors import InvalidPipelineError

ENVELOPE = T.StructType(
    [
        T.StructField("subject", T.StringType()),
        T.StructField("sequence", T.LongType()),
        T.StructField("stored_at", T.TimestampType()),
        T.StructField("payload", T.BinaryType()),
    ]
)

# Declared column type -> Spark type. Symbols travel as strings.
OUTPUT_TYPES: dict[str, T.DataType] = {
    "timestamp": T.LongType(),
    "double": T.DoubleType(),
    "int64": T.LongType(),
    "blob": T.BinaryType(),
    "string": T.StringType(),
    "symbol": T.StringType(),
}

# What a consumer that cannot store NULL expects in its place.
INT64_MIN = -0x8000000000000000
SENTINELS: dict[str, object] = {
    "timestamp": INT64_MIN,
    "double": float("nan"),
    "int64": INT64_MIN,
    "blob": b"",
    "string": "",
    "symbol": "",
}

# Columns of the flat row layout that a declared column may not shadow.
ROW_META = ("table_name", "ts_ns", "sequence")


def check_output_columns(columns: list[dict]) -> list[tuple[str, str]]:
    """Validate declared columns and return them as (name, type) pairs."""
    if not columns:
        raise InvalidPipelineError("output needs at least one column")
    seen: set[str] = set()
    pairs = []
    for column in columns:
        name, kind = column.get("name"), column.get("type")
        if not name:
            raise InvalidPipelineError("output column name is empty")
        if name.lower() in seen:
            # Tables on Spark do not tell names apart by case.
            raise InvalidPipelineError(f"output column {name!r} is declared twice")
        if name.lower() in ROW_META:
            raise InvalidPipelineError(f"output column {name!r} shadows a reserved column")
        if kind not in OUTPUT_TYPES:
            raise InvalidPipelineError(f"output column {name!r} has unknown type {kind!r}")
        seen.add(name.lower())
        pairs.append((name, kind))
    return pairs


def sentinel_fill(df: DataFrame, columns: list[dict]) -> DataFrame:
    """Replace NULL in the declared columns by the sentinel of their type."""
    filled: dict[str, Column] = {}
    for name, kind in check_output_columns(columns):
        sentinel = F.lit(SENTINELS[kind]).cast(OUTPUT_TYPES[kind])
        filled[name] = F.coalesce(F.col(f"`{name}`"), sentinel)
    return df.withColumns(filled)
