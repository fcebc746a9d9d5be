"""De-duplication of a stream over all its past, without state.

Keys that were seen lie in the index of delivered keys beside the rows, so neither a late
repeat nor a late first row is taken for the other, and memory does not grow with the
number of keys. A batch opens only parts of the index whose filters know one of its keys.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from .delivered import mark_delivered, merge_runs, undelivered
from .ingest import checkpoint_root
from .sinks import log_schema, read_routed

KEYS = ("table_name", "ts_ns", "sequence")


def row_key(rows: DataFrame, keys: tuple[str, ...]) -> Column:
    """Sixteen bytes that rows of equal keys share; a null equals a null only."""

    def part(name: str, kind: DataType) -> Column:
        if isinstance(kind, (ArrayType, MapType, StructType, VariantType)):
            raise ValueError(f"{name} is no plain value, so it cannot be a key")
        value = F.hex(name) if kind.typeName() == "binary" else F.col(name).cast("string")
        return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.md5(F.concat(*[part(name, rows.schema[name].dataType) for name in keys])))


def keyed(rows: DataFrame, keys: tuple[str, ...], time: str) -> DataFrame:
    """Whole rows with their key and the time that says where the index holds it."""
    at = F.coalesce(F.col(time).cast("bigint"), F.lit(0))
    return rows.select(F.struct("*").alias("whole"), row_key(rows, keys).alias("message_key"), at.alias("ts_ns"))


def rows_path(sink: str, batch: str = "") -> str:
    return os.path.join(sink, "rows", batch and f"batch={batch}")


def write_unique(rows: DataFrame, sink: str, batch: str, keys: tuple[str, ...] = KEYS, time: str = "ts_ns") -> None:
    """Write the rows of a batch whose keys no other batch of the sink has brought, one for
    each key. A repeat of the batch replaces what it wrote.

    The index is marked from the rows as they were written: if a batch fails before that,
    its repeat finds the same rows new.
    """
    fresh = undelivered(keyed(rows, keys, time), sink, batch).dropDuplicates(["message_key"]).select("whole.*")
    log_schema(fresh, sink)
    fresh.write.mode("overwrite").parquet(rows_path(sink, batch))
    written = rows.sparkSession.read.schema(fresh.schema).parquet(rows_path(sink, batch))
    mark_delivered(keyed(written, keys, time), sink, batch)
    merge_runs(rows.sparkSession, sink)


def read_unique(spark: SparkSession, sink: str) -> DataFrame:
    """The rows of all batches of a sink, with all columns ever written."""
    return read_routed(spark, sink, "rows", batch="string").drop("batch")


def unique_stream(
    rows: DataFrame, sink: str, checkpoint: str | None = None, keys: tuple[str, ...] = KEYS, time: str = "ts_ns",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write a stream to ``sink`` with one row for each set of ``keys``, however late its
    repeats or first rows come.

    ``time`` is a column of nanoseconds that repeats of a row share; it sorts the index by
    hours and may be null. Keys are plain values, and two nulls are equal. No row may have a
    column called ``batch``. ``trigger`` defaults to ``availableNow``.
    """
    if "batch" in rows.columns:
        raise ValueError("a column may not be called batch, which tells the folders of the sink")
    row_key(rows, keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_unique(batch, sink, str(batch_id), keys, time)

    location = os.path.join(checkpoint or checkpoint_root(rows.sparkSession), "unique")
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", location)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
