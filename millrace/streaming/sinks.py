"""Sinks: routed tables, quarantine, per-table CSV, and de-duplication before a write."""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..errors import InvalidPipelineError
from .folders import remove, subfolders

DEDUP_MODES = ("disabled", "drop", "upsert")


def by_table(rows: DataFrame) -> DataFrame:
    """Bring rows of a table together for writing.

    A rebalance lets adaptive execution split a table that dominates into several
    tasks and merge small tables into one.
    """
    return rows.hint("rebalance", F.col("table_name"))


SCHEMA = "_schema"


def write_routed(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Write rows to one partition directory per table name; ``read_routed`` reads them back.

    Appended rows may have further columns or lack some; a column of another type than
    before is refused.
    """
    if mode == "append":
        log_schema(rows, path)
    by_table(rows).write.mode(mode).partitionBy("table_name").parquet(path)
    if mode != "append":  # the folder was replaced, and the log with it
        log_schema(rows, path)


def logged_schema(spark: SparkSession, path: str) -> tuple[T.StructType | None, int]:
    """All columns written so far, in the order in which they appeared, and the last version.

    A sink has as many versions as its columns changed, which the driver reads.
    """
    folder = f"{path}/{SCHEMA}"
    if not subfolders(spark, folder):
        return None, 0
    log = spark.read.schema("schema string, version int").json(folder).collect()
    merged: dict[str, T.StructField] = {}
    for row in sorted(log, key=lambda r: (r.version, r.schema)):
        for field in T.StructType.fromJson(json.loads(row.schema)).fields:
            known = merged.setdefault(field.name, field)
            if known.dataType != field.dataType:
                raise InvalidPipelineError(f"column {field.name!r} was written as {known.dataType} and as {field.dataType}")
    return T.StructType(list(merged.values())), max(row.version for row in log)


def log_schema(rows: DataFrame, path: str) -> None:
    """Add the rows' columns to the log beside the data, before rows with new ones are written.

    The same columns again add nothing. Readers of the data pass over the log.
    """
    spark = rows.sparkSession
    fields = [T.StructField(f.name, f.dataType, True, {}) for f in rows.schema.fields]
    known, version = logged_schema(spark, path)
    have = {f.name: f.dataType for f in known.fields} if known else {}
    for field in fields:
        if have.get(field.name, field.dataType) != field.dataType:
            raise InvalidPipelineError(f"column {field.name!r} is {field.dataType}, but {have[field.name]} in {path}")
    if known is not None and all(f.name in have for f in fields):
        return
    entry = spark.createDataFrame([(T.StructType(fields).json(),)], "schema string")
    # Writers that meet at the same version both stay: the log is merged.
    entry.coalesce(1).write.mode("append").json(f"{path}/{SCHEMA}/version={version + 1}")


def read_routed(spark: SparkSession, path: str, data: str = "", **partitions: str) -> DataFrame:
    """Routed rows with all columns ever written; rows from before a column have NULL there.

    Table names stay text, also those of digits only, and a sink without rows reads as an
    empty table. ``data`` is the folder of the rows below ``path``, ``partitions`` are
    further partition columns above the table name, by type.
    """
    schema, _ = logged_schema(spark, path)
    if schema is None:
        raise InvalidPipelineError(f"nothing was written to {path}")
    for name, kind in partitions.items():
        schema = schema.add(name, kind)
    return spark.read.schema(schema).parquet(f"{path}/{data}" if data else path)


def dedup(rows: DataFrame, mode: str = "drop", keys: list[str] | None = None) -> DataFrame:
    """Remove repeated rows.

    ``drop`` removes rows equal in every column; ``upsert`` keeps, per table, time and
    ``keys``, the row with the highest sequence. Equal sequences are settled by content,
    so reruns agree.
    """
    if mode not in DEDUP_MODES:
        raise InvalidPipelineError(f"dedup mode must be one of {', '.join(DEDUP_MODES)}")
    if mode == "disabled":
        return rows
    if mode == "drop":
        return rows.dropDuplicates()
    names = list(dict.fromkeys(["table_name", "ts_ns", *(keys or [])]))
    content = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    # Spark keeps one row per key in every map task before the shuffle, because the
    # filter below asks for the first row only.
    newest = Window.partitionBy(*names).orderBy(F.desc("sequence"), content)
    return rows.withColumn("__rank", F.row_number().over(newest)).filter("__rank = 1").drop("__rank")


def write_csv(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write one CSV directory per table, rows in index order across its files.

    The range partitioning includes the time, so a large table spans several files. Finding
    the ranges reads the rows once more: pass rows that are stored, such as
    ``read_routed``'s, or every message is decoded twice.
    """
    order = ["table_name", "ts_ns"] + (["sequence"] if "sequence" in rows.columns else [])
    flat = rows.select(*[
        F.base64(F.col(f"`{n}`")).alias(n) if t == "binary" else F.col(f"`{n}`") for n, t in rows.dtypes
    ])
    flat.orderBy(*order).write.mode(mode).partitionBy("table_name").csv(path, header=True)


def quarantine_rows(sent_back: DataFrame) -> DataFrame:
    """Envelope and errors of messages to process again."""
    envelope = [c for c in ("subject", "sequence", "stored_at", "payload") if c in sent_back.columns]
    return sent_back.select(*envelope, "errors")


def write_quarantine(sent_back: DataFrame, path: str, mode: str = "append") -> None:
    """Store messages to process again; ``read_messages`` reads them back."""
    quarantine_rows(sent_back).write.mode(mode).parquet(path)


def latest_rows(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The rows of all batches as they are now: per table, time and keys the highest sequence."""
    return dedup(rows, "upsert", keys)


def compact_tables(spark: SparkSession, path: str, keys: list[str] | None = None, data: str = "tables") -> list[str]:
    """Rewrite the tables of an ``upsert`` sink that several batches have written, with their
    latest rows only.

    Returns their names. The latest rows are written as a batch of their own before the
    others' folders go; in between a row may be there twice, which ``latest_rows`` settles,
    so an interrupted run costs nothing. Tables of a single batch are not touched.
    """
    root = f"{path}/{data}"
    batches: dict[str, list[str]] = {}
    for batch in subfolders(spark, root):
        for table in subfolders(spark, f"{root}/{batch}"):
            batches.setdefault(table, []).append(batch)
    touched = {table: where for table, where in batches.items() if len(where) > 1}
    if not touched:
        return []
    folders = sorted({f"{root}/{batch}/{table}" for table, where in touched.items() for batch in where})
    schema, _ = logged_schema(spark, path)
    rows = spark.read.option("basePath", root).schema(schema.add("batch", "string")).parquet(*folders)
    fresh = f"batch=compacted-{uuid.uuid4().hex}"
    by_table(latest_rows(rows.drop("batch"), keys)).write.mode("overwrite").partitionBy("table_name").parquet(f"{root}/{fresh}")
    for folder in folders:
        remove(spark, folder)
    return sorted(rows_of(table) for table in touched)


def rows_of(folder: str) -> str:
    """The table a folder holds, from its escaped name."""
    return unquote(folder.removeprefix("table_name="))
