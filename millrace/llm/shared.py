"""What the operators share: folders every executor sees, bounded Arrow batches, words."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Rows and bytes of one Arrow batch, so that very long texts stay within a worker's memory.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20

# Words are runs of anything but the six ASCII white space characters. ``bytes.split()``
# separates at exactly these.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SPACE = re.compile("[\\x20\\x09-\\x0D]")

_LOCAL: dict[str, str] = {}


def bound_batches(spark: SparkSession) -> None:
    """Limit the Arrow batches of the session by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one of our own only in a single-process session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not re.match(r"local(\[|$)", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="llm-")
    return _LOCAL[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, small: bool = False) -> DataFrame:
    """The rows, written to the shared folder and read back: later work starts from files
    that outlive any executor.

    ``small`` marks results that are much smaller than what they are made of. They are
    dealt anew by size first, so that many tasks do not each write a tiny file.
    """
    path = new_folder(df.sparkSession, name)
    (df.hint("rebalance") if small else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_text(
    df: DataFrame, schema: str, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *columns: Column
) -> DataFrame:
    """Run an Arrow function over the given columns of a table. Workers serve many tasks, so
    each gives back at its end what it no longer uses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            pa.default_memory_pool().release_unused()

    bound_batches(df.sparkSession)
    return df.select(*columns).mapInArrow(run, schema)


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(column, letters, letters.lower())


ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
