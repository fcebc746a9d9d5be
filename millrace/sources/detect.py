"""Format detection from the first bytes of every file."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.codecs import gunzip
from .lines import Lines, json_lines

HEAD_BYTES = 512

# Format names.
PARQUET, GZIP_JSON, JSON_LINES = "parquet", "json.gz", "jsonl"


def format_of(head: Column) -> Column:
    """Format of a file from its leading bytes; NULL when it is none of the known ones."""
    text = F.ltrim(head.cast("string"), F.lit(" \t\r\n"))
    return (
        F.when(F.substring(F.hex(head), 1, 8) == "50415231", PARQUET)
        .when(F.substring(F.hex(head), 1, 4) == "1F8B", GZIP_JSON)
        .when(text.startswith("{") | text.startswith("["), JSON_LINES)
    )


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column(0).to_pylist()
        heads, errors = [], []
        for path in paths:
            uri = path if "://" in path else path.replace(":/", ":///", 1)
            uri = re.sub("^s3[an]://", "s3://", uri)
            try:
                system, name = fs.FileSystem.from_uri(uri)
                with system.open_input_stream(name, compression=None) as stream:
                    heads.append(stream.read(HEAD_BYTES))
                errors.append(None)
            except (OSError, pa.ArrowException) as error:  # this file's row says so
                heads.append(None)
                errors.append(str(error)[:200])
        yield pa.record_batch(
            [pa.array(paths), pa.array(heads, pa.binary()), pa.array(errors, pa.string())], names=["path", "head", "error"]
        )


def empty_files(spark: SparkSession, directory: str) -> DataFrame:
    """Paths of files without content, which Spark's readers pass over.

    The file system lists them one by one; hidden files are not data.
    """
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(directory)
    listed = path.getFileSystem(context._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while listed.hasNext():
        file = listed.next()
        if file.getLen() == 0 and not file.getPath().getName().startswith(("_", ".")):
            found.append((file.getPath().toString(),))
    return spark.createDataFrame(found, "path string")


def detect_format(spark: SparkSession, directory: str) -> DataFrame:
    """``path``, ``format`` and ``error`` of every file; only the first bytes are read.

    A file that is empty, of no known format or unreadable has an error.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
    heads = listing.select("path").mapInArrow(_heads, "path string, head binary, error string")
    kind = format_of(F.col("head"))
    unknown = F.when(kind.isNull(), "unknown file format")
    known = heads.select("path", kind.alias("format"), F.coalesce("error", unknown).alias("error"))
    empty = empty_files(spark, directory).select(
        "path", F.lit(None).cast("string").alias("format"), F.lit("empty file").alias("error")
    )
    return known.unionByName(empty)


def read_detected(spark: SparkSession, directory: str) -> dict[str, DataFrame | Lines]:
    """Read every file with its reader, grouped by format.

    Raises ``ValueError`` if some file has no reader: none is left out. Only the file names
    go through the driver, which needs them to plan the scans.
    """
    found: dict[str, list[str]] = {}
    for row in detect_format(spark, directory).toLocalIterator():
        if row["error"]:
            raise ValueError(f"{row['path']}: {row['error']}")
        found.setdefault(row["format"], []).append(row["path"])
    result: dict[str, DataFrame | Lines] = {}
    if PARQUET in found:
        result[PARQUET] = spark.read.parquet(*found[PARQUET])
    if JSON_LINES in found:
        result[JSON_LINES] = json_lines(spark.read.text(found[JSON_LINES]))
    if GZIP_JSON in found:
        # Spark decompresses by file extension; other names are inflated whole.
        named = [p for p in found[GZIP_JSON] if p.endswith(".gz")]
        other = [p for p in found[GZIP_JSON] if not p.endswith(".gz")]
        frames = [spark.read.text(named)] if named else []
        if other:
            files = spark.read.format("binaryFile").load(other)
            text = gunzip(F.col("content")).cast("string")
            frames.append(files.select(F.explode(F.split(text, "\r?\n")).alias("value")))
        lines = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
        result[GZIP_JSON] = json_lines(lines)
    return result
