"""Line files: JSON lines and base64 lines, with the lines that could not be read."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.decode import json_value


class Lines(NamedTuple):
    messages: DataFrame
    rejects: DataFrame


def is_json(text: Column) -> Column:
    """Whether a text is exactly one JSON value."""
    return json_value(text).isNotNull()


def json_lines(lines: DataFrame, column: str = "value") -> Lines:
    """Split text lines into JSON payloads and rejects; empty lines are skipped."""
    text = F.col(column)
    checked = lines.filter(F.length(text) > 0).select(text.alias("line"), is_json(text).alias("valid"))
    good = checked.filter("valid").select(F.col("line").cast("binary").alias("payload"))
    bad = checked.filter("NOT valid").select("line", F.lit("line is not valid JSON").alias("reason"))
    return Lines(good, bad)


def base64_bytes(text: Column) -> Column:
    """Bytes of standard padded base64; NULL for anything else."""
    whole = (F.length(text) % 4 == 0) & text.rlike(r"^[A-Za-z0-9+/]*={0,2}$")
    return F.when(whole, F.try_to_binary(text, F.lit("base64")))


def base64_lines(lines: DataFrame, column: str = "value") -> Lines:
    """Split text lines into decoded payloads and rejects; empty lines are skipped."""
    full = lines.select(F.col(column).alias("line")).filter(F.col("line") != "")
    decoded = full.withColumn("payload", base64_bytes(F.col("line")))
    good = decoded.filter(F.col("payload").isNotNull()).select("payload")
    bad = decoded.filter(F.col("payload").isNull()).select(
        "line", F.lit("line is not valid base64").alias("reason")
    )
    return Lines(good, bad)


def read_jsonlines(spark: SparkSession, path: str | list[str]) -> Lines:
    return json_lines(spark.read.text(path))


def read_base64_lines(spark: SparkSession, path: str | list[str]) -> Lines:
    return base64_lines(spark.read.text(path))
