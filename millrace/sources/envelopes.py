"""Message envelopes: reading them and selecting by subject."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..errors import InvalidPipelineError
from ..schema import ENVELOPE


def read_messages(
    spark: SparkSession, path: str, streaming: bool = False, files_per_trigger: int | None = None
) -> DataFrame:
    """Envelopes stored as parquet, as a batch or as a stream of micro-batches.

    A micro-batch is often one file with one row group, which a single task reads; its
    messages are spread over the cluster before anything is decoded.
    """
    if not streaming:
        return spark.read.schema(ENVELOPE).parquet(path)
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return spread(reader.parquet(path))


# Tasks per core, so that the last ones do not wait long for each other.
TASKS_PER_CORE = 2


def spread(df: DataFrame) -> DataFrame:
    """Deal rows evenly over all cores, however few the row groups they come from.

    Moving a row costs far less than decoding its message.
    """
    return df.repartition(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)


def with_sequence(df: DataFrame, sequence: str = "sequence") -> DataFrame:
    """Fill a missing sequence from the message's content (not for streams).

    The number is a hash of the other columns, so a task that is repeated gives the same
    one; messages equal in every column share it, as a message delivered again does.
    """
    position = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c != sequence])
    value = F.coalesce(F.col(sequence), position) if sequence in df.columns else position
    return df.withColumn(sequence, value)


def subject_condition(subject: Column, pattern: str) -> Column:
    """Whether a subject matches a pattern: ``*`` is one token, a final ``>`` one or more.

    The literal prefix becomes a separate condition, which parquet can evaluate.
    """
    tokens = pattern.split(".")
    if not pattern or "" in tokens or ">" in tokens[:-1]:
        raise InvalidPipelineError(f"subject pattern {pattern!r} is malformed")
    wild = [i for i, token in enumerate(tokens) if token in ("*", ">")]
    if not wild:
        return subject == pattern
    conditions = []
    prefix = ".".join(tokens[: wild[0]])
    if prefix:
        conditions.append(subject.startswith(prefix + "."))
    if wild == [len(tokens) - 1] and tokens[-1] == ">":
        # A trailing > needs at least one non-empty token after the prefix.
        conditions.append(subject.rlike(f"^{re.escape(prefix + '.') if prefix else ''}[^.]+([.][^.]+)*$"))
    else:
        parts = {"*": "[^.]+", ">": "[^.]+([.][^.]+)*"}
        conditions.append(subject.rlike("^" + "[.]".join(parts.get(t, re.escape(t)) for t in tokens) + "$"))
    return reduce(lambda a, b: a & b, conditions)


def subject_filter(df: DataFrame, pattern: str, subject: str = "subject") -> DataFrame:
    """Messages whose subject matches the pattern."""
    return df.filter(subject_condition(F.col(subject), pattern))
