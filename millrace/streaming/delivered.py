"""What a sink has already taken: an index of message keys that is looked up, not scanned.

A message is known by its table, time and sequence; one without a sequence by its subject
and payload instead. Keys lie in buckets of time, and every batch adds one run of keys with
a Bloom filter for each bucket and slice of keys. A new batch asks the filters of its own
buckets and opens only buckets of runs where a filter knows one of its keys, so neither an
outlying time nor the age of the sink makes it read more. Runs are merged by levels:
``FAN`` runs of a level become one of the next, so their number grows with the logarithm of
the number of batches.

Every key keeps the batch it came with. A batch that is repeated does not find itself, even
after its run was merged.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .folders import remove, subfolders

# Seconds of a bucket. Buckets are counted round, which bounds the folders of a run: a batch
# of old times still opens one bucket for each hour it holds.
BUCKET_SECONDS, BUCKETS = 3600, 64
# Runs of a level that are merged.
FAN = 8
# Keys of a slice, bits a key takes in its filter (1 of 2000 is a false alarm), and probes.
PER_SLICE, KEY_BITS, PROBES = 1 << 18, 16, 8
# Keys that ask a filter in one task.
ASKING = 1 << 20

KEYS = "message_key binary, batch string"
FILTERS = "run string, bucket int, slice int, slices int, bits binary"


def message_key(subject: Column, sequence: Column, payload: Column, table: Column, ts_ns: Column) -> Column:
    """Sixteen bytes that two deliveries of a message share."""
    content = F.md5(F.concat(F.coalesce(subject, F.lit("")).cast("binary"), F.lit(b"\0"), F.coalesce(payload, F.lit(b""))))
    who = F.coalesce(sequence.cast("string"), F.concat(F.lit("-"), content))
    # The table comes last, as it may hold any character.
    return F.unhex(F.md5(F.concat_ws(":", ts_ns.cast("string"), who, table)))


def bucket_of(ts_ns: Column) -> Column:
    return F.pmod(F.floor(ts_ns / (BUCKET_SECONDS * 1_000_000_000)), F.lit(BUCKETS)).cast("int")


def slice_of(slices: Column) -> Column:
    return F.pmod(F.xxhash64("message_key"), slices).cast("int")


def probes_of(keys: list[bytes], bits: int) -> np.ndarray:
    """Places of each key in a filter, from the two halves of the key."""
    halves = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
    steps = np.arange(PROBES, dtype=np.uint64)
    return ((halves[:, :1] + steps * (halves[:, 1:] | np.uint64(1))) % np.uint64(bits)).astype(np.int64)


def filter_of(keys: list[bytes]) -> bytes:
    bits = max(64, 1 << (len(keys) * KEY_BITS - 1).bit_length())
    out = np.zeros(bits // 8, np.uint8)
    place = probes_of(keys, bits).ravel()
    np.bitwise_or.at(out, place >> 3, (1 << (place & 7)).astype(np.uint8))
    return out.tobytes()


def known_to(bits: bytes, keys: list[bytes]) -> np.ndarray:
    """Which keys the filter may have seen; it misses none."""
    have = np.frombuffer(bits, np.uint8)
    place = probes_of(keys, len(have) * 8)
    return ((have[place >> 3] >> (place & 7).astype(np.uint8)) & 1).all(axis=1)


def keys_path(sink: str, run: str = "") -> str:
    return os.path.join(sink, "delivered", "keys", run and f"run={run}")


def filters_path(sink: str, run: str = "") -> str:
    return os.path.join(sink, "delivered", "filters", run and f"run={run}")


def write_run(keys: DataFrame, sink: str, run: str) -> None:
    """Store keys ``(message_key, batch, bucket)`` as a run, and the filters over them."""
    spark = keys.sparkSession
    path = keys_path(sink, run)
    keys.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)
    stored = read_run(spark, sink, run)
    sizes = stored.groupBy("bucket").agg(F.count("*").alias("n"))
    sizes = sizes.select("bucket", F.ceil(F.col("n") / PER_SLICE).cast("int").alias("slices"))
    sliced = stored.join(sizes, "bucket").withColumn("slice", slice_of(F.col("slices")))

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        bucket, slices, slice_ = key
        return pd.DataFrame([(run, bucket, slice_, slices, filter_of(part["message_key"].tolist()))], columns=FILTER_NAMES)

    filters = sliced.select("bucket", "slices", "slice", "message_key").groupBy("bucket", "slices", "slice").applyInPandas(build, FILTERS)
    # One file, but built in as many tasks as there are slices: coalesce would build them all in one.
    filters.drop("run").repartition(1).write.mode("overwrite").parquet(filters_path(sink, run))


FILTER_NAMES = [part.split()[0] for part in FILTERS.split(", ")]


def read_run(spark: SparkSession, sink: str, run: str) -> DataFrame:
    path = keys_path(sink, run)
    return spark.read.option("basePath", path).schema(KEYS + ", bucket int").parquet(path)


def live_runs(spark: SparkSession, sink: str) -> list[str]:
    """Runs that are complete: their filters are written last."""
    complete = set(subfolders(spark, filters_path(sink)))
    return [n.removeprefix("run=") for n in subfolders(spark, keys_path(sink)) if n in complete]


def suspects(keys: DataFrame, sink: str) -> list[tuple[str, int]]:
    """``(run, bucket)`` in which a filter knows one of the keys ``(message_key, bucket)``.

    At most as many as buckets and runs. Keys and filters meet by run, bucket and slice; a
    batch of very many keys asks in parts.
    """
    spark = keys.sparkSession
    if not live_runs(spark, sink):
        return []
    parts = keys.count() // ASKING + 1
    filters = spark.read.schema(FILTERS).parquet(filters_path(sink))
    shape = filters.select("run", "bucket", "slices").distinct()
    asked = keys.join(shape, "bucket").select(
        F.col("run").alias("r"), F.col("bucket").alias("b"), slice_of(F.col("slices")).alias("s"),
        F.pmod(F.hash("message_key"), F.lit(parts)).alias("p"), "message_key",
    )
    filters = filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def ask(filters: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        found = len(keys) and any(known_to(bits, keys["message_key"].tolist()).any() for bits in filters["bits"])
        rows = [(filters["run"].iloc[0], int(filters["bucket"].iloc[0]))] if found else []
        return pd.DataFrame(rows, columns=["run", "bucket"])

    met = filters.groupBy("run", "bucket", "slice", "part").cogroup(asked.groupBy("r", "b", "s", "p"))
    return sorted(tuple(r) for r in met.applyInPandas(ask, "run string, bucket int").distinct().collect())


def undelivered(kept: DataFrame, sink: str, batch: str) -> DataFrame:
    """Messages that no other batch of the sink has delivered. ``kept`` has ``message_key``
    and ``ts_ns``."""
    keys = kept.select("message_key", bucket_of(F.col("ts_ns")).alias("bucket"))
    hits = suspects(keys, sink)
    if not hits:
        return kept
    paths = [os.path.join(keys_path(sink, run), f"bucket={bucket}") for run, bucket in hits]
    seen = kept.sparkSession.read.schema(KEYS).parquet(*paths).filter(F.col("batch") != batch)
    return kept.join(seen.select("message_key"), "message_key", "left_anti")


def mark_delivered(kept: DataFrame, sink: str, batch: str) -> None:
    """Add the keys of delivered messages as the run of a batch; a repeat replaces it."""
    keys = kept.select("message_key", F.lit(batch).alias("batch"), bucket_of(F.col("ts_ns")).alias("bucket"))
    write_run(keys.dropDuplicates(["message_key"]), sink, f"0-{batch}")


def merge_runs(spark: SparkSession, sink: str, fan: int = FAN) -> None:
    """Merge the runs of every level that has ``fan`` of them into one of the next level.

    The merged run is complete before the others go; in between, keys are there twice,
    which changes no answer.
    """
    level = 0
    while True:
        runs = [r for r in live_runs(spark, sink) if r.startswith(f"{level}-")]
        if len(runs) < fan:
            higher = [r for r in live_runs(spark, sink) if int(r.split("-")[0]) > level]
            if not higher:
                return
            level += 1
            continue
        parts = [read_run(spark, sink, run) for run in runs]
        merged = parts[0]
        for part in parts[1:]:
            merged = merged.unionByName(part)
        write_run(merged, sink, f"{level + 1}-{runs[-1].split('-', 1)[1]}")
        for run in runs:
            remove(spark, filters_path(sink, run))
            remove(spark, keys_path(sink, run))
        level += 1
