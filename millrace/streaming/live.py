"""Reports and histograms that follow a stream by the wall clock.

Every micro-batch adds its counts, stamped with the time at which it was taken in, and
writes what a report at that time says. Nothing is kept in state: a report reads the few
buckets of time that are live, by folder, so its cost does not grow with the stream's age,
and a report can be asked for at any time, also while no messages come.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.buckets import BATCH_SIZE_BUCKETS, LAG_BUCKETS, exp_buckets
from ..operators.stats import histogram
from .folders import remove, subfolders
from .rolling import BUCKET_SECONDS, LIVE_BUCKETS, fold_overflow, sum_counts, window_report

# Fixed value: names that a bucket keeps before it counts others as one.
MAX_DISTINCT = 10_000
# Names arrive in the order of batches, and in a batch in that of their sequences.
ARRIVAL = "first_seen struct<batch:bigint,sequence:bigint>"
SHARES = f"table_name string, rows bigint, msgs bigint, {ARRIVAL}, bucket bigint, batch bigint"


def add_tallies(tallies: DataFrame, sink: str, batch_id: int, now: float, seconds: int = BUCKET_SECONDS) -> None:
    """Add a batch's ``table_name, rows, msgs, sequence`` to the bucket of ``now``.

    Negative counts are 0. A repeated batch replaces its share, unless the clock has gone
    into another bucket in between; then its former share is removed first.
    """
    bucket, name = int(now // seconds), f"batch={batch_id}"
    for other in subfolders(tallies.sparkSession, os.path.join(sink, "live")):
        if name in subfolders(tallies.sparkSession, os.path.join(sink, "live", other)):
            remove(tallies.sparkSession, os.path.join(sink, "live", other, name))
    first = F.struct(F.lit(batch_id).cast("bigint").alias("batch"), F.min("sequence").alias("sequence"))
    counts = tallies.groupBy("table_name").agg(
        F.sum(F.greatest("rows", F.lit(0))).alias("rows"), F.sum(F.greatest("msgs", F.lit(0))).alias("msgs"), first.alias("first_seen")
    )
    counts.write.mode("overwrite").parquet(os.path.join(sink, "live", f"bucket={bucket}", name))


def report_at(
    spark: SparkSession, sink: str, now: float, n: int = 10, seconds: int = BUCKET_SECONDS, buckets: int = LIVE_BUCKETS,
    max_distinct: int = MAX_DISTINCT,
) -> DataFrame:
    """The top tables of the buckets that are live at ``now``, as ``window_report`` has them.

    ``window_bucket`` is the number of the bucket of ``now``. Without live counts there are
    no rows. Only folders of live buckets are listed and read.
    """
    last = int(now // seconds)
    have = subfolders(spark, os.path.join(sink, "live"))
    live = [f"bucket={b}" for b in range(last - buckets + 1, last + 1) if f"bucket={b}" in have]
    root = os.path.join(sink, "live")
    paths = [os.path.join(root, b) for b in live]
    shares = spark.read.option("basePath", root).schema(SHARES).parquet(*paths) if paths else spark.createDataFrame([], SHARES)
    window = fold_overflow(sum_counts(shares, "bucket", "table_name"), max_distinct)
    return window_report(sum_counts(window.withColumn("window_bucket", F.lit(last)), "window_bucket", "table_name"), n)


def stream_window_reports(
    tallies: DataFrame, sink: str, checkpoint: str, now: Callable[[], float] = time.time, trigger: dict | None = None,
    keep_buckets: int | None = None, **report,
) -> StreamingQuery:
    """Report on the live window after every micro-batch of ``table_name, rows, msgs, sequence``.

    Reports are kept by batch under ``sink/reports``; ``read_reports`` reads them. Folders
    of buckets that have left the window go after ``keep_buckets`` more (default: as many
    as are live). ``report`` are the other parameters of ``report_at``.
    """
    seconds, buckets = report.get("seconds", BUCKET_SECONDS), report.get("buckets", LIVE_BUCKETS)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, at = batch.sparkSession, now()
        add_tallies(batch, sink, batch_id, at, seconds)
        found = report_at(spark, sink, at, **report)
        found.coalesce(1).write.mode("overwrite").parquet(os.path.join(sink, "reports", f"batch={batch_id}"))
        oldest = int(at // seconds) - buckets - (buckets if keep_buckets is None else keep_buckets)
        for folder in subfolders(spark, os.path.join(sink, "live")):
            if int(folder.removeprefix("bucket=")) <= oldest:
                remove(spark, os.path.join(sink, "live", folder))

    writer = tallies.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


REPORT = (
    "window_bucket bigint, place int, table_name string, rows bigint, msgs bigint, share_pct double, "
    "tables_distinct bigint, total_rows bigint, batch bigint"
)


def read_reports(spark: SparkSession, sink: str) -> DataFrame:
    """The report of every batch so far."""
    return spark.read.schema(REPORT).parquet(os.path.join(sink, "reports"))


# Histograms

SNAPSHOT = "le double, cumulative bigint, total double"


def add_observations(messages: DataFrame, sink: str, batch_id: int, now: float, stored_at: Column) -> None:
    """Add a batch's lags, in seconds from ``stored_at`` to ``now``, and its size.

    Both are histograms of the batch alone. A message without a time has no lag, and an
    empty batch is not observed.
    """
    spark = messages.sparkSession
    lag = F.lit(now) - F.unix_micros(stored_at.cast("timestamp")) / 1e6
    lags = histogram(messages, lag, exp_buckets(*LAG_BUCKETS))
    size = messages.agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    sizes = histogram(size, F.col("n"), exp_buckets(*BATCH_SIZE_BUCKETS))
    for kind, found in (("lag", lags), ("batch_size", sizes)):
        out = os.path.join(sink, f"kind={kind}", f"batch={batch_id}")
        found.coalesce(1).write.mode("overwrite").parquet(out)


def stream_histograms(
    messages: DataFrame, sink: str, checkpoint: str, now: Callable[[], float] = time.time, stored_at: str = "stored_at",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Histograms of lag and batch size of a stream of envelopes, one share for each batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        add_observations(batch, sink, batch_id, now(), F.col(stored_at))

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_histograms(spark: SparkSession, sink: str, kind: str, chunk: int = 1000) -> DataFrame:
    """``snapshot_id, le, cumulative, total`` after every batch that observed something.

    The shares of the batches are added up in their order, inside chunks of batches and
    then from chunk to chunk, so a long stream is not one task. These are the snapshots
    that ``histogram_delta``, ``bucket_quantile`` and ``lag_summary`` read.
    """
    shares = spark.read.schema(f"{SNAPSHOT}, batch bigint").parquet(os.path.join(sink, f"kind={kind}"))
    # A histogram of nothing counts nothing anywhere.
    seen = shares.filter((F.col("le") == float("inf")) & (F.col("cumulative") > 0)).select("batch")
    shares = shares.join(seen, "batch").withColumn("chunk", F.floor(F.col("batch") / chunk))
    inside = Window.partitionBy("chunk", "le").orderBy("batch")
    sums = shares.groupBy("chunk", "le").agg(F.sum("cumulative").alias("c"), F.sum("total").alias("t"))
    before = Window.partitionBy("le").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        "chunk", "le", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c"), F.coalesce(F.sum("t").over(before), F.lit(0.0)).alias("t")
    )
    added = shares.select(
        "chunk", "le", F.col("batch").alias("snapshot_id"),
        F.sum("cumulative").over(inside).alias("cumulative"), F.sum("total").over(inside).alias("total"),
    )
    both = added.join(carried, ["chunk", "le"])
    return both.select("snapshot_id", "le", (F.col("cumulative") + F.col("c")).alias("cumulative"), (F.col("total") + F.col("t")).alias("total"))
