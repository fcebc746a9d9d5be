"""Rolling per-table counts over the latest time buckets."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.stats import OVERFLOW

# One-minute buckets, five of them live.
BUCKET_SECONDS = 60
LIVE_BUCKETS = 5


def bucket_of(time: Column, seconds: int) -> Column:
    """Number of the bucket a timestamp falls in, counted from the epoch."""
    at, width = F.unix_seconds(time), F.lit(seconds)
    # Rounded down, also before the epoch.
    return F.call_function("div", at - F.pmod(at, width), width)


def bucket_counts(tallies: DataFrame, time: Column, seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Rows and messages per bucket and table, with the sequence that came first.

    ``tallies`` has ``table_name, rows, msgs, sequence``. Partial sums combine before
    the shuffle, so a dominating table costs one row per task.
    """
    work = tallies.withColumn("bucket", bucket_of(time, seconds)).filter(F.col("bucket").isNotNull())
    return work.groupBy("bucket", "table_name").agg(
        F.sum("rows").alias("rows"), F.sum("msgs").alias("msgs"), F.min("sequence").alias("first_seen")
    )


def fold_overflow(counts: DataFrame, max_distinct: int) -> DataFrame:
    """Merge the tables of a bucket beyond the first ``max_distinct`` into ``other``.

    Names rank by their first sequence, then by name. The rank filter lets Spark cut
    every task's share to ``max_distinct`` names before the shuffle; all counts are kept.
    Both branches ask for the same columns of ``counts``, so its shuffle is shared.
    """
    arrival = Window.partitionBy("bucket").orderBy("first_seen", "table_name")
    named = (
        counts.withColumn("__rank", F.row_number().over(arrival))
        .filter(F.col("__rank") <= max_distinct)
        .select("bucket", "table_name", (F.col("rows") + F.col("msgs")).alias("__kept"))
    )
    marked = counts.join(named, ["bucket", "table_name"], "left")
    label = F.when(F.col("__kept").isNotNull(), F.col("table_name")).otherwise(F.lit(OVERFLOW))
    return sum_counts(marked, "bucket", label.alias("table_name"))


def sum_counts(counts: DataFrame, *keys) -> DataFrame:
    return counts.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("msgs").alias("msgs"), F.min("first_seen").alias("first_seen")
    )


def rolling_table_counts(
    tallies: DataFrame,
    time: Column,
    bucket_seconds: int = BUCKET_SECONDS,
    buckets: int = LIVE_BUCKETS,
    max_distinct: int | None = None,
) -> DataFrame:
    """Counts per table in every live window: a bucket and the ``buckets - 1`` before it.

    ``window_bucket`` is the number of the window's last bucket. Windows appear from the
    first bucket with data on, as long as they contain any. Rows are aggregated to
    buckets first; only those small sums are repeated for the windows they belong to.
    With ``max_distinct`` a bucket keeps that many names and merges the others.
    """
    return rolling_from_buckets(bucket_counts(tallies, time, bucket_seconds), buckets, max_distinct)


def window_report(window: DataFrame, n: int = 10) -> DataFrame:
    """Top tables of every window with their share of the window's rows.

    The rank filter limits what each task sends per window to ``n`` tables. Both branches
    ask for the same columns of ``window``, so its aggregation runs once.
    """
    totals = window.groupBy("window_bucket").agg(
        F.sum("rows").alias("total_rows"),
        F.sum("msgs").alias("total_msgs"),
        F.count(F.when(F.col("table_name") != OVERFLOW, 1)).alias("tables_distinct"),
    )
    order = Window.partitionBy("window_bucket").orderBy(F.desc("rows"), F.asc("table_name"))
    top = window.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)
    share = F.when(F.col("total_rows") > 0, F.col("rows") / F.col("total_rows") * 100).otherwise(0.0)
    return top.join(totals, "window_bucket").select(
        "window_bucket", "place", "table_name", "rows", "msgs",
        share.alias("share_pct"), "tables_distinct", "total_rows",
    )


def stream_bucket_counts(
    tallies: DataFrame,
    sink: str,
    checkpoint: str,
    time: str = "stored_at",
    seconds: int = BUCKET_SECONDS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Streaming form of ``bucket_counts``: every micro-batch adds its share of the buckets.

    Sums of a bucket combine when they are read, so no bucket waits to be closed, late
    tallies count like any other and no state is kept. A repeated batch replaces its own
    folder. ``read_bucket_counts`` and the window reports follow the stream as it grows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = bucket_counts(batch, F.col(time), seconds)
        counts.write.mode("overwrite").parquet(os.path.join(sink, f"batch={batch_id}"))

    writer = tallies.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


BUCKETS = "bucket bigint, table_name string, rows bigint, msgs bigint, first_seen bigint, batch string"


def read_bucket_counts(spark: SparkSession, sink: str) -> DataFrame:
    """The bucket counts of every batch so far, summed."""
    shares = spark.read.schema(BUCKETS).parquet(sink)
    return sum_counts(shares, "bucket", "table_name")


def rolling_from_buckets(counts: DataFrame, buckets: int = LIVE_BUCKETS, max_distinct: int | None = None) -> DataFrame:
    """``rolling_table_counts`` from bucket counts, of a batch or of a stream so far."""
    if max_distinct is not None:
        counts = fold_overflow(counts, max_distinct)
    ends = F.explode(F.sequence(F.col("bucket"), F.col("bucket") + buckets - 1))
    spread = counts.select(ends.alias("window_bucket"), "table_name", "rows", "msgs", "first_seen")
    return sum_counts(spread, "window_bucket", "table_name")
