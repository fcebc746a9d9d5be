"""The pipeline as a stream: micro-batches in, routed tables and quarantine out."""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..errors import InvalidPipelineError
from ..operators.rows import apply_policy, is_sent_back
from ..operators.stats import COUNTERS, counter_columns
from ..plans.pipeline import Pipeline
from .delivered import mark_delivered, merge_runs, message_key, undelivered
from .sinks import DEDUP_MODES, by_table, dedup, latest_rows, log_schema, quarantine_rows, read_routed


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for stream checkpoints: the cluster's, else ``fallback``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = configured or fallback
    if root is None:
        raise ValueError("set spark.checkpoint.dir or pass a checkpoint folder")
    return root


@dataclass(frozen=True)
class Delivery:
    """How parsed messages become rows of a sink.

    ``dedup_mode`` is one of ``DEDUP_MODES``; under ``upsert`` rows of equal table, time and
    ``upsert_keys`` replace each other over all batches. ``write_rows`` writes the rows of a
    batch to a folder, returns their number and may raise. ``on_failure`` says what then happens: ``send_back``
    puts the batch's messages into quarantine and goes on, ``raise`` stops the stream,
    which repeats the batch when it starts again. ``observers`` are called after every
    stage; their errors are ignored.
    """

    dedup_mode: str = "drop"
    upsert_keys: tuple[str, ...] = ()
    write_rows: Callable[[DataFrame, str], int] | None = None
    on_failure: str = "send_back"
    observers: tuple[Callable[[dict], None], ...] = ()

    def __post_init__(self):
        if self.dedup_mode not in DEDUP_MODES:
            raise InvalidPipelineError(f"dedup mode must be one of {', '.join(DEDUP_MODES)}")
        if self.on_failure not in ("send_back", "raise"):
            raise InvalidPipelineError(f"on_failure must be send_back or raise, got {self.on_failure!r}")


def ingest_batch(pipeline: Pipeline, messages: DataFrame, sink: str, batch: str, dedup_mode: str = "drop", **how) -> None:
    """Write one batch of messages so that a repeat of it replaces its own output."""
    write_parsed(pipeline, identified(pipeline, messages), sink, batch, Delivery(dedup_mode, **how))


def identified(pipeline: Pipeline, messages: DataFrame) -> DataFrame:
    """Parsed messages with the key that tells a second delivery."""
    parsed = pipeline.parse(messages)
    have = {c: F.col(c) if c in parsed.columns else F.lit(None) for c in ("subject", "sequence", "payload")}
    return parsed.withColumn("message_key", message_key(*have.values(), F.col("table_name"), F.col("ts_ns")))


def stripped(pipeline: Pipeline, parsed: DataFrame) -> DataFrame:
    """Parsed messages with payloads only where they go back."""
    return parsed.withColumn("payload", F.when(is_sent_back(pipeline.action), F.col("payload")))


def write_tables(rows: DataFrame, folder: str) -> int:
    """Write the rows of a batch, one folder for each table; their number is in the footers."""
    by_table(rows).write.mode("overwrite").partitionBy("table_name").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder).count()


class Stages:
    """Counts and durations of a batch's stages, told to the observers as they end."""

    def __init__(self, batch: str, observers):
        self.batch, self.observers, self.rows, self.began = batch, observers, [], time.monotonic()

    def end(self, stage: str, count: int, error: str | None = None) -> None:
        now = time.monotonic()
        row = {"batch": self.batch, "stage": stage, "count": count, "duration_ms": int((now - self.began) * 1000), "error": error}
        self.began = now
        self.rows.append(row)
        for observer in self.observers:
            try:
                observer(dict(row))
            except Exception:  # observers must not break the batch
                pass


def write_parsed(pipeline: Pipeline, parsed: DataFrame, sink: str, batch: str, delivery: Delivery) -> None:
    """Write a batch of parsed messages, and its commit record at the end.

    They are written once under ``sink/messages``; rows, quarantine and statistics read
    that table, so no decode runs twice and a lost executor costs only its own tasks. Only
    a batch that fails reads its messages again, as the payloads go back with them.
    """
    spark, action = parsed.sparkSession, pipeline.action
    stages = Stages(batch, delivery.observers)
    parsed_path = os.path.join(sink, "messages", f"batch={batch}")
    lean = stripped(pipeline, parsed)
    lean.write.mode("overwrite").parquet(parsed_path)
    stored = spark.read.schema(lean.schema).parquet(parsed_path)
    counters = stored.agg(*[c.alias(n) for n, c in counter_columns(action).items()]).first().asDict()
    stages.end("parse", counters["fetched"])
    policy = apply_policy(stored, action)
    kept = policy.kept
    if delivery.dedup_mode == "drop":
        kept = undelivered(kept, sink, batch)
    rows = dedup(pipeline.rows(kept), delivery.dedup_mode, list(delivery.upsert_keys))
    folder = os.path.join(sink, "tables", f"batch={batch}")
    quarantine = quarantine_rows(policy.sent_back)
    log_schema(rows, sink)
    failure = None
    try:
        counters["rows_written"] = (delivery.write_rows or write_tables)(rows, folder)
    except Exception as error:  # whatever the sink raises
        if delivery.on_failure == "raise":
            stages.end("write", 0, str(error))
            raise
        failure = f"{type(error).__name__}: {error}"[:500]
        write_tables(rows.limit(0), folder)
        counters["rows_written"] = 0
        back = apply_policy(parsed, action).kept.withColumn("errors", failed_write(failure))
        quarantine = quarantine.unionByName(quarantine_rows(back))
        # As if the whole batch had not been acknowledged.
        counters["acks"], counters["nacks"] = 0, counters["fetched"]
    counters["write_failures"] = int(failure is not None)
    stages.end("write", counters["rows_written"], failure)
    quarantine.write.mode("overwrite").parquet(os.path.join(sink, "quarantine", f"batch={batch}"))
    stages.end("quarantine", counters["nacks"])
    if delivery.dedup_mode == "drop":
        mark_delivered(kept if failure is None else kept.limit(0), sink, batch)
    write_commit(spark, sink, batch, counters, stages)
    if delivery.dedup_mode == "drop":
        merge_runs(spark, sink)


def failed_write(message: str) -> Column:
    """The errors of a message whose batch could not be written."""
    entry = F.struct(F.lit("write").alias("step"), F.lit(False).alias("structural"), F.lit(message).alias("message"))
    return F.concat("errors", F.array(entry))


COMMIT = ", ".join(f"{name} bigint" for name in (*COUNTERS, "write_failures"))
STAGES = "array<struct<stage:string,count:bigint,duration_ms:bigint,error:string>>"


def write_commit(spark: SparkSession, sink: str, batch: str, counters: dict, stages: Stages) -> None:
    """The record that says how a batch ended. It comes last, so a batch with one is complete."""
    stages.end("commit", counters["acks"])
    values = [int(counters[name]) for name in (*COUNTERS, "write_failures")]
    steps = [(s["stage"], s["count"], s["duration_ms"], s["error"]) for s in stages.rows]
    record = spark.createDataFrame([(*values, steps)], f"{COMMIT}, stages {STAGES}")
    record.coalesce(1).write.mode("overwrite").parquet(os.path.join(sink, "commits", f"batch={batch}"))


def read_commits(spark: SparkSession, sink: str) -> DataFrame:
    """How every batch ended: its counters, taken after the write, and its stages."""
    return spark.read.schema(f"{COMMIT}, stages {STAGES}, batch string").parquet(os.path.join(sink, "commits"))


def read_stages(spark: SparkSession, sink: str) -> DataFrame:
    """``batch, stage, count, duration_ms, error`` of every stage of every batch."""
    return read_commits(spark, sink).select("batch", F.inline("stages"))


def ingest_stream(
    pipeline: Pipeline,
    messages: DataFrame,
    sink: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    dedup_mode: str = "drop",
    **how,
) -> StreamingQuery:
    """Run a pipeline over a stream of envelopes.

    Offsets are committed after the batch is written, so delivery is at least once; a
    repeated batch overwrites its own folder. With ``drop``, a message that is delivered
    again in any later batch adds no rows; with ``upsert``, ``read_latest`` gives the rows
    as the batches have left them. ``how`` are the other settings of ``Delivery``.
    ``trigger`` defaults to ``availableNow``. The pipeline's plan is built once, for the
    stream.
    """
    delivery = Delivery(dedup_mode, **how)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_parsed(pipeline, batch, sink, str(batch_id), delivery)

    location = os.path.join(checkpoint or checkpoint_root(messages.sparkSession), "ingest")
    writer = identified(pipeline, messages).writeStream.foreachBatch(write).option("checkpointLocation", location)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_tables(spark: SparkSession, sink: str) -> DataFrame:
    """Every routed row of a sink; filters on ``table_name`` prune whole folders."""
    return read_routed(spark, sink, "tables", batch="string")


def read_latest(spark: SparkSession, sink: str, keys: list[str] | None = None) -> DataFrame:
    """The rows of an ``upsert`` sink: per table, time and ``keys`` the highest sequence of
    all batches. A filter on table, time or keys applies before rows are compared."""
    return latest_rows(read_tables(spark, sink).drop("batch"), keys)


def dedup_stream(
    rows: DataFrame, delay: str | None = None, time: str = "ts", keys: list[str] | None = None
) -> DataFrame:
    """Drop redelivered rows of a stream, however late they come.

    The state holds the keys seen. With ``delay`` it forgets keys older than the watermark,
    and rows later than that are lost, repeated or not; give one only if none can be that
    late. ``ingest_stream`` needs no such state: it looks into what it has written. Works on
    a batch too.
    """
    names = keys or ["table_name", "ts_ns", "sequence"]
    if not rows.isStreaming or delay is None:
        return rows.dropDuplicates(names)
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(names)


def observe_batches(parsed: DataFrame, name: str = "ingest", action: str = "drop") -> DataFrame:
    """Attach the message counters to a plan; they arrive with every batch's progress."""
    return parsed.observe(name, *[c.alias(n) for n, c in counter_columns(action).items()])


class BatchObserver(StreamingQueryListener):
    """Calls ``callback`` with the metrics of every batch; a failing callback is ignored."""

    def __init__(self, callback: Callable[[dict], None], name: str = "ingest"):
        self.callback = callback
        self.name = name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(self.name)
        metrics = row.asDict() if row is not None else {}
        metrics["batch_id"] = progress.batchId
        metrics["input_rows"] = progress.numInputRows
        metrics["duration_ms"] = dict(progress.durationMs)
        try:
            self.callback(metrics)
        except Exception:  # observers must not break the batch
            pass
