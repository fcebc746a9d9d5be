"""Batches of a sink: repeated messages, failed writes, updates, added columns."""

import os

import pytest
from pyspark.sql import functions as F

from millrace.errors import InvalidPipelineError
from millrace.plans.pipeline import Pipeline
from millrace.sources import envelopes
from millrace.streaming import delivered, ingest, sinks

from .test_io import SPEC


def envelope_rows(spark, rows):
    """Envelopes of (sequence, payload)."""
    df = spark.createDataFrame([("s", i, p) for i, p in rows], "subject string, sequence bigint, payload string")
    return df.select("subject", "sequence", F.timestamp_seconds(F.lit(1)).alias("stored_at"), F.col("payload").cast("binary").alias("payload"))


def body(v, t, to="a"):
    return f'{{"v":{v},"to":"{to}","t":{t}}}'


def values(df):
    return sorted((r.table_name, r.ts_ns, r.v) for r in df.collect())


def test_a_batch_of_one_file_is_decoded_by_many_tasks(spark, tmp_path):
    inbox, tasks = str(tmp_path / "inbox"), []
    rows = envelope_rows(spark, [(i, body(i, i)) for i in range(400)])
    rows.coalesce(1).write.parquet(inbox)

    def count(batch, _):
        sizes = batch.groupBy(F.spark_partition_id()).count().collect()
        tasks.append(sorted(r["count"] for r in sizes))

    stream = ingest.identified(Pipeline(SPEC), envelopes.read_messages(spark, inbox, streaming=True, files_per_trigger=1))
    writer = stream.writeStream.foreachBatch(count).option("checkpointLocation", str(tmp_path / "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    (sizes,) = tasks
    assert sum(sizes) == 400 and max(sizes) <= 400 // spark.sparkContext.defaultParallelism


def test_messages_without_a_sequence_stay_apart(spark, tmp_path):
    """Four messages of one table and time, two batches, then all of them again."""
    sink, rows = str(tmp_path), [(None, body(v, 1)) for v in range(4)]
    for batch, part in enumerate([rows[:2], rows[2:], rows]):
        ingest.ingest_batch(Pipeline(SPEC), envelope_rows(spark, part), sink, str(batch))
    assert values(ingest.read_tables(spark, sink)) == [("a", 10**9, float(v)) for v in range(4)]


def test_outlying_times_open_their_own_bucket(spark, tmp_path):
    sink = str(tmp_path)
    for batch in range(3):
        rows = [(10 * batch + i, body(1, 3600 * (20 * batch + i))) for i in range(10)]
        ingest.ingest_batch(Pipeline(SPEC), envelope_rows(spark, rows), sink, str(batch))
    def asked(rows):
        parsed = ingest.identified(Pipeline(SPEC), envelope_rows(spark, rows))
        return delivered.suspects(parsed.select("message_key", delivered.bucket_of(F.col("ts_ns")).alias("bucket")), sink)

    # A new message at an old time opens nothing, one that came before only its own bucket.
    assert asked([(99, body(1, 3600 * 2)), (100, body(1, 3600 * 50))]) == []
    assert asked([(99, body(1, 3600 * 2)), (15, body(1, 3600 * 25))]) == [("0-1", 25)]


def test_runs_are_merged_and_still_known(spark, tmp_path):
    sink = str(tmp_path)
    def keys(batch):
        rows = spark.range(batch * 100, batch * 100 + 100)
        return rows.select(F.unhex(F.md5(F.col("id").cast("string"))).alias("message_key"), (F.col("id") * 10**12).alias("ts_ns"))

    for batch in range(9):
        delivered.mark_delivered(keys(batch), sink, str(batch))
        delivered.merge_runs(spark, sink, fan=3)
    assert delivered.live_runs(spark, sink) == ["2-8"]
    assert delivered.undelivered(keys(4), sink, "99").count() == 0
    # A batch that is repeated after its run was merged does not find itself.
    assert delivered.undelivered(keys(4), sink, "4").count() == 100
    assert delivered.undelivered(keys(9), sink, "99").count() == 100


def test_filters_know_their_keys():
    keys = [os.urandom(16) for _ in range(3000)]
    others = [os.urandom(16) for _ in range(20_000)]
    bits = delivered.filter_of(keys)
    assert delivered.known_to(bits, keys).all() and delivered.known_to(bits, others).mean() < 0.002
    assert delivered.known_to(delivered.filter_of(keys[:1]), keys[:1]).all()


@pytest.mark.parametrize("action", ["drop", "fail"])
def test_a_failed_write_sends_the_batch_back(spark, tmp_path, action):
    sink, seen = str(tmp_path), []
    good, flawed = [(1, body(1, 1)), (2, body(2, 2))], [(3, "{bad"), (4, '{"to":"a","t":3}')]
    def broken(rows, folder):
        ingest.write_tables(rows, folder)
        raise OSError("no space")

    def observer(row):
        seen.append((row["batch"], row["stage"], row["count"], bool(row["error"])))
        raise RuntimeError("ignored")

    messages = envelope_rows(spark, good + flawed)
    ingest.ingest_batch(Pipeline(SPEC, action), messages, sink, "0", write_rows=broken, observers=(observer,))
    assert ingest.read_tables(spark, sink).count() == 0
    back = envelopes.read_messages(spark, os.path.join(sink, "quarantine"))
    assert sorted(r.sequence for r in back.collect()) == ([1, 2, 4] if action == "drop" else [1, 2, 3, 4])
    assert all(r.payload for r in back.collect())
    first = ingest.read_commits(spark, sink).first()
    assert (first.fetched, first.rows_written, first.acks, first.nacks, first.write_failures) == (4, 0, 0, 4, 1)
    # What was sent back counts as new, as it never reached a table.
    ingest.ingest_batch(Pipeline(SPEC, action), back, sink, "1", observers=(observer,))
    rows = 3 if action == "drop" else 2
    assert ingest.read_tables(spark, sink).count() == rows
    second = ingest.read_commits(spark, sink).where("batch = '1'").first()
    assert (second.rows_written, second.write_failures) == (rows, 0)
    assert [s[:2] for s in seen] == [(b, s) for b in "01" for s in ("parse", "write", "quarantine", "commit")]
    assert seen[1] == ("0", "write", 0, True) and seen[5] == ("1", "write", rows, False)


def test_a_failed_write_may_stop_the_stream(spark, tmp_path):
    def broken(rows, folder):
        raise OSError("no space")

    with pytest.raises(OSError):
        ingest.ingest_batch(Pipeline(SPEC), envelope_rows(spark, [(1, body(1, 1))]), str(tmp_path), "0", write_rows=broken, on_failure="raise")
    assert not os.path.exists(tmp_path / "commits")
    with pytest.raises(InvalidPipelineError):
        ingest.Delivery("merge")
    with pytest.raises(InvalidPipelineError):
        ingest.Delivery(on_failure="skip")


def test_counters_follow_the_write(spark, tmp_path):
    """Rows that were delivered before are not written again, and not counted."""
    sink = str(tmp_path)
    ingest.ingest_batch(Pipeline(SPEC), envelope_rows(spark, [(1, body(1, 1)), (2, body(2, 2))]), sink, "0")
    ingest.ingest_batch(Pipeline(SPEC), envelope_rows(spark, [(2, body(2, 2)), (3, body(3, 3))]), sink, "1")
    found = {r.batch: (r.fetched, r.rows_written) for r in ingest.read_commits(spark, sink).collect()}
    assert found == {"0": (2, 2), "1": (2, 1)}


def test_upsert_over_batches_and_compaction(spark, tmp_path):
    sink, how = str(tmp_path), {"dedup_mode": "upsert"}
    batches = [[(5, body(1, 1)), (1, body(2, 2)), (9, body(9, 1, "b/c"))], [(2, body(3, 2)), (4, body(4, 1))], [(3, body(5, 2)), (6, body(6, 3))]]
    for batch, rows in enumerate(batches):
        ingest.ingest_batch(Pipeline(SPEC), envelope_rows(spark, rows), sink, str(batch), **how)
    want = [("a", 10**9, 1.0), ("a", 2 * 10**9, 5.0), ("a", 3 * 10**9, 6.0), ("b/c", 10**9, 9.0)]
    assert values(ingest.read_latest(spark, sink)) == want
    assert ingest.read_tables(spark, sink).count() == 7
    # Only tables of several batches are rewritten.
    assert sinks.compact_tables(spark, sink) == ["a"]
    assert values(ingest.read_tables(spark, sink)) == want
    assert sinks.compact_tables(spark, sink) == []
    # A batch after the compaction updates it, and so does one that is repeated.
    ingest.ingest_batch(Pipeline(SPEC), envelope_rows(spark, [(7, body(8, 2))]), sink, "3", **how)
    ingest.ingest_batch(Pipeline(SPEC), envelope_rows(spark, batches[1]), sink, "1", **how)
    want[1] = ("a", 2 * 10**9, 8.0)
    assert values(ingest.read_latest(spark, sink)) == want


def test_an_interrupted_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    sink = str(tmp_path)
    for batch, sequence in enumerate([1, 3, 2]):
        ingest.ingest_batch(Pipeline(SPEC), envelope_rows(spark, [(sequence, body(sequence, 1))]), sink, str(batch), dedup_mode="upsert")
    monkeypatch.setattr(sinks, "remove", lambda spark, path: None)
    sinks.compact_tables(spark, sink)
    assert values(ingest.read_latest(spark, sink)) == [("a", 10**9, 3.0)]
    assert ingest.read_tables(spark, sink).count() == 4


def test_added_columns_come_back(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("x", 1, 2.0)], "table_name string, ts_ns bigint, v double")
    second = spark.createDataFrame([("x", 2, "w", 3.0)], "table_name string, ts_ns bigint, w string, v double")
    third = spark.createDataFrame([("y", 3)], "table_name string, ts_ns bigint")
    for rows in (first, second, third, first):
        sinks.write_routed(rows, path)
    back = sinks.read_routed(spark, path)
    assert back.columns == ["ts_ns", "v", "w", "table_name"]
    assert sorted((r.ts_ns, r.v, r.w) for r in back.collect()) == [(1, 2.0, None), (1, 2.0, None), (2, 3.0, "w"), (3, None, None)]
    assert sorted(n for n in os.listdir(os.path.join(path, "_schema")) if n.startswith("version")) == ["version=1", "version=2"]
    wrong = spark.createDataFrame([("x", 1, "2")], "table_name string, ts_ns bigint, v string")
    with pytest.raises(InvalidPipelineError):
        sinks.write_routed(wrong, path)
    assert sinks.read_routed(spark, path).count() == 4
    # A replaced sink starts a new log.
    sinks.write_routed(wrong, path, "overwrite")
    assert [r.v for r in sinks.read_routed(spark, path).collect()] == ["2"]
