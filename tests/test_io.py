import base64
import gzip
import os

import pytest
from pyspark.sql import functions as F

from millrace.errors import InvalidPipelineError
from millrace.operators.rows import apply_policy
from millrace.operators.stats import outcome_counters, table_tallies
from millrace.plans.pipeline import Pipeline
from millrace.sources import detect, envelopes, lines
from millrace.streaming import ingest, rolling, sinks

SPEC = {
    "output": {"columns": [{"name": "v", "type": "double"}]},
    "transformations": [
        {"step": "parse_json"},
        {"step": "extract_field", "config": {"source": "v", "target": "v", "type": "float64"}},
        {"step": "extract_table", "config": {"source": "to"}},
        {"step": "extract_index", "config": {"source": "t", "format": "unix"}},
    ],
}


def envelope_rows(spark, payloads):
    rows = [("s", i, bytearray(p.encode())) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "subject string, sequence bigint, payload binary")
    return df.select("subject", "sequence", F.timestamp_seconds(F.col("sequence")).alias("stored_at"), "payload")


PAYLOADS = ['{"v":1,"to":"a","t":1}', '{"v":2,"to":"b","t":2}', '{"to":"a","t":3}', "{bad", '{"v":4,"to":"a","t":4}']


def test_json_lines(spark, tmp_path):
    path = str(tmp_path / "x.jsonl")
    with open(path, "w") as file:
        file.write('{"a":1}\n\n{"a":\n5\n   \n"x"\n{"a":1} y\n[1]\n')
    split = lines.read_jsonlines(spark, path)
    assert sorted(bytes(r.payload) for r in split.messages.collect()) == [b'"x"', b"5", b"[1]", b'{"a":1}']
    assert sorted(r.line for r in split.rejects.collect()) == ["   ", '{"a":', '{"a":1} y']


def test_base64_lines(spark, tmp_path):
    path = str(tmp_path / "x.b64")
    data = [b"", b"a", b"ab", b"abc", b"\x00\xff" * 500]
    with open(path, "w") as file:
        file.write("\n".join(base64.b64encode(d).decode() for d in data) + "\nab\nab=c\n!!!!\n ab==\nabc\n")
    split = lines.read_base64_lines(spark, path)
    assert sorted(bytes(r.payload) for r in split.messages.collect()) == sorted(d for d in data if d)
    assert sorted(r.line for r in split.rejects.collect()) == [" ab==", "!!!!", "ab", "ab=c", "abc"]


def test_detect_and_read(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "p"))
    for entry in os.listdir(tmp_path / "p"):
        if not entry.endswith(".parquet"):
            os.remove(tmp_path / "p" / entry)
    (tmp_path / "a.txt").write_text('\n  {"a":1}\n{"a":2}\nbad\n')
    (tmp_path / "b.gz").write_bytes(gzip.compress(b'{"a":3}\n'))
    (tmp_path / "c.bin").write_bytes(gzip.compress(b'{"a":4}\n{"a":5}'))
    (tmp_path / "d.csv").write_text("x,y\n")
    (tmp_path / "e").write_bytes(b"")
    found = {os.path.basename(r.path): (r.format, r.error) for r in detect.detect_format(spark, str(tmp_path)).collect()}
    kinds = {n: f for n, (f, _) in found.items() if not n.endswith(".parquet")}
    assert kinds == {"a.txt": "jsonl", "b.gz": "json.gz", "c.bin": "json.gz", "d.csv": None, "e": None}
    assert found["d.csv"][1] == "unknown file format" and found["e"][1] == "empty file"
    for name in ("d.csv", "e"):
        with pytest.raises(ValueError, match=name):
            detect.read_detected(spark, str(tmp_path))
        os.remove(tmp_path / name)
    read = detect.read_detected(spark, str(tmp_path))
    assert read["parquet"].count() == 3
    assert read["jsonl"].messages.count() == 2 and read["jsonl"].rejects.count() == 1
    assert sorted(bytes(r.payload) for r in read["json.gz"].messages.collect()) == [b'{"a":3}', b'{"a":4}', b'{"a":5}']


def matches(pattern, subject):
    """Subject matching token by token."""
    want, have = pattern.split("."), subject.split(".")
    for i, token in enumerate(want):
        if token == ">":
            return len(have) > i and all(have[i:])
        if i >= len(have) or (token != "*" and token != have[i]) or not have[i]:
            return False
    return len(want) == len(have)


def test_subjects(spark):
    subjects = ["a", "a.b", "a.b.c", "a.x.c", "ab.c", "a.b.c.d", "b.b", "a..c"]
    patterns = ["a", "a.b", "a.*", "a.*.c", "*.b", "a.>", ">", "*", "*.*.c", "a.b.>", "*.>"]
    df = spark.createDataFrame([(s,) for s in subjects], "subject string")
    flags = df.select("subject", *[envelopes.subject_condition(F.col("subject"), p).alias(str(i)) for i, p in enumerate(patterns)])
    for row in flags.collect():
        for i, pattern in enumerate(patterns):
            assert row[str(i)] == matches(pattern, row.subject), (pattern, row.subject)
    for bad in ("", "a..b", "a.>.b", "."):
        with pytest.raises(InvalidPipelineError):
            envelopes.subject_condition(F.col("subject"), bad)


def test_subject_prefix_reaches_the_scan(spark, tmp_path):
    envelope_rows(spark, PAYLOADS).write.parquet(str(tmp_path / "m"))
    df = envelopes.subject_filter(envelopes.read_messages(spark, str(tmp_path / "m")), "s.x.>")
    assert "StringStartsWith(subject,s.x.)" in df._jdf.queryExecution().executedPlan().toString()


def test_sequence_fallback(spark):
    df = spark.createDataFrame([(7, "a"), (None, "b"), (None, "c"), (None, "b")], "sequence bigint, subject string")
    values = [r.sequence for r in envelopes.with_sequence(df).collect()]
    assert values[0] == 7 and len(set(values)) == 3 and None not in values and values[1] == values[3]
    again = [r.sequence for r in envelopes.with_sequence(df.repartition(3)).collect()]
    assert sorted(again) == sorted(values)


def test_routed_write_and_csv(spark, tmp_path):
    rows = Pipeline(SPEC).transform(envelope_rows(spark, PAYLOADS))
    sinks.write_routed(rows, str(tmp_path / "t"))
    sinks.write_routed(rows, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert {r.table_name: r["count"] for r in back.groupBy("table_name").count().collect()} == {"a": 6, "b": 2}
    assert sorted(d for d in os.listdir(tmp_path / "t") if d.startswith("table")) == ["table_name=a", "table_name=b"]
    sinks.write_csv(rows, str(tmp_path / "c"))
    folder = tmp_path / "c" / "table_name=a"
    text = "".join((folder / f).read_text() for f in sorted(os.listdir(folder)) if f.endswith(".csv"))
    assert [line for line in text.splitlines() if line[0].isdigit()] == [
        "1000000000,0,1.0", "3000000000,2,", "4000000000,4,4.0",
    ]


def test_dedup(spark):
    rows = spark.createDataFrame(
        [("t", 1, 1, "a"), ("t", 1, 1, "a"), ("t", 1, 3, "b"), ("t", 1, 2, "c"), ("u", 1, 1, None), ("u", 1, 1, None)],
        "table_name string, ts_ns bigint, sequence bigint, v string",
    )
    assert sinks.dedup(rows, "disabled").count() == 6
    assert sinks.dedup(rows, "drop").count() == 4
    kept = {(r.table_name, r.sequence, r.v) for r in sinks.dedup(rows, "upsert").collect()}
    assert kept == {("t", 3, "b"), ("u", 1, None)}
    assert sinks.dedup(rows, "upsert", ["v"]).count() == 4
    with pytest.raises(InvalidPipelineError):
        sinks.dedup(rows, "merge")


def test_quarantine(spark, tmp_path):
    pipeline = Pipeline(SPEC, "fail")
    policy = apply_policy(pipeline.parse(envelope_rows(spark, PAYLOADS)), "fail")
    sinks.write_quarantine(policy.sent_back, str(tmp_path / "q"))
    again = envelopes.read_messages(spark, str(tmp_path / "q"))
    assert sorted(r.sequence for r in again.collect()) == [2, 3]
    assert apply_policy(pipeline.parse(again), "fail").sent_back.count() == 2


@pytest.mark.parametrize("action, tables, quarantined", [("drop", {"a": 3, "b": 1}, 0), ("fail", {"a": 2, "b": 1}, 2)])
def test_ingest_stream(spark, tmp_path, action, tables, quarantined):
    inbox, sink = str(tmp_path / "in"), str(tmp_path / "out")
    envelope_rows(spark, PAYLOADS).repartition(3).write.parquet(inbox)
    seen = []
    messages = envelopes.read_messages(spark, inbox, streaming=True, files_per_trigger=1)
    query = ingest.ingest_stream(Pipeline(SPEC, action), messages, sink, str(tmp_path / "cp"))
    query.awaitTermination()
    rows = ingest.read_tables(spark, sink)
    assert {r.table_name: r["count"] for r in rows.groupBy("table_name").count().collect()} == tables
    sent_back = spark.read.parquet(os.path.join(sink, "quarantine"))
    assert sent_back.count() == quarantined
    assert sent_back.filter("payload IS NULL").count() == 0
    ledger = spark.read.parquet(os.path.join(sink, "messages"))
    counters = outcome_counters(ledger, action=action).first()
    assert (counters.fetched, counters.nacks) == (5, quarantined) and seen == []
    # Nothing new: a restart adds nothing.
    messages = envelopes.read_messages(spark, inbox, streaming=True)
    ingest.ingest_stream(Pipeline(SPEC, action), messages, sink, str(tmp_path / "cp")).awaitTermination()
    assert ingest.read_tables(spark, sink).count() == sum(tables.values())


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    batch = envelope_rows(spark, PAYLOADS)
    for _ in range(2):
        ingest.ingest_batch(Pipeline(SPEC), batch, str(tmp_path), "7", "drop")
    assert ingest.read_tables(spark, str(tmp_path)).count() == 4


def test_observed_batches(spark, tmp_path):
    inbox = str(tmp_path / "in")
    envelope_rows(spark, PAYLOADS).write.parquet(inbox)
    seen = []

    def callback(metrics):
        seen.append(metrics)
        raise RuntimeError("ignored")

    observer = ingest.BatchObserver(callback)
    spark.streams.addListener(observer)
    try:
        parsed = Pipeline(SPEC).parse(envelopes.read_messages(spark, inbox, streaming=True))
        observed = ingest.observe_batches(parsed)
        query = (
            observed.select("sequence").writeStream.format("noop").trigger(availableNow=True)
            .option("checkpointLocation", str(tmp_path / "cp")).start()
        )
        query.awaitTermination()
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(observer)
    full = [m for m in seen if m.get("fetched")]
    assert full and full[0]["fetched"] == 5 and full[0]["dropped"] == 1 and full[0]["rows_written"] == 4


def test_dedup_stream(spark, tmp_path):
    rows = spark.range(20).select(
        F.lit("t").alias("table_name"), (F.col("id") % 10).alias("ts_ns"), (F.col("id") % 10).alias("sequence"),
        F.timestamp_seconds(F.col("id") % 10 + 1_000_000).alias("ts"),
    )
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = (
        ingest.dedup_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10
    assert ingest.dedup_stream(rows).count() == 10


def test_late_distinct_rows_stay(spark, tmp_path):
    # Later files hold earlier times, far behind any watermark.
    for at in (2_000_000, 1_000_000, 0):
        rows = spark.range(6).select(
            F.lit("t").alias("table_name"), (F.col("id") + at).alias("ts_ns"), F.col("id").alias("sequence"),
            F.timestamp_seconds(F.col("id") + at).alias("ts"),
        )
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = (
        ingest.dedup_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 18


def test_streamed_buckets_equal_batch(spark, tmp_path):
    tallies = spark.range(600).select(
        F.concat(F.lit("t"), F.col("id") % 7).alias("table_name"), F.lit(1).cast("bigint").alias("rows"),
        F.lit(1).cast("bigint").alias("msgs"), F.col("id").alias("sequence"),
        F.timestamp_seconds(F.col("id") - 300).alias("stored_at"),
    )
    tallies.repartition(4, F.xxhash64("sequence")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(tallies.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    sink = str(tmp_path / "out")
    rolling.stream_bucket_counts(stream, sink, str(tmp_path / "cp")).awaitTermination()
    key = lambda df: sorted(tuple(r) for r in df.select("bucket", "table_name", "rows", "msgs", "first_seen").collect())
    want = key(rolling.bucket_counts(tallies, F.col("stored_at")))
    assert key(rolling.read_bucket_counts(spark, sink)) == want and len(want) == 70
    streamed = rolling.rolling_from_buckets(rolling.read_bucket_counts(spark, sink))
    whole = rolling.rolling_table_counts(tallies, F.col("stored_at"))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, whole.collect()))


def test_digit_tables_and_empty_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("007", 1, 2.0), ("2024", 2, 3.0)], "table_name string, ts_ns bigint, value double")
    sinks.write_routed(rows, str(tmp_path / "a"))
    back = sinks.read_routed(spark, str(tmp_path / "a"))
    assert sorted(r.table_name for r in back.collect()) == ["007", "2024"]
    sinks.write_routed(rows.limit(0), str(tmp_path / "b"))
    assert sinks.read_routed(spark, str(tmp_path / "b")).collect() == []


def test_tallies_count_messages_and_rows(spark):
    parsed = Pipeline(SPEC).parse(envelope_rows(spark, PAYLOADS))
    assert {r.table_name: (r.rows, r.msgs) for r in table_tallies(parsed).collect()} == {"a": (3, 3), "b": (1, 1)}


def test_messages_of_one_row_group_are_built_by_many_tasks(spark, tmp_path):
    from workload import messages as m

    moment = F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ts")
    events = spark.range(400).select(F.col("id").alias("event_id"), moment, F.col("id").alias("user_id"),
                                     F.lit("view").alias("event_type"), F.lit(1.5).alias("value"), F.lit("{}").alias("props"))
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    built = m.event_messages(spark, str(tmp_path))
    sizes = [r["count"] for r in built.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 400 and max(sizes) <= 400 // spark.sparkContext.defaultParallelism
