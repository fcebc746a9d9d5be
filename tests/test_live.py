"""Reports and histograms by the wall clock."""

import os

from pyspark.sql import functions as F

from millrace.streaming import live


def tallies(spark, rows):
    return spark.createDataFrame(rows, "table_name string, rows bigint, msgs bigint, sequence bigint")


def report(spark, sink, now, **how):
    return [(r.table_name, r.rows, r.msgs, round(r.share_pct, 3), r.tables_distinct, r.total_rows) for r in live.report_at(spark, sink, now, **how).orderBy("place").collect()]


def test_the_window_moves_with_the_clock(spark, tmp_path):
    sink = str(tmp_path)
    assert report(spark, sink, 600.0) == []
    live.add_tallies(tallies(spark, [("a", 3, 1, 5), ("b", 1, 1, 6), ("a", -4, 1, 7)]), sink, 0, 600.0)
    live.add_tallies(tallies(spark, [("b", 6, 2, 8)]), sink, 1, 700.0)
    assert report(spark, sink, 719.0) == [("b", 7, 3, 70.0, 2, 10), ("a", 3, 2, 30.0, 2, 10)]
    assert report(spark, sink, 719.0, n=1) == [("b", 7, 3, 70.0, 2, 10)]
    # No batch comes, but the first bucket leaves the window, then the second.
    assert report(spark, sink, 900.0) == [("b", 6, 2, 100.0, 1, 6)]
    assert report(spark, sink, 960.0) == []


def test_names_beyond_the_cap_by_arrival(spark, tmp_path):
    sink = str(tmp_path)
    # Later batches come later, whatever their sequences.
    live.add_tallies(tallies(spark, [("late", 1, 1, 90), ("z", 1, 1, 80)]), sink, 0, 60.0)
    live.add_tallies(tallies(spark, [("a", 5, 1, 1), ("z", 5, 1, 2)]), sink, 1, 61.0)
    assert report(spark, sink, 62.0, max_distinct=2) == [("z", 6, 2, 50.0, 2, 12), ("other", 5, 1, 41.667, 2, 12), ("late", 1, 1, 8.333, 2, 12)]


def test_a_repeated_batch_counts_once(spark, tmp_path):
    sink = str(tmp_path)
    for now in (60.0, 61.0, 130.0):
        live.add_tallies(tallies(spark, [("a", 2, 1, 1)]), sink, 7, now)
    assert report(spark, sink, 140.0) == [("a", 2, 1, 100.0, 1, 2)]


def test_old_buckets_go(spark, tmp_path):
    inbox, sink, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    rows = tallies(spark, [("a", 1, 1, 1)])
    for minute in (0, 3, 20):
        rows.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(rows.schema).parquet(inbox)
        live.stream_window_reports(stream, sink, checkpoint, lambda minute=minute: 60.0 * minute, keep_buckets=0).awaitTermination()
    assert sorted(d for d in os.listdir(os.path.join(sink, "live")) if d.startswith("b")) == ["bucket=20"]
    found = {r.batch: (r.window_bucket, r.total_rows) for r in live.read_reports(spark, sink).collect()}
    assert found == {0: (0, 1), 1: (3, 2), 2: (20, 1)}


def test_histograms_over_batches(spark, tmp_path):
    sink = str(tmp_path)
    batches = [[90.0, 99.5], [], [None, 100.5], [60.0] * 5]
    for batch, times in enumerate(batches):
        df = spark.createDataFrame([(t,) for t in times], "t double").select(F.timestamp_seconds("t").alias("at"))
        live.add_observations(df, sink, batch, 100.0, F.col("at"))
    for chunk in (1, 2, 1000):
        lags = live.read_histograms(spark, sink, "lag", chunk).collect()
        found = {(r.snapshot_id, r.le): (r.cumulative, round(r.total, 3)) for r in lags}
        # A time after the clock is a lag of 0, a missing one is none.
        assert {k[0] for k in found} == {0, 2, 3}
        assert found[0, 0.512] == (1, 10.5) and found[2, 0.001] == (1, 10.5) and found[3, float("inf")] == (8, 210.5)
        sizes = live.read_histograms(spark, sink, "batch_size", chunk).collect()
        found = {(r.snapshot_id, r.le): r.cumulative for r in sizes}
        assert {k[0] for k in found} == {0, 2, 3} and found[3, 2.0] == 2 and found[3, 8.0] == 3 and found[0, 1.0] == 0
