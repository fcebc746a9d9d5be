import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.operators import stats
from millrace.operators.compare import compare_tables, comparison_summary
from millrace.streaming import rolling

INF = math.inf


def test_histogram(spark):
    df = spark.createDataFrame([(-5.0,), (0.5,), (1.0,), (3.0,), (99.0,), (None,)], "v double")
    rows = stats.histogram(df, F.col("v"), [1.0, 2.0, 4.0]).orderBy("le").collect()
    assert [(r.le, r.cumulative) for r in rows] == [(1.0, 3), (2.0, 3), (4.0, 4), (INF, 5)]
    assert rows[0].total == 103.5
    empty = stats.histogram(df.filter("v > 1000"), F.col("v"), [1.0]).collect()
    assert [(r.le, r.cumulative, r.total) for r in empty] == [(1.0, 0, 0.0), (INF, 0, 0.0)]


def snapshots(spark, *tables):
    rows = [(i, le, n) for i, table in enumerate(tables) for le, n in table.items()]
    return spark.createDataFrame(rows, "snapshot_id bigint, le double, cumulative bigint")


def test_interval_counts(spark):
    df = snapshots(
        spark,
        {0.001: 0, 0.002: 0, INF: 0},
        {0.001: 1, 0.002: 2, INF: 2},
        {0.001: 1, 0.002: 2, INF: 5},  # only the tail grew
        {0.001: 0, 0.002: 2, INF: 6},  # a counter went backwards
        {0.001: 0, 0.004: 2, INF: 6},  # other bounds
        {0.001: 0, 0.004: 2, INF: 6},  # idle
    )
    got = {r.snapshot_id: r.counts for r in stats.interval_counts(df).collect()}
    assert got == {1: [1, 1, 0], 2: [0, 0, 3], 5: [0, 0, 0]}
    delta = {(r.snapshot_id, r.le): r.n for r in stats.histogram_delta(df).collect()}
    assert delta[(2, INF)] == 3 and len(delta) == 9
    summary = {r.snapshot_id: r for r in stats.lag_summary(df).collect()}
    assert set(summary) == {1, 2}
    assert (summary[1].samples, summary[1].p50, summary[1].max_le) == (2, 0.001, 0.002)
    assert summary[1].p99 == pytest.approx(0.001 + 0.001 * 0.98)
    assert (summary[2].p50, summary[2].max_le) == (0.002, 0.002)


def test_cumulative_drop_inside_an_interval_is_rejected(spark):
    df = snapshots(spark, {1.0: 0, 2.0: 0, INF: 0}, {1.0: 5, 2.0: 3, INF: 6})
    assert stats.interval_counts(df).count() == 0


def test_previous_row_across_chunks(spark):
    """Chunked predecessor equals the plain one, with a dominating key and gaps."""
    random.seed(3)
    rows = [(random.choice("aaab"), at, at * 2) for at in random.sample(range(5000), 400)]
    rows += [(None, 17, 1), (None, 4900, 2)]
    df = spark.createDataFrame(rows, "k string, at bigint, v bigint")
    got = stats.with_previous(df, "at", ["at", "v"], ["k"], F.floor(F.col("at") / 100)).collect()
    by_key = defaultdict(list)
    for k, at, v in rows:
        by_key[k].append((at, v))
    want = {}
    for k, items in by_key.items():
        items.sort()
        for before, (at, _) in zip([(None, None)] + items, items):
            want[(k, at)] = before
    assert {(r.k, r.at): (r.prev_at, r.prev_v) for r in got} == want and len(got) == len(rows)


def test_interval_rates(spark):
    start = dt.datetime(2024, 1, 1, 23, 59, 50)
    ticks = [(0, 0, 5), (10, 100, 5), (15, 50, 9), (15, 60, 9), (35, 60, 19)]
    rows = [(start + dt.timedelta(seconds=s), a, b) for s, a, b in ticks]
    df = spark.createDataFrame(rows, "at timestamp, msgs bigint, rows bigint")
    got = stats.interval_rates(df.filter("msgs <> 60 OR rows <> 9"), ["msgs", "rows"]).orderBy("at").collect()
    assert [(r.interval_s, r.msgs_per_s, r.rows_per_s) for r in got] == [
        (10.0, 10.0, 0.0), (5.0, 0.0, 0.8), (20.0, 0.5, 0.5),
    ]
    # Two snapshots of one instant span no time.
    assert stats.interval_rates(df.filter("msgs = 50 OR rows = 9"), ["msgs"]).count() == 0


def test_top_tables(spark):
    df = spark.createDataFrame(
        [("b", 5, 1), ("a", 5, 2), ("c", 1, 1), ("other", 9, 9), ("c", 2, 1)], "table_name string, rows bigint, msgs bigint"
    )
    got = stats.top_tables(df, 3).collect()
    assert [(r.table_name, r.rows, r.msgs) for r in got] == [("other", 9, 9), ("a", 5, 2), ("b", 5, 1)]
    assert got[0].total_rows == 22 and got[0].tables_distinct == 3
    assert got[1].share_pct == pytest.approx(5 / 22 * 100)
    assert stats.top_tables(df.filter("false")).count() == 0
    zero = stats.top_tables(spark.createDataFrame([("a", 0, 0)], df.schema)).first()
    assert zero.share_pct == 0.0
    assert "TakeOrderedAndProject" in stats.top_tables(df)._jdf.queryExecution().executedPlan().toString()


def test_rollup(spark):
    columns = ", ".join(f"{c} bigint" for c in stats.COUNTERS)
    df = spark.createDataFrame([("w1", *range(8)), ("w2", *range(8)), (None, *range(8))], f"worker string, {columns}")
    rows = stats.rollup_counters(df).collect()
    total = [r for r in rows if r.is_total]
    assert len(rows) == 4 and len(total) == 1 and [total[0][c] for c in stats.COUNTERS] == [3 * i for i in range(8)]


def test_states_and_reconciliation(spark):
    df = spark.createDataFrame([("closed",), ("open",), ("closed",)], "state string")
    assert {r.state: r.n for r in stats.state_counts(df).collect()} == {"closed": 2, "open": 1}
    actual = spark.createDataFrame([("a",), ("a",), ("x",)], "table_name string")
    expected = spark.createDataFrame([("a", 3), ("b", 1)], "table_name string, rows bigint")
    got = {r.table_name: (r.actual, r.expected, r.missing) for r in stats.reconcile_counts(actual, expected).collect()}
    assert got == {"a": (2, 3, 1), "b": (0, 1, 1), "x": (1, 0, -1)}


def brute_windows(events, buckets, cap):
    """Arrival-ordered counting with a cap on names per bucket, summed over live windows."""
    by_bucket = defaultdict(dict)
    for second, name in events:
        counts = by_bucket[second // 60]
        key = name if name in counts or len([n for n in counts if n != "other"]) < cap else "other"
        counts[key] = counts.get(key, 0) + 1
    windows = defaultdict(lambda: defaultdict(int))
    for bucket, counts in by_bucket.items():
        for end in range(bucket, bucket + buckets):
            for name, n in counts.items():
                windows[end][name] += n
    return {(end, name): n for end, counts in windows.items() for name, n in counts.items()}


@pytest.mark.parametrize("cap", [2, 5, 100])
def test_rolling_windows_match_counting_in_order(spark, cap):
    random.seed(cap)
    events = sorted((random.randrange(1200), random.choice("aaaaabcdefgh")) for _ in range(800))
    rows = [(name, 1, 1, i, dt.datetime.fromtimestamp(s, dt.timezone.utc)) for i, (s, name) in enumerate(events)]
    df = spark.createDataFrame(rows, "table_name string, rows bigint, msgs bigint, sequence bigint, at timestamp")
    window = rolling.rolling_table_counts(df, F.col("at"), max_distinct=cap)
    got = {(r.window_bucket, r.table_name): r.rows for r in window.collect()}
    assert got == brute_windows(events, 5, cap)
    report = rolling.window_report(window, 2).collect()
    totals = defaultdict(int)
    for (end, _), n in got.items():
        totals[end] += n
    assert len(report) == sum(min(2, len([1 for e, _ in got if e == end])) for end in totals)
    for row in report:
        assert row.total_rows == totals[row.window_bucket]
        assert row.share_pct == pytest.approx(100 * row.rows / row.total_rows)


def test_overflow_cut_happens_before_the_shuffle(spark):
    df = spark.range(1_000_000).select(
        F.lit("t").alias("table_name"), F.lit(1).alias("rows"), F.lit(1).alias("msgs"),
        F.col("id").alias("sequence"), F.timestamp_seconds("id").alias("at"),
    )
    plan = rolling.rolling_table_counts(df, F.col("at"), max_distinct=100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_compare(spark):
    golden = spark.createDataFrame(
        [(1, 1.0, "a"), (2, 2.0, "b"), (3, None, "c"), (4, 4.0, "d"), (5, 5.0, None), (6, 6.0, "f"), (None, 7.0, "g")],
        "k int, v double, s string",
    )
    actual = spark.createDataFrame(
        [(1, 1.0005, "a"), (2, 2.1, "B"), (3, None, "c"), (5, None, None), (6, 6.0, "f"), (6, 6.0, "f"), (8, 8.0, "h"), (None, 7.0, "g")],
        "k int, v double, s string",
    )
    found = {(r.k, r.issue, r.column_name, r.actual, r.golden) for r in compare_tables(actual, golden, ["k"]).collect()}
    assert found == {
        (2, "value", "v", "2.1", "2.0"), (2, "value", "s", "B", "b"), (4, "missing", None, "0", "1"),
        (5, "value", "v", None, "5.0"), (6, "duplicate", None, "2", "1"), (8, "extra", None, "1", "0"),
    }
    summary = comparison_summary(compare_tables(actual, golden, ["k"]))
    assert {(r.issue, r.column_name): r.n for r in summary.collect()}[("value", "v")] == 2
    assert compare_tables(golden, golden, ["k"]).count() == 0


def test_compare_repeated_keys_columns_and_text(spark):
    shape = "k int, v double, s string"
    golden = spark.createDataFrame([(1, 1.0, "2.0"), (2, 1.0, "a"), (2, 2.0, "b"), (3, 1.0, "x"), (3, 1.0, "x")], shape)
    actual = spark.createDataFrame([(1, 1.0, "2.0004"), (2, 2.0, "b"), (2, 9.0, "a"), (3, 1.0, "x"), (3, 1.0, "x")], shape)
    found = {tuple(r) for r in compare_tables(actual, golden, ["k"]).collect()}
    assert found == {(2, "rows", None, "1", "1")}
    sides = compare_tables(actual.drop("v").withColumn("w", F.lit(1)), golden, ["k"])
    assert {tuple(r) for r in sides.collect()} == {(None, "column", "v", None, "present"), (None, "column", "w", "present", None)}
    texts = compare_tables(actual.withColumn("s", F.lit("word")), golden, ["k"]).filter("k = 1")
    assert [tuple(r) for r in texts.collect()] == [(1, "value", "s", "word", "2.0")]
