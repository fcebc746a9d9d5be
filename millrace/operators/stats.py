"""Stream statistics over parsed messages, written rows and counter snapshots.

Every report aggregates before it shuffles; nothing sorts or windows raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.buckets import highest_bound, quantile_of
from .rows import UNUSABLE, is_dropped, is_sent_back

COUNTERS = (
    "fetched", "processed", "parse_failures", "dropped", "zero_rows", "rows_written", "acks", "nacks",
)


def written(parsed: DataFrame) -> DataFrame:
    """Kept messages that produce rows."""
    usable = (F.col("outcome") != UNUSABLE) & F.col("selected") & (F.col("n_rows") > 0)
    return parsed.filter(usable)


def table_tallies(parsed: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows and contributing messages per table, counted on messages before they explode."""
    return written(parsed).groupBy(*(by or []), "table_name").agg(
        F.sum("n_rows").alias("rows"), F.count(F.lit(1)).alias("msgs")
    )


def row_tallies(rows: DataFrame) -> DataFrame:
    """Rows per table of an already materialised output."""
    return rows.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"))


def counter_columns(action: str) -> dict[str, Column]:
    """Counter aggregates of parsed messages under a policy."""
    back, gone = is_sent_back(action), is_dropped(action)
    kept = ~back & ~gone

    def count(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    return {
        "fetched": F.count(F.lit(1)),
        "processed": count(~back),
        "parse_failures": count(back),
        "dropped": count(gone),
        "zero_rows": count(kept & (F.col("n_rows") == 0)),
        "rows_written": F.coalesce(
            F.sum(F.when(kept & F.col("selected"), F.col("n_rows"))), F.lit(0).cast("bigint")
        ),
        "acks": count(~back),
        "nacks": count(back),
    }


def outcome_counters(parsed: DataFrame, by: list[str] | None = None, action: str = "drop") -> DataFrame:
    """Message counters, overall or per group (for example per worker)."""
    columns = [column.alias(name) for name, column in counter_columns(action).items()]
    return parsed.groupBy(*(by or [])).agg(*columns)


def rollup_counters(counters: DataFrame, by: str = "worker") -> DataFrame:
    """Counters per worker plus one total row (worker NULL, ``is_total`` true)."""
    sums = [F.sum(c).cast("bigint").alias(c) for c in COUNTERS if c in counters.columns]
    return counters.rollup(by).agg(*sums, (F.grouping(by) == 1).alias("is_total"))


def state_counts(df: DataFrame, state: str = "state") -> DataFrame:
    return df.groupBy(state).agg(F.count(F.lit(1)).alias("n"))


# Histograms


def histogram(df: DataFrame, value: Column, bounds: list[float], by: list[str] | None = None) -> DataFrame:
    """Cumulative histogram in one pass: one row per bound plus the infinite one.

    Negative values count as 0, NULLs not at all. ``le`` is infinity on the last row, whose
    ``cumulative`` is the number of values; ``total`` is their sum.
    """
    keys = by or []
    observed = df.select(*keys, value.cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    clamped = observed.withColumn("__v", F.greatest("__v", F.lit(0.0)))
    counts = [F.count(F.when(F.col("__v") <= b, 1)) for b in bounds] + [F.count(F.lit(1))]
    summary = clamped.groupBy(*keys).agg(
        F.array(*counts).alias("cumulative"), F.coalesce(F.sum("__v"), F.lit(0.0)).alias("total")
    )
    edges = F.array(*[F.lit(b) for b in bounds], F.lit(float("inf")))
    pairs = F.explode(F.arrays_zip(edges.alias("le"), F.col("cumulative"))).alias("pair")
    rows = summary.select(*keys, "total", pairs)
    return rows.select(*keys, "pair.le", "pair.cumulative", "total")


def with_previous(
    df: DataFrame, order: str, columns: list[str], keys: list[str], chunk: Column
) -> DataFrame:
    """Add ``prev_<column>`` from the preceding row of the same keys, in ``order``.

    ``chunk`` must not decrease with ``order``. Rows are compared inside their chunk;
    the first row of a chunk gets the last row of the chunk before it, found in a
    table of one row per chunk. A key with most of the rows is thus spread over tasks.
    """
    work = df.withColumn("__chunk", chunk)
    fields = F.struct(F.col(order).alias("__order"), *[F.col(c) for c in columns])
    ends = work.groupBy(*keys, "__chunk").agg(F.max_by(fields, order).alias("__end"))
    by_chunk = Window.partitionBy(*keys).orderBy("__chunk")
    carried = ends.select(*keys, "__chunk", F.lag("__end").over(by_chunk).alias("__carried"))
    inside = Window.partitionBy(*keys, "__chunk").orderBy(order)
    lagged = work.withColumn("__inside", F.lag(fields).over(inside))
    condition = [lagged[k].eqNullSafe(carried[k]) for k in [*keys, "__chunk"]]
    joined = lagged.join(carried, condition, "left")
    previous = F.coalesce(F.col("__inside"), F.col("__carried"))
    return joined.select(
        *[lagged[c] for c in df.columns],
        *[previous.getField(c).alias(f"prev_{c}") for c in columns],
    )


def snapshot_arrays(snapshots: DataFrame, keys: list[str], snapshot: str) -> DataFrame:
    """One row per snapshot with its finite bounds and cumulative counts in order."""
    pairs = F.array_sort(F.collect_list(F.struct("le", "cumulative")))
    grouped = snapshots.groupBy(*keys, snapshot).agg(pairs.alias("pairs"))
    finite = F.filter("pairs", lambda p: p["le"] < float("inf"))
    return grouped.select(
        *keys,
        snapshot,
        F.transform(finite, lambda p: p["le"]).alias("bounds"),
        F.transform("pairs", lambda p: p["cumulative"]).alias("cumulative"),
    )


def interval_counts(
    snapshots: DataFrame, keys: list[str] | None = None, snapshot: str = "snapshot_id", chunk: int = 1000
) -> DataFrame:
    """Per-bucket counts between consecutive snapshots, the infinite tail last.

    Intervals whose bounds differ or whose counters went backwards are left out.
    A snapshot has as many rows as bounds, so grouping by it stays small.
    """
    keys = keys or []
    arrays = snapshot_arrays(snapshots, keys, snapshot)
    place = F.floor(F.col(snapshot) / chunk)
    pairs = with_previous(arrays, snapshot, ["bounds", "cumulative"], keys, place)
    risen = F.zip_with("cumulative", "prev_cumulative", lambda a, b: a - b)
    pairs = pairs.filter(F.col("bounds") == F.col("prev_bounds")).withColumn("risen", risen)
    counts = F.zip_with(
        "risen",
        F.concat(F.array(F.lit(0).cast("bigint")), F.slice("risen", 1, F.size("risen") - 1)),
        lambda a, b: a - b,
    )
    pairs = pairs.withColumn("counts", counts)
    valid = F.forall("counts", lambda c: c >= 0) & F.forall("risen", lambda c: c >= 0)
    return pairs.filter(valid).select(*keys, snapshot, "bounds", "counts")


def histogram_delta(
    snapshots: DataFrame, keys: list[str] | None = None, snapshot: str = "snapshot_id"
) -> DataFrame:
    """``interval_counts`` as one row per bucket."""
    keys = keys or []
    wide = interval_counts(snapshots, keys, snapshot)
    edges = F.concat("bounds", F.array(F.lit(float("inf"))))
    rows = wide.select(*keys, snapshot, F.explode(F.arrays_zip(edges.alias("le"), "counts")).alias("b"))
    return rows.select(*keys, snapshot, F.col("b.le").alias("le"), F.col("b.counts").alias("n"))


def lag_summary(
    snapshots: DataFrame, keys: list[str] | None = None, snapshot: str = "snapshot_id"
) -> DataFrame:
    """Samples, p50, p99 and highest bound of every interval that has samples."""
    keys = keys or []
    wide = interval_counts(snapshots, keys, snapshot)
    samples = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, c: a + c)
    wide = wide.withColumn("samples", samples).filter(F.col("samples") > 0)
    counts, bounds = F.col("counts"), F.col("bounds")
    return wide.select(
        *keys,
        snapshot,
        "samples",
        quantile_of(counts, bounds, 0.50).alias("p50"),
        quantile_of(counts, bounds, 0.99).alias("p99"),
        highest_bound(counts, bounds).alias("max_le"),
    )


def bucket_quantile(
    histogram_rows: DataFrame, q: float, keys: list[str]
) -> DataFrame:
    """Quantile of cumulative histogram rows (``le``, ``cumulative``), one row per key.

    ``keys`` must tell histograms apart: the rows of a key are one per bound and meet in
    one place.
    """
    if not keys:
        raise ValueError("bucket_quantile needs the keys of a histogram")
    pairs = F.array_sort(F.collect_list(F.struct("le", "cumulative")))
    grouped = histogram_rows.groupBy(*keys).agg(pairs.alias("pairs"))
    bounds = F.transform(F.filter("pairs", lambda p: p["le"] < float("inf")), lambda p: p["le"])
    cumulative = F.transform("pairs", lambda p: p["cumulative"])
    arrays = grouped.select(*keys, bounds.alias("bounds"), cumulative.alias("up"))
    shifted = F.concat(F.array(F.lit(0).cast("bigint")), F.slice("up", 1, F.size("up") - 1))
    arrays = arrays.withColumn("counts", F.zip_with("up", shifted, lambda a, b: a - b))
    return arrays.select(*keys, quantile_of(F.col("counts"), F.col("bounds"), q).alias("quantile"))


# Rates


def interval_rates(
    snapshots: DataFrame,
    counters: list[str],
    at: str = "at",
    keys: list[str] | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Per-second rates between consecutive snapshots over the measured time.

    A counter that went backwards has rate 0. Intervals without elapsed time and the
    first snapshot give no row. ``chunk`` (default: the day) bounds what one task sorts.
    """
    keys = keys or []
    place = F.date_trunc("day", F.col(at)) if chunk is None else chunk
    pairs = with_previous(snapshots, at, [at, *counters], keys, place)
    seconds = (F.unix_micros(F.col(at)) - F.unix_micros(F.col(f"prev_{at}"))) / 1e6
    pairs = pairs.withColumn("interval_s", seconds).filter(F.col("interval_s") > 0)
    rates = [
        F.when(F.col(c) < F.col(f"prev_{c}"), 0.0)
        .otherwise((F.col(c) - F.col(f"prev_{c}")) / F.col("interval_s"))
        .alias(f"{c}_per_s")
        for c in counters
    ]
    return pairs.select(*keys, at, "interval_s", *rates)


# Top tables and reconciliation

OVERFLOW = "other"


def top_tables(counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` tables with most rows and their share of all rows, ties by name.

    ``counts`` has ``table_name, rows, msgs``. The whole-window totals are scalar
    subqueries, so the ranking itself is a distributed top-n.
    """
    merged = counts.groupBy("table_name").agg(F.sum("rows").alias("rows"), F.sum("msgs").alias("msgs"))
    total = merged.agg(F.sum("rows")).scalar()
    distinct = merged.agg(F.count(F.when(F.col("table_name") != OVERFLOW, 1))).scalar()
    share = F.when(total > 0, F.col("rows") / total * 100).otherwise(0.0)
    # One projection right above the limit keeps it a top-n without a full sort.
    return merged.orderBy(F.desc("rows"), F.asc("table_name")).limit(n).select(
        "table_name",
        "rows",
        "msgs",
        share.alias("share_pct"),
        distinct.alias("tables_distinct"),
        total.alias("total_rows"),
    )


def reconcile_counts(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Row counts per table next to the expected ones, with the difference.

    Both sides are aggregated before they meet; a table missing on one side counts 0.
    """
    sides = actual.groupBy("table_name").agg(F.count(F.lit(1)).alias("actual"))
    sides = sides.withColumn("expected", F.lit(0).cast("bigint")).unionByName(
        expected.select("table_name", F.lit(0).cast("bigint").alias("actual"), F.col("rows").alias("expected"))
    )
    both = sides.groupBy("table_name").agg(
        F.sum("actual").alias("actual"), F.sum("expected").alias("expected")
    )
    return both.withColumn("missing", F.col("expected") - F.col("actual"))
