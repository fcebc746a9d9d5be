"""Time the headline queries and print one JSON line.

Every query runs to completion into a no-op sink; the better of two timed runs counts.
``rates`` relates the input messages or output rows to that time.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from millrace.functions import text  # noqa: E402
from millrace.session import local_session  # noqa: E402
from millrace.streaming.sinks import write_routed  # noqa: E402
from workload.messages import work_folder  # noqa: E402
from workload.queries import QUERIES, series_pipeline  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Query -> table whose rows are the messages it reads.
HEADLINE = {
    "ingest_event_tallies": "events",
    "ingest_event_rows": "events",
    "classify_messages": "events",
    "compute_chain": "customer",
    "timestamp_formats": "events",
    "gzip_base64_roundtrip": "orders",
    "explode_fixed_interval": "embeddings",
    "waveform_pipeline": "embeddings",
    "unpack_integers": "lineitem",
    "unpack_scaled": "embeddings",
    "map_entry": "events",
    "protobuf_decode": "events",
    "write_routed": "events",
    "dedup_drop": "events",
    "dedup_upsert": "events",
    "lag_histogram": "lineitem",
    "lag_summary": "events",
    "interval_rates": "events",
    "top_tables": "events",
    "rolling_table_counts": "events",
    "compare_tables": "orders",
}


def series_write(spark) -> Callable[[], None]:
    """100 messages of 8192 samples, decoded, exploded and written to routed tables."""
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    group = F.floor(F.col("vec_id") / 128)
    samples = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))), lambda x: x["embedding"]))
    long = vectors.groupBy(group.alias("g")).agg(samples.alias("parts")).filter(F.size("parts") == 8192)
    copies = long.select("parts", F.explode(F.sequence(F.lit(1), F.lit(100))).alias("copy")).limit(100)
    body = F.to_json(F.struct(
        F.col("parts").cast("array<double>").alias("parts"), F.lit("v").alias("vector"), F.lit("0").alias("label"),
        F.lit(1_700_000_000_500).alias("seen"),
    ))
    now = F.current_timestamp()
    messages = copies.select(F.lit("vectors").alias("subject"), F.monotonically_increasing_id().alias("sequence"),
                             now.alias("stored_at"), body.cast("binary").alias("payload"))
    folder = work_folder(spark)
    messages.repartition(int(CPUS), "sequence").write.parquet(f"{folder}/in")
    rows = series_pipeline({"value": "200us"}).transform(spark.read.parquet(f"{folder}/in"))

    def run() -> None:
        write_routed(rows, f"{folder}/out", "overwrite")

    return run


def shard_names(spark) -> Callable[[], None]:
    """Hash, slice and concatenate 20 million ids."""
    ids = F.concat(F.lit("id-"), F.col("id").cast("string"))
    names = spark.range(20_000_000).select(text.shard_name(ids, "t/").alias("name"))
    return lambda: names.write.mode("overwrite").format("noop").save()


# The configurations whose figures are published: name -> (preparation, units of work).
PUBLISHED = {"series_write_100x8192": (series_write, 819_200), "shard_names_20m": (shard_names, 20_000_000)}


def main() -> None:
    spark = local_session(CPUS, "bench")
    # The tables are single small files: split them over the task slots.
    spark.conf.set("spark.sql.files.minPartitionNum", CPUS)
    spark.conf.set("spark.sql.files.openCostInBytes", "65536")
    sizes = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").count() for t in set(HEADLINE.values())}
    times: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            begin = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.mode("overwrite").format("noop").save()
            runs.append(time.perf_counter() - begin)
        times[name] = round(min(runs[1:]), 3)
    published = {}
    for name, (prepare, units) in PUBLISHED.items():
        run, runs = prepare(spark), []
        for _ in range(3):
            begin = time.perf_counter()
            run()
            runs.append(time.perf_counter() - begin)
        times[name] = round(min(runs[1:]), 3)
        published[f"{name}_per_s"] = round(units / times[name])
    rates = {f"{n}_inputs_per_s": round(sizes[t] / times[n]) for n, t in HEADLINE.items()}
    rates |= published
    for name in ("explode_fixed_interval", "waveform_pipeline", "unpack_scaled"):
        rates[f"{name}_rows_per_s"] = round(sizes["embeddings"] * 64 / times[name])
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "rates": rates,
        "config": {"master": f"local[{CPUS}]", "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions")},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
