"""Session settings the operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Runtime SQL settings; none of them needs a restart.
SETTINGS = {
    # Timestamps without a zone are UTC.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of failing the message.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Batches of the codecs: bounded by bytes, as payloads may be large, and by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Generated methods beyond this size are never compiled by HotSpot; Spark then
    # generates one projection per operator, split into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Lets REBALANCE split a hot table and merge small ones before a write.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", app: str = "millrace") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording the call site of every column doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
