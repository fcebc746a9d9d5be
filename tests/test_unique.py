import os

import pytest
from pyspark.sql import functions as F

from millrace.streaming.unique import read_unique, unique_stream, write_unique

HOUR = 3_600_000_000_000
SCHEMA = "table_name string, ts_ns bigint, sequence bigint, note string"


def send(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def run(spark, tmp_path, **how):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = unique_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), **how)
    query.awaitTermination()
    return query


def test_late_repeats_go_and_late_first_rows_stay(spark, tmp_path):
    first = [("t", i * HOUR, i, "a") for i in range(100, 110)]
    send(spark, tmp_path, first)
    send(spark, tmp_path, [("t", i * HOUR, i, "b") for i in range(5)] + first[:4] + [("t", None, 1, "c"), ("t", None, 1, "c")])
    query = run(spark, tmp_path)
    assert query.lastProgress["stateOperators"] == []
    # The stream starts again and gets everything anew, and rows of the oldest times.
    send(spark, tmp_path, first + [("t", 2 * HOUR, 2, "d"), ("t", 2 * HOUR, None, "e"), ("u", 2 * HOUR, 2, "f"), ("t", None, 1, "g")])
    run(spark, tmp_path)
    got = sorted(tuple(r) for r in read_unique(spark, str(tmp_path / "out")).select("table_name", "sequence", "note").collect() if r[1])
    want = [("t", i, "a") for i in range(100, 110)] + [("t", i, "b") for i in range(1, 5)] + [("t", 1, "c"), ("u", 2, "f")]
    assert got == sorted(want)
    assert read_unique(spark, str(tmp_path / "out")).filter("note = 'e'").count() == 1


def test_a_repeated_batch_replaces_its_rows_also_after_merging(spark, tmp_path):
    sink = str(tmp_path / "out")
    make = lambda a, b: spark.range(a, b).select(F.lit("t").alias("table_name"), F.col("id").alias("ts_ns"), F.col("id").alias("sequence"))
    for i in range(9):
        write_unique(make(i * 10, i * 10 + 20), sink, str(i))
    assert any(n.startswith("run=1-") for n in os.listdir(f"{sink}/delivered/keys"))
    write_unique(make(30, 50), sink, "3")
    rows = [r.sequence for r in read_unique(spark, sink).collect()]
    assert sorted(rows) == list(range(100))


def test_keys_are_told_apart(spark, tmp_path):
    sink = str(tmp_path / "out")
    rows = [("1", "2:3", b"\x01"), ("1", "2:3", b"\x01"), ("12", ":3", b"\x01"), (None, "-", b"\x01"), ("-", None, b"\x01"), (None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c binary").withColumn("at", F.lit(7))
    write_unique(df, sink, "0", ("a", "b", "c"), "at")
    write_unique(df, sink, "1", ("a", "b", "c"), "at")
    assert read_unique(spark, sink).count() == 5
    write_unique(df.withColumns({"a": F.concat("a", F.lit("x")), "more": F.lit(1)}), sink, "2", ("a", "b", "c"), "at")
    assert read_unique(spark, sink).count() == 8 and "more" in read_unique(spark, sink).columns
    write_unique(df.limit(0), str(tmp_path / "none"), "0", ("a", "b", "c"), "at")
    assert read_unique(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        write_unique(df.withColumn("l", F.array("a")), sink, "2", ("l",), "at")
    with pytest.raises(ValueError):
        unique_stream(spark.readStream.format("rate").load().withColumn("batch", F.lit(1)), sink)
