"""The example pipelines over messages made of the given tables."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from millrace.plans.pipeline import Pipeline, load_spec

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="fixture tables are not here")


def rows_of(example, messages):
    return Pipeline(load_spec(os.path.join(ROOT, "examples", example))).transform(messages)


def messages(df, sequence, body, subject="in.all"):
    subject = F.lit(subject) if isinstance(subject, str) else subject
    return df.select(subject.alias("subject"), sequence.cast("bigint").alias("sequence"), F.to_json(body).cast("binary").alias("payload"))


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def test_orders(spark):
    orders = table(spark, "orders")
    placed = F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 1000
    body = F.struct(
        F.struct(F.col("o_totalprice").alias("total")).alias("money"), F.col("o_custkey").alias("customer"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"), placed.cast("bigint").alias("placed"),
    )
    got = {r.sequence: r for r in rows_of("orders.yaml", messages(orders, F.col("o_orderkey"), body)).collect()}
    want = orders.withColumn("ms", placed.cast("bigint")).collect()
    assert len(got) == len(want)
    for o in want:
        r = got[o.o_orderkey]
        assert (r.table_name, r.total, r.customer) == (f"orders/{o.o_orderstatus}", o.o_totalprice, o.o_custkey)
        assert r.buyer == f"{o.o_orderpriority} by {o.o_custkey}" and r.entered == r.ts_ns == o.ms * 1_000_000


def test_shipments(spark):
    lines = table(spark, "lineitem").withColumn("key", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    pieces = F.when(F.col("l_quantity") > 40, "many").otherwise(F.col("l_quantity").cast("string"))
    body = F.struct(
        F.struct(pieces.alias("pieces"), F.col("l_returnflag").alias("flag"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("day")).alias("ship"),
        F.col("l_partkey").alias("part"),
    )
    rows = rows_of("shipments.yaml", messages(lines, F.col("key"), body)).collect()
    want = lines.filter("l_returnflag = 'R'").select("key", "l_quantity", "l_partkey").collect()
    number = lambda q: None if q > 40 else q
    assert {r.table_name for r in rows} == {"shipped_lines"} and {r.flag for r in rows} == {"R"}
    key = lambda r: tuple(map(str, r))
    got = sorted(((r.sequence, r.pieces, r.part) for r in rows), key=key)
    assert got == sorted(((w.key, number(w.l_quantity), w.l_partkey) for w in want), key=key) and got


def test_visits(spark):
    events = table(spark, "events")
    more = F.when(F.col("event_id") % 3 > 0, F.struct((F.col("event_id") % 7).alias("k")))
    moment = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    when = F.concat(moment, F.lit(".0000000"), (F.col("event_id") % 90 + 10).cast("string"), F.lit("Z"))
    body = F.struct(F.col("user_id").cast("string").alias("who"), F.col("event_type").alias("what"), when.alias("when"), more.alias("more"))
    subject = F.concat(F.lit("site."), "event_type", F.lit(".x"))
    got = {r.sequence: r for r in rows_of("visits.yaml", messages(events, F.col("event_id"), body, subject)).collect()}
    assert len(got) == events.count()
    for e in events.collect():
        r = got[e.event_id]
        assert r.table_name == "visits." + hashlib.sha1(str(e.user_id).encode()).hexdigest()[-1]
        assert (r.kind, r.channel) == (e.event_type, e.event_type)
        assert r.detail == (e.event_id % 7 if e.event_id % 3 else None) and r.ts_ns % 1_000_000_000 == e.event_id % 90 + 10


def test_vectors(spark):
    vectors = table(spark, "embeddings").filter("vec_id < 40")
    parts = F.col("embedding").cast("array<double>")
    body = F.struct(
        F.concat(F.lit("c"), F.col("label").cast("string")).alias("group"), (F.col("vec_id") + 1000).alias("second"), parts.alias("parts")
    )
    got = {(r.sequence, r.place): r for r in rows_of("vectors.yaml", messages(vectors, F.col("vec_id"), body)).collect()}
    assert len(got) == 40 * 64
    for v in vectors.collect():
        for place in (0, 31, 63):
            r = got[v.vec_id, place]
            assert (r.table_name, r.cluster, r.level) == (f"c{v.label}", f"c{v.label}", v.embedding[place])
            assert r.ts_ns == (v.vec_id + 1000) * 10**9 + place * 2_000_000


@pytest.mark.parametrize("name", ["orders.yaml", "shipments.yaml", "visits.yaml", "vectors.yaml"])
def test_examples_are_valid(spark, name):
    Pipeline(load_spec(os.path.join(ROOT, "examples", name)))
