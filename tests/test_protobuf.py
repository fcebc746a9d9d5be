import pytest
from pyspark.sql import functions as F

pytest.importorskip("google.protobuf")

from tests import freight  # noqa: E402

from millrace.errors import InvalidPipelineError  # noqa: E402
from millrace.functions.protobuf import decode_protobuf  # noqa: E402

SET = freight.descriptor_set()


def line(papers=None, port=None, shipped=None, **values):
    message = freight.message_class("freight.Line")(**values)
    for key, value in (papers or {}).items():
        message.papers[key] = value
    if port:
        message.port.country, message.port.distance = port
    if shipped:
        message.shipped.seconds, message.shipped.nanos = shipped
    return message.SerializeToString()


def decoded(spark, *payloads):
    df = spark.createDataFrame(list(enumerate(map(bytearray, payloads))), "place int, body binary")
    found = df.select("place", decode_protobuf(F.col("body"), SET, "freight.Line").alias("line"))
    return [r.line for r in found.orderBy("place").collect()]


def test_scalars_lists_and_messages(spark):
    (found,) = decoded(spark, line(
        order_key=-(1 << 40), line_number=(1 << 32) - 1, price=901.25, tax=0.3, returned=True, seal=bytes(range(4)),
        days_late=-12, fingerprint=(1 << 64) - 2, note="gréen", carrier=3, stamps=["x", "", "y"], loads=[7, -8],
        port=("PERU", 12.5), papers={20: b"inv", 5: b"bill"}, shipped=(86_400, 7),
    ))
    values = found.asDict(recursive=True)
    assert values.pop("tax") == pytest.approx(0.3, abs=1e-7)
    assert values == {
        "order_key": -(1 << 40), "line_number": (1 << 32) - 1, "price": 901.25, "returned": True, "seal": bytes(range(4)),
        "days_late": -12, "fingerprint": -2, "note": "gréen", "carrier": 3, "stamps": ["x", "", "y"], "loads": [7, -8],
        "port": {"country": "PERU", "distance": 12.5}, "papers": {"20": b"inv", "5": b"bill"},
        "shipped": "1970-01-02T00:00:00.000000007Z",
    }


def test_absent_and_malformed(spark):
    only_key, cut_off, nothing = decoded(spark, line(order_key=9), line(note="long enough")[:-3], b"")
    assert only_key.order_key == 9
    assert {v for k, v in only_key.asDict().items() if k != "order_key"} == {None}
    assert cut_off is None and nothing is None


def test_zeros_of_the_query_are_told_from_nulls(spark, tmp_path):
    from workload.queries import QUERIES

    rows = [(0, 5, 0.0), (1, 0, None), (2, 7, -1.5)]
    events = spark.createDataFrame(rows, "event_id bigint, user_id bigint, value double")
    moment = F.timestamp_seconds(F.col("event_id")).cast("timestamp_ntz")
    events = events.select("*", moment.alias("ts"), F.lit("view").alias("event_type"), F.lit("{}").alias("props"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    found = QUERIES["protobuf_decode"](spark, str(tmp_path))
    assert sorted((r.id, r.user, r.value) for r in found.collect()) == rows


@pytest.mark.parametrize(
    "change",
    [
        {"message_type": "freight.Nothing"}, {"message_type": "freight.Crate"}, {"target": "x.y"}, {"source": "x..y"},
        {"descriptor_set": b"\x07"}, {"descriptor_set": None}, {"message_type": None},
        {"descriptor_set": None, "descriptor_file": "/no/such/file"}, {"descriptor_set": None, "proto_file": "freight.proto"},
    ],
)
def test_configuration(change):
    from millrace.operators.decode import parse_protobuf_step

    good = {"descriptor_set": SET, "message_type": "freight.Line"}
    parse_protobuf_step(good)
    with pytest.raises(InvalidPipelineError):
        parse_protobuf_step({k: v for k, v in (good | change).items() if v is not None})


def test_pipeline_over_nested_messages(run):
    """The harbour's papers, a map entry holding a message of its own, route the line."""
    port = freight.message_class("freight.Port")
    lima = port(country="PERU", distance=40.5).SerializeToString()
    steps = [
        ("parse_protobuf", {"descriptor_set": SET, "message_type": "freight.Line"}),
        ("extract_index", {"source": "shipped", "format": "rfc3339nano"}),
        ("extract_map_entry", {"source": "papers", "value_target": "paper", "key_target": "desk", "on_multiple": "first"}),
        ("parse_protobuf", {"descriptor_set": SET, "message_type": "freight.Port", "source": "paper", "target": "harbour"}),
        ("extract_field", {"source": "harbour.distance", "target": "miles", "type": "float64"}),
        ("extract_field", {"source": "harbour.country", "target": "where", "type": "string"}),
        ("extract_table", {"source": "where"}),
    ]
    when = (1_000_000, 250)
    payloads = [
        line(order_key=1, papers={4: lima}, shipped=when),
        line(order_key=2, papers={40: lima, 5: b"\xff\xff"}, shipped=when),  # "40" comes before "5"
        line(order_key=3, papers={4: port(country="CHINA").SerializeToString()}, shipped=when),  # no distance
        line(order_key=4, papers={4: b"\xff\xff"}, shipped=when),
        line(order_key=5, shipped=when),
        line(order_key=6, papers={4: lima}),  # never shipped
    ]
    rows = run(payloads, steps, {"order_key": "int64", "desk": "int64", "miles": "double"}, table=False)
    assert [r.outcome for r in rows] == ["ok", "ok", "partial", "unusable", "unusable", "unusable"]
    assert [tuple(r.row) for r in rows[:3]] == [(1, 4, 40.5), (2, 40, 40.5), (3, 4, None)]
    assert [r.table_name for r in rows[:3]] == ["PERU", "PERU", "CHINA"] and rows[0].ts_ns == 1_000_000 * 10**9 + 250


def test_loads_become_a_series(run):
    steps = [
        ("parse_protobuf", {"descriptor_set": SET, "message_type": "freight.Line"}),
        ("extract_timestamp", {"source": "shipped", "target": "left"}),
        ("explode", {"source": "loads", "target": "load", "index": {
            "start": {"source": "left"}, "interval": {"source": "line_number", "unit": "ms"}}}),
    ]
    rows = run([line(loads=[3, 1, 2], line_number=4, shipped=(50, 0)), line(loads=[1, 2], shipped=(50, 0))], steps, {"load": "int64"})
    assert [r.outcome for r in rows] == ["ok", "unusable"]
    series = run.pipeline.rows(run.parsed).orderBy("ts_ns").collect()
    assert [(r.ts_ns, r.load) for r in series] == [(50 * 10**9 + i * 4_000_000, v) for i, v in enumerate((3, 1, 2))]
