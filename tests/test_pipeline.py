import json
import struct

import pytest
from pyspark.sql import functions as F

from millrace.errors import InvalidPipelineError
from millrace.operators.fields import Field, Slot, Step
from millrace.operators.rows import apply_policy, row_filter
from millrace.plans.pipeline import Pipeline, check_only, register_step, validate_pipeline
from millrace.schema import INT64_MIN, sentinel_fill

JSON = ("parse_json", {})


def field(source, target, kind, **more):
    return ("extract_field", {"source": source, "target": target, "type": kind, **more})


def compute(operation, target, **more):
    return ("compute_field", {"operation": operation, "target": target, **more})


def errors(row):
    return [e.step for e in row.errors]


def test_json_payloads(run):
    good = '{"a": 1}'
    payloads = [
        good, " " + good + "\n", '{"a":1,"a":2}', "null", "", None, "{bad", good + " x", good + ',"b":2',
        good + "," + good, "[1]", "5", '"x"', "[" + good + "]", "{'a':1}", '{"a":NaN}',
    ]
    rows = run(payloads, [JSON, field("a", "v", "int64", on_error="skip")], {"v": "int64"})
    assert [r.outcome for r in rows] == ["ok"] * 4 + ["unusable"] * 12
    assert [r.row.v for r in rows[:4]] == [1, 1, 2, None]
    assert errors(rows[4]) == ["message"] and errors(rows[6]) == ["parse_json"]
    assert all(r.table_name is None and r.n_rows == 0 for r in rows[4:])


VALUES = {
    "whole": 12, "real": 12.9, "neg": -12.9, "huge": 1e30, "text": "12", "bad": "x", "yes": True,
    "word": "T", "nothing": None, "obj": {"k": 1}, "list": [1], "big": 1000000,
}


@pytest.mark.parametrize(
    "kind, column, wanted",
    [
        ("int64", "int64", {"whole": 12, "real": 12, "neg": -12, "text": 12, "big": 1000000}),
        ("float64", "double", {"whole": 12.0, "real": 12.9, "neg": -12.9, "huge": 1e30, "text": 12.0, "big": 1e6}),
        ("bytes", "blob", {"text": b"12", "bad": b"x", "word": b"T"}),
        ("string", "string", {
            "whole": "12", "real": "12.9", "neg": "-12.9", "huge": "1e+30", "text": "12", "bad": "x",
            "yes": "true", "word": "T", "nothing": "<nil>", "obj": '{"k":1}', "list": "[1]", "big": "1e+06",
        }),
    ],
)
def test_conversions(run, kind, column, wanted):
    steps = [JSON] + [field(name, f"out_{name}", kind) for name in VALUES]
    (row,) = run([json.dumps(VALUES)], steps, {f"out_{name}": column for name in VALUES})
    got = {n: row.row[f"out_{n}"] for n in VALUES if row.row[f"out_{n}"] is not None}
    assert got == wanted
    assert len(row.errors) == len(VALUES) - len(wanted)


def test_bool_conversion_has_no_output_column_but_a_text_form(run):
    steps = [JSON, field("yes", "b1", "bool"), field("word", "b2", "bool"), field("whole", "b3", "bool"),
             compute("str", "s1", source="b1"), compute("str", "s2", source="b2")]
    (row,) = run([json.dumps(VALUES)], steps, {"s1": "string", "s2": "string", "b1": "string"})
    assert (row.row.s1, row.row.s2, row.row.b1) == ("true", "true", None)
    assert errors(row) == ["extract_field"]


def test_output_columns_do_not_convert(run):
    (row,) = run(
        ['{"i": 5, "s": "x", "d": 1.5}'],
        [JSON, field("i", "n", "int64")],
        {"i": "int64", "s": "string", "d": "double", "n": "double", "gone": "string"},
    )
    assert row.row.asDict() == {"i": None, "s": "x", "d": 1.5, "n": None, "gone": None}
    assert row.outcome == "ok"


def test_a_failing_step_keeps_the_previous_value(run):
    payloads = ['{"temp": "warm"}', '{"temp": "12.5"}']
    rows = run(payloads, [JSON, field("temp", "temp", "float64", on_error="skip")], {"temp": "string"})
    assert [r.row.temp for r in rows] == ["warm", None]
    rows = run(payloads, [JSON, field("temp", "temp", "float64")], {"temp": "double"})
    assert [(r.row.temp, r.outcome) for r in rows] == [(None, "partial"), (12.5, "ok")]


def test_decoding_again_overwrites_targets(run):
    steps = [("extract_subject", {"target": "who", "segment": 0}), JSON]
    rows = run(['{"who": "body"}', "{}"], steps, {"who": "string"})
    assert [r.row.who for r in rows] == ["body", "a"]


def test_paths(run):
    payload = json.dumps({"a": {"b": {"c": 1}}, "x.y": 2, "f": 5, "n": None, "q[0]": 7})
    steps = [JSON, field("a.b.c", "v1", "int64"), field("a.b.z", "v2", "int64"), field("f.b", "v3", "int64"),
             field("x.y", "v4", "int64"), field("n.k", "v5", "int64"), field("a.b", "v6", "string"),
             field("q[0]", "v7", "int64")]
    (row,) = run([payload], steps, {f"v{i}": "string" if i == 6 else "int64" for i in range(1, 8)})
    assert list(row.row) == [1, None, None, None, None, '{"c":1}', 7]
    assert len(row.errors) == 4


def test_safe_parse_number_modes(run):
    payloads = ['{"t": "1.5"}', '{"t": "N/A"}', "{}", '{"t": 3}', '{"t": true}', '{"t": null}']
    wanted = {
        "null": ["ok", "ok", "partial", "ok", "ok", "ok"],
        "skip": ["ok"] * 6,
        "fail": ["ok", "partial", "partial", "ok", "partial", "partial"],
        "other": ["ok", "partial", "partial", "ok", "partial", "partial"],
    }
    for mode, outcomes in wanted.items():
        step = ("safe_parse_number", {"source": "t", "target": "v", "on_error": mode})
        rows = run(payloads, [JSON, step], {"v": "double"})
        assert [r.outcome for r in rows] == outcomes, mode
        assert [r.row.v for r in rows] == [1.5, None, None, 3.0, None, None]
    # Null mode clears a body key of the target's name; skip leaves it.
    for mode, left in (("null", None), ("skip", "N/A")):
        step = ("safe_parse_number", {"source": "t", "target": "t", "on_error": mode})
        (row,) = run(['{"t": "N/A"}'], [JSON, step], {"t": "string"})
        assert row.row.t == left


def test_subjects(run):
    steps = [
        ("extract_subject", {"target": "whole"}),
        ("extract_subject", {"target": "token", "segment": -2, "trim": "="}),
        ("extract_subject", {"target": "empty", "segment": 0, "trim": "it"}),
        ("extract_subject", {"target": "gone", "segment": 9}),
    ]
    (row,) = run(["x"], steps, dict.fromkeys(["whole", "token", "empty", "gone"], "string"), subject="it.1.ABC=.value")
    assert list(row.row) == ["it.1.ABC=.value", "ABC", "", None]
    assert row.outcome == "partial"


def test_compute(run):
    payload = json.dumps({"id": "a:b:c", "n": 5, "m": 2.5, "s": "abcdef"})
    steps = [JSON, compute("concat", "c1", fields=['"x/"', "id", '""', "s"]), compute("concat", "c2", fields=["n"]),
             compute("split", "c3", source="id", separator=":", index=-1),
             compute("split", "c4", source="id", separator=":", index=3),
             compute("hash", "c5", source="s", algorithm="sha1"), compute("slice", "c6", source="c5", start=0, end=4),
             compute("str", "c7", source="n"), compute("str", "c8", source="m"),
             compute("slice", "c9", source="n", start=0)]
    (row,) = run([payload], steps, {f"c{i}": "string" for i in range(1, 10)})
    assert list(row.row) == [
        "x/a:b:cabcdef", None, "c", None, "1f8ac10f23c5b5bc1167bda84b833e5c057a77d2", "1f8a", "5", "2.5", None,
    ]
    assert len(row.errors) == 3


def test_routing(run):
    steps = [JSON, ("extract_table", {"source": "to"})]
    payloads = ['{"to": "east/17"}', '{"to": "_x"}', '{"to": ""}', '{"to": 5}', "{}", '{"to": "9 lives"}']
    rows = run(payloads, steps, {"v": "string"}, table=False)
    assert [r.table_name for r in rows] == ["east/17", None, None, None, None, "9 lives"]
    assert [r.outcome for r in rows] == ["ok"] + ["unusable"] * 4 + ["ok"]
    # Without options the name comes from the body itself.
    rows = run(['{"$table": "t1"}', "{}"], [JSON, ("extract_table", {})], {"v": "string"}, table=False)
    assert [r.table_name for r in rows] == ["t1", None]


def test_index(run):
    steps = [JSON, ("extract_index", {"source": "t", "format": "unix"}),
             ("extract_timestamp", {"source": "t", "target": "seen", "format": "unix"})]
    rows = run(['{"t": 1704110400.5}', '{"t": "1704110400"}', '{"t": true}', "{}"], steps, {"seen": "timestamp"})
    assert [r.ts_ns for r in rows] == [1704110400500000000, 1704110400000000000, None, None]
    assert [r.row.seen for r in rows] == [1704110400500000000, 1704110400000000000, None, None]
    assert [r.outcome for r in rows] == ["ok", "ok", "unusable", "unusable"]
    rows = run(['{"t": 1704110400}'], [JSON, ("extract_index", {"source": "t"})], {"v": "string"})
    assert rows[0].outcome == "unusable"  # a number never matches a date format


def test_structural_failure_stops_the_error_list(run):
    steps = [JSON, field("a", "x", "int64"), field("b", "y", "int64")]
    rows = run(["{bad", "{}"], steps, {"x": "int64"})
    assert errors(rows[0]) == ["parse_json"]
    assert errors(rows[1]) == ["extract_field", "extract_field"]


def test_decompress(run):
    import gzip

    packed = gzip.compress(b'{"v": 1}')
    steps = [("decompress", {"algorithm": "gzip"}), JSON, field("v", "v", "int64")]
    rows = run([packed, packed[:-3], b"plain", b""], steps, {"v": "int64"})
    assert [r.outcome for r in rows] == ["ok", "unusable", "unusable", "unusable"]
    assert rows[0].row.v == 1 and errors(rows[1]) == ["decompress"]


def test_map_entries(run):
    def step(**more):
        return ("extract_map_entry", {"source": "m", "key_target": "k", "value_target": "v", **more})

    payloads = ['{"m": {"3": 1.5}}', '{"m": {"3": 1, "10": 2}}', '{"m": {}}', '{"m": 5}', "{}", '{"m": {"x": 1}}']
    columns = {"k": "int64", "v": "double"}
    rows = run(payloads, [JSON, step()], columns)
    assert [r.outcome for r in rows] == ["ok", "unusable", "unusable", "unusable", "unusable", "ok"]
    assert [r.row.k for r in rows][0::5] == [3, None]
    rows = run(payloads, [JSON, step(on_multiple="first")], columns)
    assert (rows[1].row.k, rows[1].row.v) == (10, 2.0)
    rows = run(payloads, [JSON, step(on_multiple="first", allowed_keys=[3, "x"])], {"k": "string"})
    # The whitelist looks at the chosen key: "10" is first and not listed.
    assert [r.outcome for r in rows] == ["ok", "unusable", "unusable", "unusable", "unusable", "ok"]
    assert rows[5].row.k == "x"


# Series


def explode(**more):
    config = {
        "source": "samples", "target": "value", "ordinal": "i",
        "index": {"start": {"source": "at"}, "interval": {"value": "200us"}},
    } | more
    return ("explode", config)


AT = ("extract_timestamp", {"source": "t", "target": "at"})
WAVE = {"value": "double", "i": "int64", "site": "string"}
T0 = "2024-01-01T12:00:00Z"


def wave(samples, **more):
    return json.dumps({"t": T0, "site": "s", "samples": samples} | more)


def test_series(run):
    payloads = [wave([1, 2.5, 3]), wave([]), wave([1, None]), wave([1, "2"]), wave("x"), '{"t": "%s"}' % T0,
                wave([4], t="soon"), wave([], t="soon")]
    rows = run(payloads, [JSON, AT, explode()], WAVE)
    # The bad start of the last message only made it partial: its empty array comes first.
    assert [r.outcome for r in rows] == ["ok", "ok"] + ["unusable"] * 5 + ["partial"]
    assert [r.n_rows for r in rows] == [3, 0, 0, 0, 0, 0, 0, 0]
    out = run.pipeline.rows(run.parsed).orderBy("sequence", "i").collect()
    base = 1704110400000000000
    assert [(r.ts_ns, r.i, r.value, r.site) for r in out] == [
        (base, 0, 1.0, "s"), (base + 200_000, 1, 2.5, "s"), (base + 400_000, 2, 3.0, "s"),
    ]


def test_series_intervals(run):
    def with_interval(interval):
        return [JSON, AT, explode(index={"start": {"source": "at"}, "interval": interval})]

    payloads = [wave([1, 2], p=1.5), wave([1, 2], p=0), wave([1, 2], p="x"), wave([1, 2, 3], p=1e30), wave([1, 2])]
    rows = run(payloads, with_interval({"source": "p", "unit": "ms"}), WAVE)
    assert [r.interval_ns for r in rows] == [1_500_000, None, None, None, None]
    assert [r.outcome for r in rows] == ["ok"] + ["unusable"] * 4
    rows = run(payloads, with_interval({"by_length": {2: "1s", "4": "2s"}}), WAVE)
    assert [r.outcome for r in rows] == ["ok", "ok", "ok", "unusable", "ok"]
    assert rows[0].interval_ns == 1_000_000_000


def test_json_numbers_do_not_feed_integer_series(run):
    rows = run([wave([1, 2]), wave([])], [JSON, AT, explode()], {"value": "int64", "i": "int64"})
    assert [r.outcome for r in rows] == ["unusable", "ok"]


def test_packed_series(run):
    raw = struct.pack(">4h", 1, -2, 3, 4)
    steps = [
        ("extract_subject", {"target": "t", "segment": 1}),
        ("extract_timestamp", {"source": "t", "target": "at", "format": "unix"}),
        JSON,
        field("raw", "bytes", "bytes"),
        ("unpack", {"source": "bytes", "type": "int16", "endianness": "big", "target": "samples",
                    "scale": {"source": "factor"}}),
        explode(),
    ]
    text = raw.decode("latin-1")
    payloads = [json.dumps({"raw": "ABCD", "factor": 0.5}), json.dumps({"raw": "ABC", "factor": 0.5}),
                json.dumps({"raw": "AB", "factor": 0}), json.dumps({"raw": text[:2]})]
    rows = run(payloads, steps, {"value": "double", "i": "int64"}, subject="x.1704110400")
    assert [r.outcome for r in rows] == ["ok"] + ["unusable"] * 3
    assert rows[0].series == [0x4142 * 0.5, 0x4344 * 0.5]


# Filters and policy


def test_row_filter(run, spark):
    payloads = ['{"k": 1, "s": "a"}', '{"k": 2}', '{"s": "b"}', '{"k": 3, "s": ""}']
    steps = [JSON, field("k", "k", "int64", on_error="skip")]
    columns = {"k": "int64", "s": "string"}

    def kept(mode, *match):
        filters = {"mode": mode, "match": [{"column": c, "value": v} for c, v in match]}
        return [r.sequence for r in run(payloads, steps, columns, filters) if r.selected]

    assert kept("whitelist", ("k", 1), ("s", "b")) == [0, 2]
    assert kept("blacklist", ("k", 1), ("s", "b")) == [1, 3]
    assert kept("whitelist", ("s", "")) == [1, 3]
    assert kept("blacklist", ("k", INT64_MIN)) == [0, 1, 3]
    df = spark.createDataFrame([(1, "a"), (None, None)], "k bigint, s string")
    assert row_filter(df).count() == 2
    assert row_filter(df, "blacklist", [{"column": "k", "value": 1}]).count() == 1


def test_policy_matrix(spark):
    df = spark.createDataFrame([("ok",), ("partial",), ("unusable",)], "outcome string")

    def names(action):
        return [sorted(r.outcome for r in part.collect()) for part in apply_policy(df, action)]

    assert names("drop") == [["ok", "partial"], [], ["unusable"]]
    assert names("fail") == [["ok"], ["partial", "unusable"], []]
    with pytest.raises(InvalidPipelineError):
        apply_policy(df, "retry")


def test_sentinels(spark):
    kinds = ["timestamp", "double", "int64", "blob", "string", "symbol"]
    columns = [{"name": k[0] + k[-1], "type": k} for k in kinds]
    df = spark.range(1).select(
        *[F.lit(None).cast({"timestamp": "bigint", "double": "double", "int64": "bigint", "blob": "binary"}.get(k, "string"))
          .alias(k[0] + k[-1]) for k in kinds]
    )
    row = sentinel_fill(df, columns).first()
    assert row[0] == INT64_MIN and row[1] != row[1] and row[2] == INT64_MIN
    assert row[3] == b"" and row[4] == "" and row[5] == ""


def test_check_only(messages):
    rows = check_only(messages(["x", ""])).orderBy("sequence").collect()
    assert [(r.outcome, r.n_rows) for r in rows] == [("ok", 0), ("unusable", 0)]


# Declarations


def spec(steps, columns=None, **more):
    columns = columns or [{"name": "v", "type": "double"}, {"name": "i", "type": "int64"}]
    return {"output": {"columns": columns}, "transformations": [{"step": n, "config": c} for n, c in steps]} | more


TABLE = ("extract_table", {"value": "t"})
BAD = {
    "no steps": spec([]),
    "no table": spec([JSON]),
    "unknown step": spec([("guess", {}), TABLE]),
    "no columns": {"output": {"columns": []}, "transformations": [{"step": "extract_table", "config": {"value": "t"}}]},
    "duplicate column": spec([TABLE], [{"name": "v", "type": "double"}] * 2),
    "column type": spec([TABLE], [{"name": "v", "type": "decimal"}]),
    "reserved column": spec([TABLE], [{"name": "ts_ns", "type": "int64"}]),
    "algorithm": spec([("decompress", {"algorithm": "lz4"}), TABLE]),
    "field type missing": spec([("extract_field", {"source": "a", "target": "b"}), TABLE]),
    "field type unknown": spec([field("a", "b", "uint8"), TABLE]),
    "empty segment": spec([field("a..b", "b", "auto"), TABLE]),
    "leading dot": spec([field(".a", "b", "auto"), TABLE]),
    "reserved target": spec([compute("concat", "$table", fields=["a"]), TABLE]),
    "timestamp target": spec([("extract_timestamp", {"source": "a", "target": "$timestamp"}), TABLE]),
    "operation": spec([compute("join", "b"), TABLE]),
    "concat empty": spec([compute("concat", "b", fields=[]), TABLE]),
    "split index": spec([compute("split", "b", source="a", separator=":"), TABLE]),
    "hash algorithm": spec([compute("hash", "b", source="a", algorithm="md5"), TABLE]),
    "slice end": spec([compute("slice", "b", source="a", start=0, end="4"), TABLE]),
    "subject segment": spec([("extract_subject", {"target": "b", "segment": "1"}), TABLE]),
    "two table options": spec([("extract_table", {"value": "t", "source": "s"})]),
    "empty whitelist": spec([("extract_map_entry", {"source": "m", "key_target": "k", "value_target": "x", "allowed_keys": []}), TABLE]),
    "unpack type": spec([("unpack", {"source": "a", "type": "int128", "target": "b"}), TABLE]),
    "unpack scale": spec([("unpack", {"source": "a", "type": "int8", "target": "b", "scale": {"value": 0}}), TABLE]),
    "unbound array": spec([("unpack", {"source": "a", "type": "float32", "target": "v"}), TABLE]),
    "explode not last": spec([explode(target="v"), TABLE]),
    "explode with index": spec([TABLE, ("extract_index", {"source": "t"}), explode(target="v")]),
    "explode target": spec([TABLE, explode(target="nope")]),
    "explode ordinal": spec([TABLE, explode(target="v", ordinal="v")]),
    "explode unit": spec([TABLE, explode(target="v", index={"start": {"source": "a"}, "interval": {"source": "p"}})]),
    "explode interval": spec([TABLE, explode(target="v", index={"start": {"source": "a"}, "interval": {"value": "0s"}})]),
    "explode type": spec([("unpack", {"source": "a", "type": "int8", "target": "samples"}), TABLE, explode(target="v")]),
    "filter column": spec([TABLE], filters={"mode": "whitelist", "match": [{"column": "z", "value": 1}]}),
    "filter type": spec([TABLE], filters={"mode": "whitelist", "match": [{"column": "v", "value": 1}]}),
    "filter value": spec([TABLE], filters={"mode": "whitelist", "match": [{"column": "i", "value": "1"}]}),
    "filter mode": spec([TABLE], filters={"mode": "some", "match": [{"column": "i", "value": 1}]}),
    "filter empty": spec([TABLE], filters={"mode": "whitelist", "match": []}),
    "filter exploded": spec([TABLE, explode(target="v")], filters={"mode": "whitelist", "match": [{"column": "i", "value": 1}]}),
}


@pytest.mark.parametrize("name", BAD)
def test_invalid_declarations(spark, name):
    with pytest.raises(InvalidPipelineError):
        validate_pipeline(BAD[name])


def test_registered_step(run):
    def shout(options):
        def apply(scope):
            value = F.upper(scope.read(scope.lookup(options["source"]), "text"))
            scope.store(options["target"], "shout", Field({"text": Slot(value)}))

        return Step("shout", apply, reads=((options["source"],),), target=options["target"])

    register_step("shout", shout)
    (row,) = run(['{"a": "x"}'], [JSON, ("shout", {"source": "a", "target": "b"})], {"b": "string"})
    assert row.row.b == "X"
    with pytest.raises(InvalidPipelineError):
        register_step("shout", shout)


def test_outcome_filter_does_not_repeat_the_decoding(messages):
    """A filter on the outcome must stay above the steps: one JSON parse in the plan."""
    filters = {"mode": "whitelist", "match": [{"column": "i", "value": n} for n in (1, 2, 3)]}
    steps = [JSON, field("a", "v", "float64"), field("b", "i", "int64"), compute("concat", "to", fields=["c", "d"])]
    pipeline = Pipeline(spec([*steps, ("extract_table", {"source": "to"})], filters=filters))
    plan = pipeline.transform(messages(["{}"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and len(plan) < 100_000
    # An array function's filter must not pull the decoding below itself either.
    wave = Pipeline(spec([JSON, AT, TABLE, explode(target="v", ordinal="i")]))
    plan = wave.transform(messages(["{}"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_envelope_conditions_reach_the_scan(spark, messages, tmp_path):
    messages(['{"v": 1}', '{"v": 2}']).write.parquet(str(tmp_path / "in"))
    stored = spark.read.parquet(str(tmp_path / "in"))
    pipeline = Pipeline(spec([JSON, field("v", "i", "int64"), TABLE]))
    rows = pipeline.transform(stored, where=F.col("sequence") == 1)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(sequence,1)" in plan and [r.sequence for r in rows.collect()] == [1]


def test_numbers_beyond_the_double_range_make_a_message_unusable(run):
    long = "9" * 400
    bad = ['{"a": 1e400}', '{"b": [{"c": -1.5E+999}], "a": 1}', f'{{"a": {long}}}', f'{{"a": -{long}.5}}', '{"x": 0.1e310, "a": 1}',
           '{"a": "q\\\\", "b": 1e309}', f'{{"a": {"9" * 250}e90}}', '{"a": 1e0400}']
    good = ['{"a": 1e308}', '{"a": 1e-400}', '{"a": 0e400}', '{"a": "1e400"}', '{"a": "\\"1e400", "b": "x 1e999"}',
            f'{{"a": "{long}"}}', f'{{"a": 0.{long}}}', '{"1e400": 1, "a": 2}', '{"a": "9\\\\\\" 1e500"}']
    good.append('{"a": "' + '\\n1e999' * 200_000 + '"}')
    rows = run(bad + good, [("parse_json", {})], {"a": "string"})
    assert [r.outcome for r in rows[: len(bad)]] == ["unusable"] * len(bad)
    assert "unusable" not in [r.outcome for r in rows[len(bad) :]]
