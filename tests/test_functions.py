import datetime
import hashlib
import math
import struct

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.errors import InvalidPipelineError
from millrace.functions import codecs, numbers, text, timestamps
from millrace.functions.buckets import exp_buckets, highest_bound, quantile_of

BASE = 1_704_110_400_000_000_000  # 2024-01-01T12:00:00Z


@pytest.mark.parametrize(
    "value, wanted",
    [
        (100.0, "100"), (1e6, "1e+06"), (999999.0, "999999"), (123456.7, "123456.7"),
        (1234567.8, "1.2345678e+06"), (1e21, "1e+21"), (1e-4, "0.0001"), (1e-5, "1e-05"),
        (0.00012345, "0.00012345"), (2.5, "2.5"), (-7.0, "-7"), (0.0, "0"), (-0.0, "-0"),
        (1.5e300, "1.5e+300"), (-1.25e7, "-1.25e+07"), (math.inf, "+Inf"), (math.nan, "NaN"),
    ],
)
def test_float_text(one, value, wanted):
    assert one(numbers.float_text(F.lit(value))) == wanted


def test_strict_numbers(spark):
    cases = {
        "1": (1.0, 1), "1.5": (1.5, None), "1d": (None, None), " 12 ": (None, None),
        "1e400": (None, None), "inf": (math.inf, None), "-Infinity": (-math.inf, None),
        "+nan": (None, None), "1_000.5": (1000.5, None), ".5": (0.5, None), "5.": (5.0, None),
        "": (None, None), "+7": (7.0, 7), "9223372036854775808": (9223372036854775808.0, None),
        "yes": (None, None),
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    rows = df.select("s", numbers.parse_float(F.col("s")).alias("f"), numbers.parse_int(F.col("s")).alias("i"))
    assert {r.s: (r.f, r.i) for r in rows.collect()} == cases


def test_booleans(spark):
    words = ["1", "t", "T", "true", "TRUE", "True", "0", "f", "F", "false", "FALSE", "False", "yes", "tRUE", ""]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, s string")
    got = [r.b for r in df.orderBy("i").select(numbers.parse_bool(F.col("s")).alias("b")).collect()]
    assert got == [True] * 6 + [False] * 6 + [None] * 3


@pytest.mark.parametrize(
    "start, end, wanted",
    [
        (0, 4, "abcd"), (2, None, "cdef"), (-2, None, "ef"), (0, -1, "abcde"), (0, 10, "abcdef"),
        (-10, 2, "ab"), (4, 2, ""), (10, 20, ""), (3, 3, ""),
    ],
)
def test_byte_slice(one, start, end, wanted):
    assert one(text.byte_slice(F.lit("abcdef"), start, end)) == wanted


def test_byte_slice_agrees_with_python_bytes(spark):
    word = "aé€z"
    df = spark.createDataFrame([(word,)], "s string")
    for start in range(-11, 12, 3):
        for end in (None, -2, 0, 4, 20):
            got = df.select(text.byte_slice(F.col("s"), start, end).cast("binary").alias("b")).first()["b"]
            assert bytes(got) == word.encode()[start:end]


def test_parts(one):
    assert one(text.part_at(F.lit("a:b:c"), ":", -1)) == "c"
    assert one(text.part_at(F.lit("a||b"), "||", 1)) == "b"
    assert one(text.part_at(F.lit("a.b"), ".", 0)) == "a"
    assert one(text.part_at(F.lit("abc"), ".", -1)) == "abc"
    assert one(text.part_at(F.lit("abc"), ".", 5)) is None
    assert one(text.part_at(F.lit("a,"), ",", 1)) == ""


@pytest.mark.parametrize("identifier", ["Customer#000000001", "order 17", "", "gréen", "a:b:c:9"])
def test_shards(one, identifier):
    digest = hashlib.sha1(identifier.encode()).hexdigest()
    assert one(text.shard_name(F.lit(identifier), "s/")) == "s/" + digest[:4]


@pytest.mark.parametrize(
    "value, fraction",
    [
        ("2024-01-01T1:00:00.1234567Z", 123456700), ("2024-01-01T01:00:00.123456789Z", 123456789),
        ("2024-01-01T1:00:00.000000009Z", 9), ("2024-01-01T01:00:00.12345678+00:00", 123456780),
    ],
)
def test_digits_below_a_microsecond(one, value, fraction):
    hour = BASE - 11 * 3600 * 10**9
    assert one(timestamps.to_ts_ns(F.lit(value), "rfc3339")) == hour + fraction
    if value.endswith("Z"):
        plain = value[:-1].replace("T", " ")
        assert one(timestamps.to_ts_ns(F.lit(plain), "2006-01-02 15:04:05")) == hour + fraction


@pytest.mark.parametrize(
    "value, fmt, offset",
    [
        ("2024-01-01T12:00:00Z", "rfc3339", 0),
        ("2024-01-01T12:00:00.123456789Z", "rfc3339nano", 123456789),
        ("2024-01-01T12:00:00.1234567891234Z", "rfc3339", 123456789),
        ("2024-01-01T14:00:00,5+02:00", "rfc3339", 500_000_000),
        ("2024-01-01 12:00:00", "2006-01-02 15:04:05", 0),
        ("2024-01-01 12:00:00.1234567", "2006-01-02 15:04:05", 123456700),
        ("2024-01-01T12:00:00Z", "2006-01-02T15:04:05Z", 0),
        ("01/Jan/2024:05:00:00 -0700", "02/Jan/2006:15:04:05 -0700", 0),
        ("01/01/24 12:00:00 PM", "01/02/06 03:04:05 PM", 0),
        ("Mon Jan  1 12:00:00 2024", "Mon Jan _2 15:04:05 2006", 0),
        ("01.01.2024 12:00:00.25", "02.01.2006 15:04:05", 250_000_000),
        ("2024-01-01T12:00:00.123Z", "2006-01-02T15:04:05.000Z07:00", 123_000_000),
        ("1704110400", "unix", 0), ("1704110400123", "unix_ms", 123_000_000),
        ("1704110400123456", "unix_us", 123_456_000), ("1704110400123456789", "unix_ns", 123456789),
        ("1704110400.5", "unix", 500_000_000),
    ],
)
def test_timestamp_text(one, value, fmt, offset):
    assert one(timestamps.to_ts_ns(F.lit(value), fmt)) == BASE + offset


@pytest.mark.parametrize(
    "value, fmt",
    [
        ("2024-02-30T00:00:00Z", "rfc3339"), ("2024-01-01 12:00:00", "rfc3339"), ("abc", "unix"),
        ("2024-01-01T12:00:00Z", "2006-01-02T15:04:05.000Z07:00"), ("0001-01-01T00:00:00Z", "rfc3339"),
        ("2024-01-01T12:00:00Z x", "rfc3339"), ("2024-13-01", "2006-01-02"),
    ],
)
def test_timestamp_rejects(one, value, fmt):
    assert one(timestamps.to_ts_ns(F.lit(value), fmt)) is None


def test_timestamp_numbers(one):
    assert one(timestamps.ts_from_int(F.lit(1704110400123), "unix_ms")) == BASE + 123_000_000
    assert one(timestamps.ts_from_float(F.lit(1704110400.5), "unix")) == BASE + 500_000_000
    assert one(timestamps.ts_from_float(F.lit(1704110400123.25), "unix_ms")) == BASE + 123_250_000
    assert one(timestamps.ts_from_float(F.lit(1704110400123456.5), "unix_us")) == BASE + 123_456_500
    assert one(timestamps.ts_from_float(F.lit(-1.5), "unix_ms")) == -1_500_000
    assert one(timestamps.ts_from_int(F.lit(5), "rfc3339")) is None
    assert one(timestamps.ts_from_int(F.lit(1 << 62), "unix")) is None
    assert one(timestamps.to_ts_ns(F.lit("1969-12-31T23:59:59.5Z"))) == -500_000_000


def test_ns_round_trip_through_text(spark):
    @settings(max_examples=1, deadline=None)
    @given(st.lists(st.integers(-(1 << 62), 1 << 62), min_size=200, max_size=200))
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "v bigint")
        rendered = df.select("v", timestamps.ts_text(F.col("v")).alias("t"))
        back = rendered.select("v", timestamps.ts_from_text(F.col("t"), "2006-01-02 15:04:05 -0700 MST").alias("b"))
        assert all(r.v == r.b for r in back.collect())
        floors = df.select("v", F.unix_micros(timestamps.ns_to_timestamp(F.col("v"))).alias("u")).collect()
        assert all(r.u == r.v // 1000 for r in floors)

    check()


def test_durations():
    wanted = {"200us": 200_000, "1.5ms": 1_500_000, "1m30s": 90_000_000_000, "333333ns": 333_333, "+2h": 7_200_000_000_000}
    assert {k: timestamps.duration_ns(k) for k in wanted} == wanted
    for bad in ("", "5", "0s", "-1s", "1x", None, 5):
        with pytest.raises(InvalidPipelineError):
            timestamps.duration_ns(bad)


@pytest.mark.parametrize(
    "kind, order, raw, wanted",
    [
        ("int8", "little", b"\x80\x7f\xff\x00", [-128, 127, -1, 0]),
        ("uint8", "little", b"\xff\x00\x80", [255, 0, 128]),
        ("int16", "little", b"\x01\x00\xff\xff\x00\x80\xff\x7f", [1, -1, -32768, 32767]),
        ("int16", "big", b"\x00\x01\xff\xff\x80\x00\x7f\xff", [1, -1, -32768, 32767]),
        ("uint16", "little", b"\xff\xff", [65535]),
        ("int32", "big", b"\x7f\xff\xff\xff", [2147483647]),
        ("uint32", "little", b"\xff\xff\xff\xff", [4294967295]),
        ("int64", "little", b"\x00" * 7 + b"\x80", [-(1 << 63)]),
        ("uint64", "little", b"\xff" * 8, [-1]),
        ("float32", "little", struct.pack("<2f", 1.5, -0.25), [1.5, -0.25]),
        ("float64", "big", struct.pack(">2d", 1e300, -0.1), [1e300, -0.1]),
        ("float64", None, struct.pack("=d", 2.5), [2.5]),
        ("int32", "big", b"", []),
        ("int32", "big", b"\x01", None),
    ],
)
def test_unpack(spark, kind, order, raw, wanted):
    df = spark.createDataFrame([(bytearray(raw),)], "b binary")
    assert df.select(codecs.unpack(F.col("b"), kind, order).alias("v")).first()["v"] == wanted


def test_unpack_scale_widens_first(spark):
    df = spark.createDataFrame(
        [(bytearray(b"\xff" * 8), 0.5), (bytearray(b"\xff" * 8), 0.0), (bytearray(b"\xff" * 8), math.nan), (None, 1.0)],
        "b binary, s double",
    )
    got = df.select(
        codecs.unpack(F.col("b"), "uint64", "big", scale=0.5).alias("lit"),
        codecs.unpack(F.col("b"), "uint64", "big", scale_column=F.col("s")).alias("col"),
    ).collect()
    assert got[0].lit == [float((1 << 64) - 1) * 0.5] and got[0].col == got[0].lit
    assert got[1].col is None and got[2].col is None and got[3].col is None
    for bad in (0, math.inf, math.nan, "x", True):
        with pytest.raises(InvalidPipelineError):
            codecs.unpack(F.col("b"), "int8", scale=bad)
    with pytest.raises(InvalidPipelineError):
        codecs.unpack(F.col("b"), "int128")
    with pytest.raises(InvalidPipelineError):
        codecs.unpack(F.col("b"), "int8", "middle")


def test_gzip(spark):
    import gzip

    plain = "x" * 100_000 + "é"
    packed = gzip.compress(plain.encode())
    rows = [packed, packed + gzip.compress(b"2"), packed[:-5], packed + b"tail", b"not gzip", b"", None]
    df = spark.createDataFrame([(i, None if r is None else bytearray(r)) for i, r in enumerate(rows)], "i int, b binary")
    got = [r.v for r in df.orderBy("i").select(codecs.gunzip(F.col("b")).alias("v")).collect()]
    assert got[0] == plain.encode() and got[1] == plain.encode() + b"2"
    assert got[2] is None and got[3] is None and got[4] is None and got[5] == b"" and got[6] is None
    back = df.filter("i = 0").select(codecs.gunzip(codecs.gzip(F.col("b"))).alias("v")).first()["v"]
    assert back == packed


def test_encode_chain(spark):
    import base64
    import gzip
    import json

    df = spark.createDataFrame([(1, "a" * 500)], "i int, s string")
    value = df.select(codecs.encode_payload([F.col("i"), F.col("s")]).alias("v")).first()["v"]
    assert json.loads(gzip.decompress(base64.b64decode(value, validate=True))) == {"i": 1, "s": "a" * 500}
    for chain in ((), ("gzip",), ("json", "zip"), ("json", "base64", "gzip")):
        with pytest.raises(InvalidPipelineError):
            codecs.encode_payload([F.col("i")], chain)


def test_buckets(one):
    assert exp_buckets(1.0, 2.0, 4) == [1.0, 2.0, 4.0, 8.0]
    with pytest.raises(InvalidPipelineError):
        exp_buckets(0, 2, 3)

    def quantile(q, bounds, counts):
        c = F.array(*[F.lit(x).cast("bigint") for x in counts])
        b = F.array(*[F.lit(x) for x in bounds])
        return one(quantile_of(c, b, q)), one(highest_bound(c, b))

    assert quantile(0.5, [0.001, 0.002], [1, 1, 0])[0] == pytest.approx(0.001)
    assert quantile(0.99, [0.001, 0.002], [1, 1, 0])[0] == pytest.approx(0.001 + 0.001 * 0.98)
    assert quantile(0.5, [0.004], [2, 0])[0] == pytest.approx(0.002)
    assert quantile(0.5, [0.001, 0.002], [0, 0, 5]) == (0.002, 0.002)
    assert quantile(0.5, [0.001, 0.002], [0, 0, 0]) == (0.0, 0.0)
    assert quantile(0.99, [1.0, 2.0, 4.0], [0, 10, 0, 0])[1] == 2.0


def brute_quantile(q, bounds, counts):
    """The definition, sample by sample bucket."""
    total = sum(counts)
    if total == 0:
        return 0.0
    seen = 0
    for i, n in enumerate(counts):
        if n and seen + n >= q * total:
            if i == len(bounds):
                return bounds[-1]
            low = bounds[i - 1] if i else 0.0
            return low + (bounds[i] - low) * (q * total - seen) / n
        seen += n
    return bounds[-1]


def test_quantile_matches_definition(spark):
    @settings(max_examples=1, deadline=None)
    @given(st.lists(st.lists(st.integers(0, 50), min_size=5, max_size=5), min_size=60, max_size=60))
    def check(rows):
        bounds = exp_buckets(0.001, 2.0, 4)
        df = spark.createDataFrame([(r,) for r in rows], "c array<bigint>")
        b = F.array(*[F.lit(x) for x in bounds])
        qs = (0.01, 0.5, 0.9, 0.99, 1.0)
        got = df.select("c", *[quantile_of(F.col("c"), b, q).alias(f"q{i}") for i, q in enumerate(qs)]).collect()
        for row in got:
            values = [row[f"q{i}"] for i in range(len(qs))]
            assert values == pytest.approx([brute_quantile(q, bounds, row.c) for q in qs])
            assert values == sorted(values)

    check()


def test_offsets_fail_instead_of_wrapping(spark, monkeypatch):
    monkeypatch.setattr(codecs, "OFFSET_LIMIT", 100)
    values = pa.array([b"\x01" * 60, b"\x02" * 60])
    with pytest.raises(OverflowError):
        codecs._decode(values, np.array([True, True]), "u1", "i8", None)
    assert len(codecs._decode(values[:1], np.array([True]), "u1", "i8", None)[0]) == 60
    with pytest.raises(OverflowError):
        codecs.binary_array([b"x" * 101, None])
    assert codecs.binary_array([b"x" * 100, None]).null_count == 1


def test_calendar_days_equal_the_calendar(spark):
    first, last = (datetime.date(y, m, d) for y, m, d in ((1678, 1, 1), (2261, 12, 31)))
    days = spark.range((first - datetime.date(1970, 1, 1)).days, (last - datetime.date(1970, 1, 1)).days + 1)
    date = F.date_from_unix_date(F.col("id").cast("int"))
    rows = days.select("id", F.date_format(date, "MM/dd/yyyy").alias("plain"), F.date_format(date, "yyyy.DDD 23:59").alias("ordinal"))
    plain = timestamps.ts_from_text(F.col("plain"), "01/02/2006") - F.col("id") * 86_400_000_000_000
    ordinal = timestamps.ts_from_text(F.col("ordinal"), "2006.002 15:04") - F.col("id") * 86_400_000_000_000
    found = rows.groupBy(plain.alias("a"), ordinal.alias("b")).count().collect()
    assert [tuple(r) for r in found] == [(0, 86_340_000_000_000, days.count())]


@pytest.mark.parametrize(
    ("value", "fmt", "offset"),
    [
        ("2024-01-01T12:00:00+19:00", "rfc3339", -19 * 3600), ("2024-01-01T12:00:00-24:00", "rfc3339", 24 * 3600),
        ("2024-01-01T12:00:00.000+23:60", "rfc3339", -24 * 3600),
        ("2024-01-01 12:00:00+01:02:03", "2006-01-02 15:04:05Z07:00:00", -3723),
        ("2024-01-01 12:00:00-200000", "2006-01-02 15:04:05-070000", 72000), ("2024-01-01 12:00:00Z", "2006-01-02 15:04:05Z070000", 0),
        ("2024 001 12:00", "2006 002 15:04", 0), ("2024   1 12:00", "2006 __2 15:04", 0), ("2024 366 12:00", "2006 002 15:04", 365 * 86400),
        ("2024-03-01 061 12:00", "2006-01-02 002 15:04", 60 * 86400), ("Mar 2024 061 12:00", "Jan 2006 002 15:04", 60 * 86400),
    ],
)
def test_wide_offsets_and_days_of_the_year(one, value, fmt, offset):
    # 2024-01-01T12:00:00Z
    assert one(timestamps.to_ts_ns(F.lit(value), fmt)) == (1704110400 + offset) * 1_000_000_000


@pytest.mark.parametrize(
    ("value", "fmt"),
    [
        ("2024-01-01T12:00:00+25:00", "rfc3339"), ("2023 366", "2006 002"), ("2024 000", "2006 002"), ("2024 367", "2006 002"),
        ("2024-02-01 061", "2006-01-02 002"), ("2024-03-02 061", "2006-01-02 002"), ("02/29/2023", "01/02/2006"), ("00/01/2023", "01/02/2006"),
        ("04/31/2023", "01/02/2006"), ("1 Jax 2024", "2 Jan 2006"), ("1 anf 2024", "2 Jan 2006"), ("01/01/2024 24:00", "01/02/2006 15:04"),
        ("01/01/2024 13 PM", "01/02/2006 03 PM"), ("01/01/2263", "01/02/2006"), ("09/20/1677", "01/02/2006"),
        ("01/01/\x012024", "01/02/2006"), ("\x0101\x0101\x012024", "01/02/2006"), ("", "01/02/2006"),
        ("01/01/2024 +24:61", "01/02/2006 -07:00"),
    ],
)
def test_days_and_offsets_out_of_range(one, value, fmt):
    assert one(timestamps.to_ts_ns(F.lit(value), fmt)) is None


def test_first_and_last_nanosecond(one):
    for value, want in (("21 Sep 1677 00:12:43.145224192", -(1 << 63)), ("11 Apr 2262 23:47:16.854775807", (1 << 63) - 1)):
        assert one(timestamps.to_ts_ns(F.lit(value), "2 Jan 2006 15:04:05")) == want
    for value in ("21 Sep 1677 00:12:43.145224191", "11 Apr 2262 23:47:16.854775808"):
        assert one(timestamps.to_ts_ns(F.lit(value), "2 Jan 2006 15:04:05")) is None
