import itertools
import random
import time
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing
from millrace.llm.mixing import mix, routed, targets
from millrace.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def iterated(sizes, weights, repeats):
    """The rule as written: share out, cut what is above, share the excess, until none is above."""
    found = [Fraction(0)] * len(sizes)
    full = [False] * len(sizes)
    while True:
        rest = sum(sizes) - sum(f for f, x in zip(found, full) if x)
        weight = sum(w for w, x in zip(weights, full) if not x)
        for i, w in enumerate(weights):
            if not full[i]:
                found[i] = Fraction(rest * w, weight)
        above = [i for i, x in enumerate(full) if not x and found[i] > repeats * sizes[i]]
        if not above:
            return found
        for i in above:
            found[i], full[i] = Fraction(repeats * sizes[i]), True


def test_targets_equal_the_iteration():
    rng = random.Random(1)
    for _ in range(500):
        n = rng.randrange(1, 9)
        sizes = [rng.choice([0, 1, 5, rng.randrange(1000), rng.randrange(10**6)]) for _ in range(n)]
        weights = [i % 3 + 1 for i in range(n)]
        got = targets(sizes, weights, 3)
        assert all(abs(a - b) <= 1e-9 * max(1, b) for a, b in zip(got, iterated(sizes, weights, 3)))


def cost(pattern_flow, size):
    return sum(c * min(max(pattern_flow - i * size, 0), size) for i, c in enumerate(mixing.PASS_COSTS))


def test_flow_is_cheapest_on_small_cases():
    rng = random.Random(2)
    for _ in range(60):
        patterns = {("a",): rng.randrange(1, 4), ("b",): rng.randrange(1, 4), ("a", "b"): rng.randrange(1, 4)}
        quotas = {"a": rng.randrange(0, 9), "b": rng.randrange(0, 9)}
        got = routed(patterns, quotas)
        best = None
        ranges = [range(3 * s + 1) for s in patterns.values()]
        for a, b, ab in itertools.product(*ranges):
            for x in range(ab + 1):
                if a + x <= quotas["a"] and b + ab - x <= quotas["b"]:
                    value = (-(a + b + ab), sum(cost(f, s) for f, s in zip((a, b, ab), patterns.values())))
                    best = min(best or value, value)
        assert (-sum(got.values()), sum(cost(got[p], s) for p, s in patterns.items())) == best


def test_query_equals_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = db.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({ORACLES['op7_mixing']}) ORDER BY 1").fetchall()
    got = QUERIES["op7_mixing"](spark, SF).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want and len(got) == 200


def test_rows(documents):
    rows = [(i, "w " * (i % 9), None, ["a", "b", "c", None][i % 4]) for i in range(400)]
    rows += [(1000, None, None, "a"), (1001, "", None, "z"), (None, "x y", None, "b"), (None, "x y", None, "b")]
    rows += [(2000, "long " * 5000, None, "b")]
    out = mix(documents(rows))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "ids", "size", "source_size", "target", "taken", "times"]
    got = out.collect()
    assert len(got) == len(rows)
    for source in ("a", "b", "c", "z", None):
        own = [r for r in got if r.source == source]
        size = sum(r.size for r in own)
        assert {r.source_size for r in own} == {size} and len({r.target for r in own}) == 1
        assert abs(sum(r.taken for r in own) - own[0].target) <= max((r.size for r in own), default=0)
        assert all(r.taken == r.size * r.times and r.times <= 3 for r in own)
    again = mix(documents(rows[::-1])).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


@pytest.mark.parametrize("doc_id", [7, None])
def test_ties_are_taken_in_part(documents, doc_id):
    # a and b hold the same words, weights 1 and 3: a gives half of its rows, b one and a half.
    rows = [(doc_id, "w w", None, s) for s in "ab" for _ in range(500)] + [(8, "x", None, "a"), (9, "x", None, "b")]
    got = mix(documents(rows), weights=(1, 3)).collect()
    assert len(got) == len(rows)
    for source in "ab":
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2
    assert {r.times for r in got if r.source == "a"} == {0, 1} and {r.times for r in got if r.source == "b"} == {1, 2}


def test_ties_equal_the_row_by_row_rule(documents, tmp_path):
    rng = random.Random(3)
    rows = [(rng.randrange(4), "w " * rng.randrange(4), None, rng.choice("abc")) for _ in range(600)]
    docs = documents(rows)
    docs.write.parquet(str(tmp_path / "documents"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    names = "doc_id, size, source_size, target, taken"
    want = db.execute(f"SELECT {names} FROM ({ORACLES['op7_mixing']})").fetchall()
    assert sorted(map(tuple, mix(docs).select(*names.split(", ")).collect())) == sorted(want)


def test_clashing_columns(documents):
    docs = documents([(i, "w w", None, "ab"[i % 2]) for i in range(40)])
    odd = docs.select("*", *[F.lit(1).alias(c) for c in ("_members", "_mark", "_key", "_row", "_id", "last", "edge", "a.b")])
    got = mix(odd, weights=(1, 3)).collect()
    assert len(got) == 40 and got[0]["a.b"] == got[0]["_row"] == got[0]["edge"] == 1
    assert sorted(r.taken for r in got) == sorted(r.taken for r in mix(docs, weights=(1, 3)).collect())


def test_flow_time_grows_with_the_patterns():
    def seconds(n):
        rng = random.Random(4)
        patterns = {}
        while len(patterns) < n:
            patterns[tuple(sorted(rng.sample(range(60), 3)))] = rng.randrange(1, 1000)
        total = sum(patterns.values())
        quotas = {s: total * (s % 3 + 1) // 120 for s in range(60)}
        start = time.perf_counter()
        found = routed(patterns, quotas)
        assert sum(found.values()) == sum(quotas.values())
        return time.perf_counter() - start

    once = seconds(800)
    assert once < 2 and seconds(3200) < 12 * once + 0.5


def test_overlapping_sources(documents):
    rows = [(i, "w w", None, "a") for i in range(60)]
    both = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("a"), F.lit("b"))).when(
        F.col("doc_id") % 3 == 1, F.array(F.lit("b"))).otherwise(F.array(F.lit("a")))
    got = mix(documents(rows), sources=both, weights=(1, 3)).collect()
    assert sum(r.taken for r in got) == pytest.approx(120, abs=2) and max(r.times for r in got) <= 3
    # b's quota of 90 words takes all 80 words it is in and repeats ten; a's 30 come from a alone.
    assert sum(r.taken for r in got if r.doc_id % 3 == 2) == pytest.approx(30, abs=2)
    assert sum(max(r.taken - r.size, 0) for r in got) == pytest.approx(10, abs=2)


def test_empty_table(documents):
    assert mix(documents([])).collect() == []
