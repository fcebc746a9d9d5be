import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm.posting_lists import Centroids, Settings, cosines, entries, lists_for, neighbours, unit
from millrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(ids, vectors, queries, k):
    """All candidates by cosine, ties to the smaller id."""
    out = {}
    for q in queries:
        at = int(np.nonzero(ids == q)[0][0])
        scores = cosines(vectors, np.broadcast_to(vectors[at], vectors.shape))
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[q] = [(n + 1, int(ids[i]), float(scores[i])) for n, i in enumerate(order)]
    return out


def answers(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(x) for q, x in found.items()}


def test_recall_and_scores(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    want = brute(ids, vectors, [i for i in ids.tolist() if i % 50 == 0], 5)
    got = answers(QUERIES["op10_posting_lists"](spark, SF))
    assert got.keys() == want.keys()
    hits = sum(len({v for _, v, _ in got[q]} & {v for _, v, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 5 * len(want)
    exact = {(q, int(v)): s for q in want for v, s in zip(ids, cosines(vectors, np.broadcast_to(vectors[ids == q][0], vectors.shape)))}
    assert all(abs(s - exact[q, v]) < 1e-12 for q, x in got.items() for _, v, s in x)


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame(
        [(i, v, 1.0, 2) for i, v in rows], "vec_id bigint, embedding array<float>, score double, rank int"
    )


def test_recall_with_many_lists(vectors):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(30, 16))
    data = (centers[rng.integers(0, 30, 3000)] + 0.4 * rng.normal(size=(3000, 16))).astype(np.float32)
    settings = Settings(sample=1500, per_list=30, block=40)
    got = answers(neighbours(vectors([(i, v.tolist()) for i, v in enumerate(data)]), F.col("vec_id") % 50 == 0, 5, settings=settings))
    want = brute(np.arange(3000), data.astype(np.float64), range(0, 3000, 50), 5)
    assert sum(len({v for _, v, _ in got[q]} & {v for _, v, _ in want[q]}) for q in want) >= 0.95 * 300


def test_rows(vectors):
    nan, inf = float("nan"), float("inf")
    good = [(i, [1.0, float(i % 7), 0.5]) for i in range(1, 40)]
    same = [(i, [2.0, 4.0, -0.0]) for i in range(100, 400)] + [(401, [1.0, 2.0, 0.0]), (402, [2.0, 4.0, 0.0])]
    bad = [(50, None), (500, [0.0, 0.0, 0.0]), (550, [1.0, None, 2.0]), (600, [nan, 1.0, 1.0]), (650, [inf, 1.0, 1.0]),
           (700, []), (None, [1.0, 1.0, 1.0]), (750, [1.0, 2.0])]
    huge = [(800, [3e38, 3e38, 3e38]), (850, [1e-30, 1e-30, 1e-30])]
    rows = good + same + huge
    got = answers(neighbours(vectors(rows + bad + good[:3]), F.col("vec_id") % 50 == 0, 5))
    ids, data = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    want = brute(ids, np.float64(np.float32(data)) + 0.0, [100, 150, 200, 250, 300, 350, 800, 850], 5)
    assert got.keys() == want.keys()
    for q in want:
        assert [x[:2] for x in got[q]] == [x[:2] for x in want[q]], q
        assert np.allclose([x[2] for x in got[q]], [x[2] for x in want[q]], rtol=0, atol=1e-12)


def test_repeated_ids_and_other_lengths(vectors):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(1200, 3)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    # Ids 0 to 99 have a second vector, and some ids hold shorter ones.
    second = [(i, rng.normal(size=3).astype(np.float32).tolist()) for i in range(100)]
    short = [(2000 + i, rng.normal(size=2).astype(np.float32).tolist()) for i in range(900)] + [(3000, [1.0] * 7), (3050, [2.0] * 7)]
    table = vectors(rows + second + second[:50] + short)
    got = answers(neighbours(table, F.col("vec_id") % 50 == 0, 5, settings=Settings(per_list=40)))
    assert got.keys() == {i for i, _ in rows + short if i % 50 == 0}
    assert all([x[0] for x in found] == list(range(1, len(found) + 1)) for found in got.values())
    assert all(len({v for _, v, _ in found} - {q}) == len(found) for q, found in got.items())
    chosen = {r.id: np.frombuffer(r.v, np.float64) for r in entries(table, "vec_id", "embedding", 6)[1].collect()}
    assert chosen.keys() == {i for i, _ in rows + short}
    hits = wanted = 0
    for size in (2, 3, 7):
        ids = np.array([i for i, v in chosen.items() if len(v) == size])
        want = brute(ids, np.array([chosen[i] for i in ids.tolist()]), [i for i in ids.tolist() if i % 50 == 0], 5)
        assert all(len(got[q]) == len(want[q]) for q in want)
        hits += sum(len({v for _, v, _ in got[q]} & {v for _, v, _ in want[q]}) for q in want)
        wanted += sum(map(len, want.values()))
    assert hits >= 0.95 * wanted


def test_lists_read_follow_their_number():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(1500, 64)).astype(np.float32)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centroids, query = Centroids(points, 16, 1), unit(rng.normal(size=(1, 64)))[0]
    assert len(lists_for(query, centroids, Settings())) == 150
    assert len(lists_for(query, Centroids(points[:500], 16, 1), Settings())) == 96


def test_few_and_no_candidates(vectors):
    assert answers(neighbours(vectors([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])]), F.col("vec_id") == 0, 5)).keys() == {0}
    assert neighbours(vectors([(0, [1.0, 0.0])]), F.lit(True), 5).collect() == []
    assert neighbours(vectors([(0, None)]), F.lit(True), 5).collect() == []
    assert neighbours(vectors([]), F.lit(True), 5).collect() == []


def test_graph_search_finds_the_nearest():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(500, 8)).astype(np.float32)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centroids = Centroids(points, 16, 1)
    hits = sum(
        len({i for _, i in centroids.search(p, 32)[:8]} & set(np.argsort(-(points @ p))[:8].tolist())) for p in points[:100]
    )
    assert hits >= 0.97 * 800
