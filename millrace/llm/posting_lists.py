"""Approximate nearest neighbours by balanced posting lists.

Vectors are clustered; each cluster is a posting list. A vector near a border is also
written to the lists of further centroids that are nearly as close and lie in other
directions. A query finds its closest centroids with a graph search in memory and reads
those lists whose distance is within a ratio of the smallest one. Lists are scanned exactly
and scored on the original vectors, in double precision.

Equal vectors are one entry that carries its smallest ids, as many as any answer can need,
so a vector that very many rows share neither fills a list nor repeats a search. Longer
lists than others are dealt over several tasks by a hash. Vectors of different lengths are
indexed apart; lengths that few vectors have are one list each, which is read whole.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .shared import bound_batches, stored


@dataclass(frozen=True)
class Settings:
    """``sample`` vectors at most train the centroids, of which there are ``lists`` at most,
    one for about ``per_list`` vectors; the sample bounds what the driver holds. It is shared
    by the ``lengths`` most common lengths; vectors of others are one list by length."""

    sample: int = 20_000
    lengths: int = 16
    lists: int = 2048
    per_list: int = 128
    rounds: int = 8
    # Copies of a vector, and how much farther than the nearest a further list may be.
    copies: int = 4
    border: float = 1.12
    # Lists a query reads: within the ratio, ``least`` in any case, and no more than ``most``
    # or this share of all lists, whichever is larger.
    ratio: float = 1.4
    least: int = 16
    most: int = 96
    share: float = 0.1
    # The centroid graph: neighbours of each node, width of the search, which is wider by a
    # third than what a query may read.
    links: int = 16
    width: int = 128
    # Entries or queries of a list in one task.
    block: int = 4096
    seed: int = 3


class Centroids:
    """Unit centroids with a graph of near neighbours."""

    def __init__(self, points: np.ndarray, links: int, seed: int):
        self.points = points
        near = np.argsort(-(points @ points.T), axis=1, kind="stable")[:, 1 : links + 1]
        far = np.random.default_rng(seed).integers(0, len(points), (len(points), 2))
        both: list[set[int]] = [set() for _ in points]
        for i, row in enumerate(np.hstack([near, far]).tolist()):
            for j in row:
                if i != j:
                    both[i].add(j)
                    both[j].add(i)
        self.neighbours = [np.array(sorted(x), np.int64) for x in both]
        self.starts = np.unique(np.linspace(0, len(points) - 1, 8).astype(int)) if len(points) else np.zeros(0, int)

    def search(self, vector: np.ndarray, width: int) -> list[tuple[float, int]]:
        """The nearest centroids found, as (distance, number), nearest first."""
        seen = set(self.starts.tolist())
        found = [(-float(self.points[i] @ vector), i) for i in seen]
        heap = sorted(found)
        heapq.heapify(heap)
        best = sorted(found)[:width]
        while heap:
            score, node = heapq.heappop(heap)
            if len(best) >= width and score > best[-1][0]:
                break
            new = [j for j in self.neighbours[node].tolist() if j not in seen]
            if not new:
                continue
            seen.update(new)
            scored = list(zip((-(self.points[new] @ vector)).tolist(), new))
            limit = best[-1][0] if len(best) >= width else float("inf")
            for item in scored:
                if item[0] <= limit:
                    heapq.heappush(heap, item)
            best = sorted(best + scored)[:width]
        return [(float(np.sqrt(max(0.0, 2 + 2 * s))), i) for s, i in best]


def balanced_means(vectors: np.ndarray, count: int, rounds: int, seed: int) -> np.ndarray:
    """Spherical means; a growing handicap on crowded clusters evens their sizes."""
    rng = np.random.default_rng(seed)
    means = vectors[rng.choice(len(vectors), count, replace=False)].copy()
    handicap, mean = np.zeros(count, np.float32), len(vectors) / count
    for _ in range(rounds):
        nearest = np.concatenate(
            [np.argmax(part @ means.T - handicap, axis=1) for part in np.array_split(vectors, max(1, len(vectors) // 2000))]
        )
        sizes = np.bincount(nearest, minlength=count)
        handicap += (0.02 * np.clip(sizes / mean - 1, -1, 2)).astype(np.float32)
        sums = np.zeros_like(means)
        np.add.at(sums, nearest, vectors)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        fresh = vectors[rng.choice(len(vectors), count)]
        means = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), fresh).astype(np.float32)
    return means


def lists_of(vector: np.ndarray, centroids: Centroids, settings: Settings) -> list[int]:
    """The lists a vector is written to. A further one must be within the border's ratio
    and not closer to a list already chosen than to the vector."""
    chosen: list[int] = []
    found = centroids.search(vector, 4 * settings.copies)
    for distance, i in found:
        if distance > settings.border * found[0][0] or len(chosen) == settings.copies:
            break
        point = centroids.points[i]
        if all(np.sqrt(max(0.0, 2 - 2 * float(point @ centroids.points[j]))) >= distance for j in chosen):
            chosen.append(i)
    return chosen or [found[0][1]]


def lists_for(vector: np.ndarray, centroids: Centroids, settings: Settings) -> list[int]:
    """The lists a query reads."""
    most = max(settings.most, int(np.ceil(settings.share * len(centroids.points))))
    found = centroids.search(vector, max(settings.width, most * 4 // 3))
    limit = settings.ratio * found[0][0]
    return [i for n, (d, i) in enumerate(found) if n < settings.least or n < most and d <= limit]


def unit(values: np.ndarray) -> np.ndarray:
    """Rows of unit length in single precision; large and small components are safe."""
    scaled = values / np.abs(values).max(axis=1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def matrix(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1) if blobs else np.zeros((0, 0))


def entries(df: DataFrame, vec_id: str, vector: str, keep: int) -> tuple[DataFrame, DataFrame]:
    """Distinct usable vectors ``(v binary, ids)``, as doubles with their ``keep`` smallest
    ids, and all usable rows ``(id, v)``."""
    parts = F.col(vector).cast("array<double>")
    usable = F.size(parts) > 0
    usable &= ~F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable &= F.exists(parts, lambda x: x != 0)
    rows = df.where(F.col(vec_id).isNotNull() & F.coalesce(usable, F.lit(False)))
    # Adding zero makes one value of both zeros.
    rows = rows.select(F.col(vec_id).cast("long").alias("id"), F.transform(parts, lambda x: x + F.lit(0.0)).alias("x"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            values, ends = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy().cumsum()
            blobs = [v.tobytes() for v in np.split(values, ends[:-1])] if len(ends) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], ["id", "v"])

    bound_batches(df.sparkSession)
    flat = one_each(stored(rows.mapInArrow(packed, "id bigint, v binary"), "vectors"))
    # A rank limit is applied before rows are shuffled, so a common vector costs little.
    place = F.dense_rank().over(Window.partitionBy("v").orderBy("id"))
    few = flat.withColumn("place", place).where(F.col("place") <= keep)
    return stored(few.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids")), "entries"), flat


def one_each(flat: DataFrame) -> DataFrame:
    """Rows whose id has other vectors too, only those of the vector with the smallest hash.
    Hashes alone are shuffled; ids of several vectors are mostly few or none."""
    mark = F.xxhash64("v")
    marks = flat.groupBy("id").agg(F.min(mark).alias("own"), F.max(mark).alias("top"))
    several = stored(marks.where("own < top").select("id", "own"), "several", small=True)
    if not several.limit(1).count():
        return flat
    own = flat.join(several, "id", "left").where(F.col("own").isNull() | (mark == F.col("own")))
    return stored(own.select("id", "v"), "single")


def trained(vectors: DataFrame, settings: Settings) -> dict[int, Centroids]:
    """Centroids for each common length in bytes, from bounded samples of its vectors."""
    lengths = vectors.groupBy(F.length("v").alias("size")).count().where(F.col("count") >= 2 * settings.per_list)
    held = lengths.orderBy(F.desc("count"), "size").limit(settings.lengths).collect()
    models = {}
    for size, count in held:
        own = vectors.where(F.length("v") == size)
        sample = own.orderBy(F.xxhash64("v"), "v").limit(settings.sample // len(held)).select("v")
        points = unit(matrix(sample.toArrow().column(0).to_pylist()))
        lists = max(1, min(settings.lists, count // settings.per_list, len(points) // 4 or 1))
        means = balanced_means(points, lists, settings.rounds, settings.seed)
        models[size] = Centroids(means, settings.links, settings.seed)
    return models


def neighbours(
    df: DataFrame, queries, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()
) -> DataFrame:
    """The ``k`` nearest rows by cosine of every row whose id meets the condition ``queries``.

    Returns ``query_id, rank, vec_id, score``: nearest first, ties to the smaller id. Rows
    with the query's own id are no candidates for it. A repeated id counts once; if it has
    several vectors, the one with the smallest hash stands for it. Rows whose id is null, or
    whose vector is null, empty, zero or holds null or non-finite components take no part.
    Only vectors of the query's length are its candidates. With fewer candidates all of them
    are returned; no usable row gives no result. Other columns are ignored.
    """
    spark = df.sparkSession
    distinct, rows = entries(df, vec_id, vector, k + 1)
    shared = spark.sparkContext.broadcast(trained(distinct, settings))
    asked = rows.select(F.col("id").alias(vec_id), "v").where(queries)
    asked = asked.select(F.col(vec_id).alias("query_id"), "v").distinct()
    # One search for each distinct vector, named by its smallest query.
    searches = stored(asked.groupBy("v").agg(F.min("query_id").alias("search")), "searches")

    def placed(pick):
        def lists(blob: bytes) -> list[int]:
            """Numbers of lists, each with the length, so that no list holds two lengths."""
            model = shared.value.get(len(blob))
            found = pick(unit(matrix([blob]))[0], model, settings) if model else [0]
            return [len(blob) << 16 | i for i in found]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = pa.array([lists(v) for v in batch.column(0).to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "lists"])

        return run

    indexed = distinct.mapInArrow(placed(lists_of), "v binary, ids array<bigint>, lists array<bigint>")
    postings = stored(indexed.select("v", "ids", F.explode("lists").alias("list")), "postings")
    wanted = searches.select("v", "search").mapInArrow(placed(lists_for), "v binary, search bigint, lists array<bigint>")
    wanted = stored(wanted.select("v", "search", F.explode("lists").alias("list")), "wanted")
    # Blocks of a list and of its queries: one task holds one block of each. One number
    # for each list, of which there are ``settings.lists`` for each of ``settings.lengths``
    # lengths at most, and one for each further length.
    blocks = [
        {r["list"]: -(-r["count"] // settings.block) for r in part.groupBy("list").count().collect()}
        for part in (postings, wanted)
    ]
    table = spark.createDataFrame(
        [(i, blocks[0].get(i, 1), blocks[1].get(i, 1)) for i in sorted(blocks[0].keys() | blocks[1].keys())],
        "list bigint, pb int, qb int",
    )
    dealt = F.pmod(F.xxhash64("v"), F.lit(1 << 30)).cast("int")
    left = postings.join(F.broadcast(table), "list").select(
        "list", (dealt % F.col("pb")).alias("p"), F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("q"), "v", "ids"
    )
    right = wanted.join(F.broadcast(table), "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("pb") - 1)).alias("p"), (dealt % F.col("qb")).alias("q"), "v", "search"
    )
    keys = ["list", "p", "q"]
    scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        lambda a, b: scanned(a, b, k + 1), "search bigint, id bigint, score double"
    )
    best = scored.distinct()
    place = Window.partitionBy("search").orderBy(F.desc("score"), "id")
    best = best.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k + 1)
    found = stored(best.groupBy("search").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("best")), "best")
    others = F.filter("best", lambda x: x["id"] != F.col("query_id"))
    answers = asked.join(searches, "v").join(found, "search").select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "x"))
    return answers.select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score")
    )


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, the same for equal rows."""
    dot = (a * b).sum(axis=1)
    return dot / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def scanned(postings: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best ids of a block for each query."""
    out: list[tuple[int, int, float]] = []
    if len(postings) and len(queries):
        points, ids = matrix(postings["v"].tolist()), postings["ids"].tolist()
        normal = unit(points)
        for start in range(0, len(queries), 512):
            part = queries.iloc[start : start + 512]
            asked = matrix(part["v"].tolist())
            rough = unit(asked) @ normal.T
            for i, search in enumerate(part["search"].tolist()):
                row = rough[i]
                near = np.arange(len(row))
                if len(row) > k:
                    near = np.nonzero(row >= np.partition(row, -k)[-k] - 1e-5)[0]
                exact = cosines(points[near], np.broadcast_to(asked[i], (len(near), asked.shape[1])))
                ranked = sorted((-s, int(x)) for s, j in zip(exact.tolist(), near) for x in ids[j])[:k]
                out += [(search, x, -s) for s, x in ranked]
    return pd.DataFrame(out, columns=["search", "id", "score"])
