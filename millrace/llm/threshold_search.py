"""Exact top-k inner products by the threshold algorithm over sorted lists.

Every block of vectors has one list for each dimension, sorted by the value there. A query
goes down all lists of its non-zero components at once, from the large end where its
component is positive, else from the small end. Every vector met is scored in full. The sum
of the products at the depth reached bounds the score of every vector not met yet: once it
is below the k-th best score, the search ends. Ties are decided by the id, so the bound has
to be below, not at, that score.

Spark deals vectors and queries in blocks; a task holds one block of each. The k-th scores
in the first blocks start the bound of all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import bound_batches, stored

# Vectors and queries in one task.
BLOCK, QUERY_BLOCK = 4096, 512
# How deep the first step goes down each list; every further one goes as deep as all before.
FIRST_STEP = 16
# Whole numbers up to these add up exactly: in doubles, and in long integers.
EXACT_DOUBLE, EXACT_LONG = 1 << 53, 1 << 62
LONG = (-(1 << 63), (1 << 63) - 1)


class SortedLists:
    """A block of vectors with a sorted list for each dimension.

    ``values`` are whole numbers, ``ids`` may repeat; the best score of an id counts.
    """

    def __init__(self, values: np.ndarray, ids: np.ndarray):
        self.values, self.ids = values, ids
        self.order = np.argsort(values, axis=0, kind="stable").T.astype(np.int32)
        self.repeated = len(np.unique(ids)) < len(ids)

    def kth(self, scores: np.ndarray, ids: np.ndarray, k: int):
        """The k-th best score among distinct ids; None if they are fewer."""
        if self.repeated:
            scores = best_by_id(scores, ids)[0]
        if len(scores) < k:
            return None
        return np.sort(scores)[-k] if scores.dtype == object else np.partition(scores, -k)[-k]

    def search(self, query: np.ndarray, own: int, k: int, floor=None) -> tuple[np.ndarray, np.ndarray, int]:
        """Scores and ids of the ``k`` best vectors but those of id ``own``, and the depth
        reached. Vectors that score below ``floor`` may be left out."""
        size = len(self.ids)
        active = np.nonzero(query)[0]
        seen = self.ids == own
        rows, scores = np.empty(0, np.int64), np.empty(0, self.values.dtype)
        depth, limit = 0, floor
        if not len(active):  # every vector scores 0
            rows, depth = np.nonzero(~seen)[0], size
            scores = np.zeros(len(rows), self.values.dtype)
        down, up = active[query[active] > 0], active[query[active] < 0]
        everything = size - int(seen.sum())
        while depth < size and len(rows) < everything:
            to = min(size, max(FIRST_STEP, 2 * depth))
            met = np.zeros(size, bool)
            met[self.order[down, size - to : size - depth].ravel()] = True
            met[self.order[up, depth:to].ravel()] = True
            met &= ~seen
            new = np.nonzero(met)[0]
            seen |= met
            rows, scores, depth = np.concatenate([rows, new]), np.concatenate([scores, self.values[new] @ query]), to
            best = self.kth(scores, self.ids[rows], k)
            if best is not None and (limit is None or best > limit):
                limit = best
            bound = query[down] @ self.values[self.order[down, size - depth], down]
            bound += query[up] @ self.values[self.order[up, depth - 1], up]
            if limit is not None and bound < limit:
                break
        keep = slice(None) if limit is None else scores >= limit
        scores, ids = scores[keep], self.ids[rows][keep]
        if self.repeated:
            scores, ids = best_by_id(scores, ids)
        top = np.lexsort((ids, -scores))[:k]
        return scores[top], ids[top], depth


def best_by_id(scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best score of every id."""
    order = np.lexsort((-scores, ids))
    first = np.ones(len(order), bool)
    first[1:] = ids[order][1:] != ids[order][:-1]
    return scores[order[first]], ids[order[first]]


def whole_numbers(blobs: list[bytes], scale: int) -> np.ndarray:
    """``floor(scale * x)`` of vectors, as doubles that hold whole numbers."""
    values = np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * scale), np.finfo(np.float64).min, np.finfo(np.float64).max)


def exact(values: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the fastest type in which every product adds up exactly."""
    largest = [max(1, int(np.abs(x).max(initial=0))) for x in (values, queries)]
    reach = largest[0] * largest[1] * max(1, values.shape[1])
    if reach < EXACT_DOUBLE:
        return values, queries
    if reach < EXACT_LONG:
        return values.astype(np.int64), queries.astype(np.int64)
    return tuple(np.array([[int(v) for v in row] for row in x], object).reshape(x.shape) for x in (values, queries))


def searched(vectors: pd.DataFrame, queries: pd.DataFrame, k: int, scale: int) -> pd.DataFrame:
    """The ``k`` best of one block for each query of a block."""
    out: list[tuple[int, int, int, int]] = []
    if len(vectors) and len(queries):
        values, asked = exact(whole_numbers(vectors["v"].tolist(), scale), whole_numbers(queries["w"].tolist(), scale))
        lists = SortedLists(values, vectors["id"].to_numpy(np.int64))
        for query, own, floor in zip(asked, queries["query_id"].tolist(), queries["floor"].tolist()):
            scores, ids, depth = lists.search(query, own, k, None if pd.isna(floor) else int(floor))
            out += [(own, i, min(max(int(s), LONG[0]), LONG[1]), depth) for s, i in zip(scores.tolist(), ids.tolist())]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score", "depth"]).astype("int64")


SEARCHED = "query_id bigint, vec_id bigint, score bigint, depth bigint"


def usable_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Distinct ``(id, v, size)`` of the rows that take part, components as packed doubles."""
    parts = F.col(vector).cast("array<double>")
    finite = ~F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.where(F.col(vec_id).isNotNull() & F.coalesce(finite, F.lit(False)))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            values, ends = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy().cumsum()
            blobs = [v.tobytes() for v in np.split(values, ends[:-1])] if len(ends) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], ["id", "v"])

    bound_batches(df.sparkSession)
    flat = rows.select(F.col(vec_id).cast("long").alias("id"), parts.alias("x")).mapInArrow(packed, "id bigint, v binary")
    return flat.distinct().withColumn("size", F.length("v"))


def blocked(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Deal the rows of each vector length in blocks of about ``size``, by a hash."""
    counts = rows.groupBy("size").count().select("size", F.ceil(F.col("count") / size).alias("blocks"))
    return rows.join(counts, "size").withColumn(name, F.pmod(F.xxhash64("id", "v"), F.col("blocks")))


def cells(vectors: DataFrame, queries: DataFrame, k: int, scale: int) -> DataFrame:
    """Search every block of vectors for every block of queries of the same length."""
    query_blocks = queries.select("size", "qb").distinct()
    vector_blocks = vectors.select("size", "pb").distinct()
    left = vectors.select("size", "pb", "id", "v").join(query_blocks, "size")
    right = queries.select("size", "qb", F.col("id").alias("query_id"), "v", "floor").join(vector_blocks, "size")
    # Other names on one side, since both come from the same table.
    right = right.select(F.col("size").alias("s"), F.col("pb").alias("p"), F.col("qb").alias("q"), "query_id", F.col("v").alias("w"), "floor")
    found = left.groupBy("size", "pb", "qb").cogroup(right.groupBy("s", "p", "q"))
    return found.applyInPandas(lambda a, b: searched(a, b, k, scale), SEARCHED)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score, depth`` of the ``k`` best ids of every query; depth
    is the largest one reached for the query."""
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"), F.max("depth").alias("depth"))
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def top_products(
    df: DataFrame, queries: Column, k: int = 10, scale: int = 1024, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` rows of largest inner product for every row whose id meets ``queries``.

    Components are ``floor(scale * x)`` in double precision. Returns ``query_id, rank,
    vec_id, score``: largest first, ties to the smaller id. Rows with the query's own id
    are no candidates for it. An id that repeats is one query and one candidate: between
    two ids the best product of their vectors counts. Vectors of different lengths have no
    product; an empty vector scores 0 with other empty ones. Rows whose id is null or whose
    vector is null or holds null or non-finite components take no part; zero vectors do.
    Scores beyond a long are its largest or smallest value. With fewer candidates all of
    them are returned; an empty table gives no rows. Other columns are ignored.
    """
    vectors = stored(blocked(usable_vectors(df, vec_id, vector), BLOCK, "pb"), "blocks")
    asked = vectors.select("id", "v", "size").withColumnRenamed("id", vec_id).where(queries).withColumnRenamed(vec_id, "id")
    asked = stored(blocked(asked, QUERY_BLOCK, "qb"), "asked")
    first = stored(cells(vectors.where("pb = 0"), asked.withColumn("floor", F.lit(None).cast("long")), k, scale), "first")
    floors = best_of(first, k).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    rest = cells(vectors.where("pb > 0"), asked.join(floors, "id", "left"), k, scale)
    return best_of(first.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")
