"""Exact Jaccard self-join of word shingles by token-combination prefixes.

Every document is the set of its shingles (64-bit fingerprints), in one global order: rare
fingerprints first, frequent ones last, by value within each class. With a similarity t,
a set x of size n may lack at most ``(1-t) n`` of its fingerprints in any partner, so

* partners that share a rare fingerprint share one of their first ``floor((1-t) n) + 1``
  rare ones: these are indexed singly;
* partners that share no rare fingerprint agree on the frequent ones but for the few that
  are missing on either side. A run of k neighbouring frequent fingerprints is broken by a
  missing one of x in k places and by an extra one of y in k-1 places; with r rare
  fingerprints spent already, the first ``floor(k ((1-t) n - r)) + 1`` runs of x cannot all
  be broken if ``t >= (k-1)/k``. So the prefix is extended to that many runs, and each run
  is indexed as one combination of k fingerprints. A set with too many rare fingerprints
  needs no run at all. ``run_length`` chooses k by t;
* sets so small that they have no such number of runs could all be broken. They index their
  first ``floor((1-t) n) - r + 1`` frequent fingerprints singly as well, which finds each
  other, and all their runs, which finds larger partners.

Candidates are cut by size, then by a parity sketch whose differing bits never exceed the
differing fingerprints, and verified on the whole sets.

Equal sets are one class from the start. Posting lists are not expanded into pairs at
first: each class is compared with the list's hub, and components are formed. Only lists
that still hold several components are compared further, and there only classes of
different components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .components import components
from .shared import ASCII_LOWER, by_text, stored

# A fingerprint in more documents than this is frequent.
RARE = 16
# Frequent fingerprints at most; beyond it, only the most frequent ones count as such.
# Any choice of them gives the same links: eight bytes each, in every task.
FREQUENT_LIMIT = 1 << 20
# Share of a document's fingerprints, the smallest ones, whose frequencies are counted.
COUNTED = 0.25
# Frequent fingerprints in a combination, at most.
RUN = 3
# Bits of the filter that finds the texts of candidates; eight of them are a byte.
FILTER_BITS = 1 << 25
# Bytes of the word hashes remembered in a task, and what an entry takes besides its word.
REMEMBERED, ENTRY = 24 << 20, 140


class Shingler:
    """Fingerprints of a text's distinct shingles, sorted."""

    def __init__(self, words: int):
        self.words, self.known, self.size = words, {}, 0

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().translate(ASCII_LOWER).split()
        if not words:
            return np.empty(0, np.int64)
        known = self.known
        if self.size > REMEMBERED:
            known.clear()
            self.size = 0
        for word in words:
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word)
                self.size += len(word) + ENTRY
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.words, len(words))
        mixed = np.full(len(words) - size + 1, size, np.uint64)
        for i in range(size):
            mixed = (mixed ^ hashes[i : len(words) - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed.view(np.int64))


def class_of(tokens: np.ndarray) -> int:
    """One id for equal sets."""
    return int.from_bytes(blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch_of(tokens: np.ndarray) -> bytes:
    """One parity bit for each residue; the number of bits is a power of two near the size."""
    bits = max(64, 1 << int(len(tokens)).bit_length())
    counts = np.bincount((tokens & (bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Bits that differ after folding the longer sketch onto the shorter."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def run_length(threshold: Fraction) -> int:
    """The longest combination, up to RUN, of which fewer break than large sets have."""
    return RUN if threshold == 1 else max(1, min(RUN, math.ceil(1 / (1 - threshold)) - 1))


def signatures(tokens: np.ndarray, frequent: np.ndarray, threshold: Fraction) -> tuple[int, np.ndarray]:
    """Number of rare fingerprints, and what the set is indexed by."""
    n, k = len(tokens), run_length(threshold)
    missing = int((1 - threshold) * n)
    common = among(tokens, frequent)
    rare, common = tokens[~common], tokens[common]
    parts = [rare[: missing + 1] | np.int64(1)]
    if len(rare) <= missing:
        runs = min(int(k * (1 - threshold) * n) - k * len(rare), len(common) - k) + 1
        if k > 1 and runs > 0:
            mixed = np.zeros(runs, np.uint64)
            for i in range(k):
                mixed = (mixed ^ common[i : i + runs].view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
                mixed ^= mixed >> np.uint64(31)
            parts.append(mixed.view(np.int64) & np.int64(-2))
        # Whether all runs could be broken, by the size alone, so that both partners know.
        if k == 1 or n - k < int(k * (1 - threshold) * n):
            parts.append(common[: missing - len(rare) + 1] | np.int64(1))
    return len(rare), np.concatenate(parts)


def head(tokens: np.ndarray) -> int:
    """How many of a document's smallest fingerprints are counted in any case."""
    return int(COUNTED * len(tokens)) + 2


def among(tokens: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Which tokens are in a sorted array."""
    if not len(chosen):
        return np.zeros(len(tokens), bool)
    return chosen[np.minimum(np.searchsorted(chosen, tokens), len(chosen) - 1)] == tokens


def frequent_tokens(texts: DataFrame, text: str, words: int) -> np.ndarray:
    """The sorted fingerprints of the frequent class, at most FREQUENT_LIMIT.

    The smallest fingerprints of every document are counted. Where most of these are
    frequent, as in large groups of near copies, the document's others are counted too, so
    that what is rare in it are its own changes.
    """
    spark = texts.sparkSession
    first = frequent_of(counts_of(texts, text, words, None))
    rest = frequent_of(counts_of(texts, text, words, spark.sparkContext.broadcast(first)))
    return np.union1d(first, rest)


def counts_of(texts: DataFrame, text: str, words: int, frequent) -> DataFrame:
    """``(token, n)`` of the heads, or, given their frequent tokens, of the rest of those
    documents whose heads mostly hold such."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in batches:
            parts = [np.empty(0, np.int64)]
            for value in batch.column(0).to_pylist():
                tokens = shingle(value)
                size = head(tokens)
                if frequent is None:
                    parts.append(tokens[:size])
                elif 2 * among(tokens[:size], frequent.value).sum() > size:
                    parts.append(tokens[size:])
            tokens, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(counts)], ["token", "n"])

    return by_text(texts, "token bigint, n bigint", rows, F.col(text)).groupBy("token").agg(F.sum("n").alias("n"))


def frequent_of(counts: DataFrame) -> np.ndarray:
    """The tokens counted more than RARE times, the most frequent ones if they are too many."""
    often = stored(counts.where(F.col("n") > RARE), "frequent", small=True)
    steps = often.groupBy(F.floor(F.log2("n") * 8).alias("step")).count().orderBy(F.desc("step")).collect()
    total, least = 0, None
    for step, count in steps:
        total += count
        if 2 * total > FREQUENT_LIMIT:
            break
        least = step
    if least is None:
        return np.empty(0, np.int64)
    kept = often.where(F.floor(F.log2("n") * 8) >= least).select("token").toArrow()
    return np.sort(kept.column(0).to_numpy().astype(np.int64))


def described(texts: DataFrame, doc_id: str, text: str, words: int, threshold: Fraction, frequent) -> DataFrame:
    """Every document's size, class, rare fingerprints, sketch and signatures."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, often = Shingler(words), frequent.value
        for batch in batches:
            n, kinds, rare, sketches, signs = [], [], [], [], []
            for value in batch.column(1).to_pylist():
                tokens = shingle(value)
                n.append(len(tokens))
                kinds.append(class_of(tokens) if len(tokens) else None)
                r, s = signatures(tokens, often, threshold)
                rare.append(r)
                signs.append(s)
                sketches.append(sketch_of(tokens))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n, pa.int64()), pa.array(kinds, pa.int64()), pa.array(rare, pa.int32()),
                    pa.array(sketches, pa.binary()), pa.array(signs, pa.list_(pa.int64())),
                ],
                ["id", "n", "c", "rare", "sketch", "signs"],
            )

    kind = texts.schema[doc_id].dataType.simpleString()
    schema = f"id {kind}, n bigint, c bigint, rare int, sketch binary, signs array<bigint>"
    return by_text(texts, schema, rows, F.col(doc_id), F.col(text))


def sized(pairs: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs whose sizes allow the similarity."""
    top, bottom = threshold.numerator, threshold.denominator
    return pairs.where(F.greatest("na", "nb") * top <= F.least("na", "nb") * bottom)


def sketched(pairs: DataFrame, classes: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs ``(a, b)`` whose sketches allow the similarity."""
    one = classes.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = classes.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(one, "a").join(two, "b")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, sa, sb = (batch.column(i).to_pylist() for i in range(6))
            keep = [
                sketch_distance(x, y) <= (p + q) * (1 - threshold) / (1 + threshold)
                for p, q, x, y in zip(na, nb, sa, sb)
            ]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(rows, "a bigint, b bigint")


def class_sets(texts: DataFrame, wanted: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """``(c, tokens)`` of the wanted classes ``(c, id)``, from the texts of their documents.

    A filter of fixed size keeps the scan from making sets of other documents.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)) + 1
    parts = (
        wanted.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("k"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()
    )
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for k, value in parts:
        at = (k - 1) * 4096
        bits[at : at + len(value)] = np.frombuffer(value, np.uint8)
    seen = texts.sparkSession.sparkContext.broadcast(bits)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, have = Shingler(words), seen.value
        for batch in batches:
            p = batch.column(1).to_numpy()
            # Bucket k holds the places (k-1)*32768+1 .. k*32768, here counted from 0.
            hit = (have[p >> 3] >> (p & 7).astype(np.uint8)) & 1
            sets = [shingle(t) for t in batch.column(0).filter(pa.array(hit.astype(bool))).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["c", "tokens"],
            )

    place = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(FILTER_BITS))
    found = by_text(texts, "c bigint, tokens binary", rows, F.col(text), place)
    return found.join(wanted.select("c"), "c", "left_semi").groupBy("c").agg(F.first("tokens").alias("tokens"))


def verified(pairs: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs whose whole sets are similar enough. Rows stream through; a hub with very many
    partners is a skewed join, which adaptive execution splits."""
    top, bottom = threshold.numerator, threshold.denominator

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, x = [], None, None
            for a, s, t in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if a != last:
                    last, x = a, np.frombuffer(s, np.int64)
                y = np.frombuffer(t, np.int64)
                shared = int(np.intersect1d(x, y, assume_unique=True).size)
                keep.append(bottom * shared >= top * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("c").alias("a"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("c").alias("b"), F.col("tokens").alias("tb"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "ta", "tb").mapInArrow(rows, "a bigint, b bigint")


def jaccard_components(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, threshold: float | str = "0.9"
) -> DataFrame:
    """Components of documents whose sets of word shingles have a Jaccard similarity of at
    least ``threshold``: one row ``(doc_id, n_shingles, component_id)`` per input row.

    Words are runs without ASCII white space, A-Z lower-cased. A text with fewer words than
    a shingle is one shingle; one without words (or null) has none and is linked with
    nothing. ``component_id`` is the smallest reachable ``doc_id``. Rows with a null
    ``doc_id`` link with nothing and have a null component. Rows that repeat a ``doc_id``
    each keep their row. An empty table gives no rows; other columns are ignored. The
    threshold is above 0 and at most 1; the lower it is, the more are indexed singly, and
    below a half all are.
    """
    spark, limit = df.sparkSession, Fraction(str(threshold))
    if not 0 < limit <= 1:
        raise ValueError(f"a threshold is above 0 and at most 1, not {threshold}")
    texts = df.select(doc_id, text)
    frequent = spark.sparkContext.broadcast(frequent_tokens(texts, text, words))
    docs = stored(described(texts, doc_id, text, words, limit, frequent), "shingled")
    linkable = docs.where("c is not null and id is not null")
    facts = F.struct("n", "rare", "sketch", "signs")
    classes = stored(
        linkable.groupBy("c").agg(F.min("id").alias("id"), F.first(facts).alias("f")).select("c", "id", "f.*"), "classes"
    )
    entries = classes.select("c", "n", "rare", F.explode("signs").alias("sign"))
    lists = entries.groupBy("sign").agg(F.count("*").alias("m"), F.min(F.struct("rare", "n", "c")).alias("hub"))
    lists = lists.where("m > 1").select("sign", F.col("hub.c").alias("a"), F.col("hub.n").alias("na"))
    posts = stored(entries.join(lists, "sign"), "postings")
    info = classes.select("c", "n", "sketch")

    # First every class with one hub: the one it shares most lists with.
    stars = posts.where("a <> c").select("a", F.col("c").alias("b"), "na", F.col("n").alias("nb"))
    stars = sized(stars, limit).groupBy("a", "b").agg(F.count("*").alias("lists"))
    stars = sketched(stars.select("a", "b", "lists"), info, limit).join(stars, ["a", "b"])
    best = stored(
        stars.groupBy("b").agg(F.max(F.struct("lists", "a")).alias("x")).select(F.col("x.a").alias("a"), "b"), "stars", small=True
    )
    links = linked(best, classes, texts, doc_id, text, words, limit)
    parts = stored(components(links), "components", small=True)

    # Then what lists of several components still leave open.
    labelled = posts.join(parts.withColumnRenamed("id", "c"), "c", "left")
    labelled = labelled.select("sign", "c", "n", "rare", F.coalesce("component", "c").alias("k"))
    mixed = labelled.groupBy("sign").agg(F.min("k").alias("low"), F.max("k").alias("high")).where("low <> high")
    open_posts = stored(labelled.join(mixed.select("sign"), "sign"), "open", small=True)
    left, right = ("a", "na", "ra", "ka"), ("b", "nb", "rb", "kb")
    one = open_posts.select("sign", *[F.col(x).alias(y) for x, y in zip(("c", "n", "rare", "k"), left)])
    two = open_posts.select("sign", *[F.col(x).alias(y) for x, y in zip(("c", "n", "rare", "k"), right)])
    pairs = one.join(two, "sign").where("a < b and ka <> kb")
    # A combination is needed only between sets that share no rare fingerprint.
    apart = F.least(F.col("na") - F.col("ra"), F.col("nb") - F.col("rb")) * (limit.numerator + limit.denominator)
    enough = apart >= (F.col("na") + F.col("nb")) * limit.numerator
    pairs = sized(pairs, limit).where((F.col("sign").bitwiseAND(1) == 1) | enough).select("a", "b").distinct()
    tried = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = stored(sketched(pairs.join(tried, ["a", "b"], "left_anti"), info, limit), "rest", small=True)
    more = linked(rest, classes, texts, doc_id, text, words, limit)
    parts = components(links.unionByName(more))

    members = linkable.select("id", "c").join(parts.withColumnRenamed("id", "c"), "c", "left")
    members = members.select("c", "id", F.coalesce("component", "c").alias("k"))
    least = members.groupBy("k").agg(F.min("id").alias("component_id"))
    named = members.select("c", "k").distinct().join(least, "k").select("c", "component_id")
    linked_rows = linkable.join(named, "c").select("id", "n", "component_id")
    alone = docs.where("c is null or id is null").select("id", "n", F.col("id").alias("component_id"))
    out = linked_rows.unionByName(alone)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def linked(pairs: DataFrame, classes: DataFrame, texts: DataFrame, doc_id: str, text: str, words: int, limit) -> DataFrame:
    """The verified ones of candidate pairs of classes."""
    ends = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct()
    wanted = stored(classes.select("c", "id").join(ends, "c"), "wanted", small=True)
    sets = stored(class_sets(texts, wanted, doc_id, text, words), "sets")
    return stored(verified(pairs, sets, limit), "verified", small=True)
