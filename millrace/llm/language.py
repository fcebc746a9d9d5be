"""Language identification by nearest centroids.

A text is a TF-IDF vector of its character 1-, 2- and 3-grams, hashed into a fixed number
of places and normalised. Each language has several centroids, found by clustering the
vectors of its training texts. A text gets the language of the centroid with the largest
cosine; a text too far from it, for its length, is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import by_text, stored

# Places of 1-, 2- and 3-grams.
SIZES = (1024, 4096, 8192)
WIDTH = sum(SIZES)
# Characters counted at a time, so that a text's code points are never all in memory; two
# letters are carried over, so the counts are those of the whole text.
SLICE = 1 << 20
# Training texts in all; they are shared out evenly among the languages, one at least for
# each. This bounds what the driver holds, at about 8 kB a text.
SAMPLE = 4000
CENTROIDS = 4
ROUNDS = 8
# A text is rejected below REJECT of the cosine that all but LOW of the training texts of its
# length class reach, and below LEAST in any case. Centroids that stand for less than LOW of
# a language's texts, by a one-sided binomial test at level RARE, do not count for this.
LOW = 0.05
RARE = 0.05
REJECT = 0.5
LEAST = 0.05
NONE = "und"


def letters_only(text: str, carried: np.ndarray) -> np.ndarray:
    """Lower-case code points that follow ``carried`` ones, with one blank for every run of
    anything but letters. The final sigma is lower-cased like any other, so that a letter
    does not depend on its neighbours."""
    codes = np.frombuffer(text.replace("Σ", "σ").lower().encode("utf-32-le", "replace"), np.uint32)
    distinct = np.unique(codes)
    plain = distinct[[not chr(c).isalpha() for c in distinct.tolist()]]
    codes = np.r_[carried, np.where(np.isin(codes, plain), np.uint32(32), codes)]
    blank = codes == 32
    return codes[~(blank & np.r_[False, blank[:-1]])]


def gram_counts(text: str) -> np.ndarray:
    """How often each place occurs in the whole text, with a blank before and after it."""
    total = np.zeros(WIDTH, np.int64)
    padded, carried = f" {text} ", np.zeros(0, np.uint32)
    for start in range(0, len(padded), SLICE):
        kept = letters_only(padded[start : start + SLICE], carried)
        codes, offset = kept.astype(np.uint64), 0
        for order, size in enumerate(SIZES, 1):
            # Only grams that end after what was carried over are new.
            first = max(len(carried) - order + 1, 0)
            if len(codes) >= first + order:
                mixed = np.zeros(len(codes) - first - order + 1, np.uint64)
                for i in range(order):
                    mixed = (mixed + codes[first + i : len(codes) - order + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
                place = (mixed >> np.uint64(40)) % np.uint64(size)
                total[offset : offset + size] += np.bincount(place.astype(np.int64), minlength=size)
            offset += size
        carried = kept[-(len(SIZES) - 1) :]
    return total


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def length_class(counts: np.ndarray) -> int:
    return int(counts[: SIZES[0]].sum()).bit_length()


@dataclass(frozen=True)
class Model:
    """Languages, inverse document frequencies, centroids with their languages and whether
    they stand for more than a few texts, and the least cosine by language and length class."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    floor: np.ndarray
    common: np.ndarray

    def vector(self, counts: np.ndarray) -> np.ndarray:
        return weighed(counts, self.idf)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine and whether the text is rejected."""
        if not self.languages or not has_letter(text):
            return NONE, 0.0, True
        counts = gram_counts(text)
        found = np.nonzero(counts)[0]
        cosines = self.centroids[:, found] @ weighed(counts, self.idf)[found]
        best = int(np.argmax(cosines))
        score = float(min(max(cosines[best], 0.0), 1.0))
        own = self.owner[best]
        # Being near to a few odd training texts is not enough.
        near = cosines[self.common & (self.owner == own)].max()
        return self.languages[own], score, bool(near < self.floor[own, length_class(counts)])


def weighed(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weight = np.log1p(counts).astype(np.float32) * idf
    norm = float(np.sqrt((weight * weight).sum(dtype=np.float64)))
    return weight / norm if norm else weight


def clustered(vectors: np.ndarray, seed: int) -> np.ndarray:
    """Normalised centroids of up to CENTROIDS clusters, by cosine."""
    count = min(CENTROIDS, len(vectors))
    centroids = vectors[np.random.default_rng(seed).choice(len(vectors), count, replace=False)]
    for _ in range(ROUNDS):
        nearest = np.argmax(vectors @ centroids.T, axis=1)
        for k in range(count):
            members = vectors[nearest == k]
            if len(members):
                mean = members.sum(axis=0)
                centroids[k] = mean / max(float(np.linalg.norm(mean)), 1e-12)
    return centroids


def train(df: DataFrame, usable: Column, doc_id: str, text: str, lang: str, seed: int = 1) -> Model:
    """A model from a bounded sample of the usable rows that have a language.

    At most SAMPLE texts, the same number for every language (one at least, so more than
    SAMPLE languages are as many texts), of the ids with the smallest hashes. An id that is
    repeated in a language gives one text, the smallest; rows without an id or a text train
    nothing. Without any training row every text is ``und``.
    """
    rows = df.where(usable & F.col(lang).isNotNull() & (F.col(lang) != NONE) & F.col(doc_id).isNotNull())
    ids = rows.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.xxhash64(doc_id).alias("h"))
    ids = stored(ids.distinct(), "ids")
    held = ids.groupBy("lang").count()
    languages = held.count()
    if not languages:
        return Model([], np.ones(WIDTH, np.float32), np.zeros((0, WIDTH), np.float32), np.zeros(0, int), np.zeros((0, 64)),
                     np.zeros(0, bool))
    share = max(1, min(1000, SAMPLE // languages))
    # Of a hash's whole range, the part that holds about twice the share and surely the share
    # itself; what is ranked then does not grow with the table.
    part = held.select("lang", (F.lit(2.0 * share + 200) / F.col("count")).alias("part"))
    low = F.col("h").cast("double") < F.col("part") * 2.0**64 - 2.0**63
    order = Window.partitionBy("lang").orderBy("h", "id")
    # A row for each language, of which the model holds centroids anyway. Cut before the shuffle.
    ids = ids.join(F.broadcast(part), "lang").where((F.col("part") >= 1) | low)
    ids = ids.withColumn("place", F.row_number().over(order)).where(F.col("place") <= share)
    # At most ``share`` rows of each language: bounded by construction.
    texts = rows.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    chosen = texts.join(F.broadcast(ids.select("id", "lang", "h")), ["id", "lang"])
    chosen = chosen.groupBy("id", "lang", "h").agg(F.min("text").alias("text")).select("lang", "h", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, hashes, places, values = [], [], [], []
            for language, h, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if has_letter(value):
                    counts = gram_counts(value)
                    at = np.nonzero(counts)[0]
                    langs.append(language)
                    hashes.append(h)
                    places.append(at.astype(np.uint16).tobytes())
                    values.append(counts[at].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(hashes, pa.int64()), pa.array(places, pa.binary()),
                 pa.array(values, pa.binary())],
                ["lang", "h", "places", "counts"],
            )

    sample = by_text(
        chosen, "lang string, h bigint, places binary, counts binary", features, F.col("lang"), F.col("h"), F.col("text")
    ).collect()
    sample.sort(key=lambda r: (r.lang, r.h, bytes(r.places), bytes(r["counts"])))
    return fitted([(r.lang, np.frombuffer(r.places, np.uint16), np.frombuffer(r["counts"], np.uint32)) for r in sample], seed)


def low_cosines(classes: np.ndarray, cosines: np.ndarray) -> np.ndarray:
    """The LOW quantile of each length class's own cosines, as a function that does not fall
    with the length: classes that would fall are averaged by their texts. A class without
    texts is like the next shorter one; shorter than any known: no limit."""
    known, sizes = np.unique(classes, return_counts=True)
    levels: list[tuple[float, int, int]] = []
    for k, n in zip(known.tolist(), sizes.tolist()):
        level, first = float(np.quantile(cosines[classes == k], LOW)), k
        while levels and levels[-1][0] > level:
            before, count, first = levels.pop()
            level, n = (before * count + level * n) / (count + n), count + n
        levels.append((level, n, first))
    floor = np.zeros(64)
    for level, _, first in levels:
        floor[first:] = level
    return floor


def at_most(count: int, total: int, share: float) -> float:
    """Probability that ``total`` draws of probability ``share`` hit ``count`` times or fewer."""
    hits = np.arange(1, count + 1)
    logs = np.r_[0.0, np.cumsum(np.log((total - hits + 1) / hits * share / (1 - share)))] + total * np.log(1 - share)
    return float(np.exp(logs).sum())


def fitted(sample: list[tuple[str, np.ndarray, np.ndarray]], seed: int) -> Model:
    languages = sorted({language for language, _, _ in sample})
    seen = np.zeros(WIDTH)
    for _, at, _ in sample:
        seen[at] += 1
    idf = (np.log((1 + len(sample)) / (1 + seen)) + 1).astype(np.float32)
    centroids, owner, common, floor = [], [], [], np.zeros((len(languages), 64))
    for number, language in enumerate(languages):
        vectors, classes = [], []
        for name, at, values in sample:
            if name == language:
                counts = np.zeros(WIDTH, np.int64)
                counts[at] = values
                vectors.append(weighed(counts, idf))
                classes.append(length_class(counts))
        own = clustered(np.array(vectors), seed)
        centroids.append(own)
        owner += [number] * len(own)
        cosines = np.array(vectors) @ own.T
        sizes = np.bincount(cosines.argmax(axis=1), minlength=len(own))
        many = np.array([at_most(int(n), len(vectors), LOW) > RARE for n in sizes])
        common += many.tolist()
        best = cosines[:, many].max(axis=1)
        floor[number] = low_cosines(np.array(classes), best)
    return Model(languages, idf, np.concatenate(centroids) if centroids else np.zeros((0, WIDTH), np.float32),
                 np.array(owner, int), np.maximum(floor * REJECT, LEAST), np.array(common, bool))


def predict_languages(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The table with ``lang_pred``, ``score`` and ``rejected`` of every whole text.

    A null text or one without a letter is ``und`` with score 0 and rejected. Columns of
    those names are replaced; every other column is kept as it is.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in df.columns if c not in ("lang_pred", "score", "rejected")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.predict(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            columns = batch.columns[:-1] + [
                pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                pa.array([f[2] for f in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score", "rejected"])

    schema = df.select(*[F.col(f"`{c}`") for c in keep]).schema
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("rejected", "boolean")):
        schema = schema.add(name, kind)
    return by_text(df, schema, rows, *[F.col(f"`{c}`") for c in keep], F.col(text).alias("_text"))


def held_out(doc_id: str, folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from training; rows without an id are too, as they have no fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(True))


def identify(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Train on the rows outside the held-out fold and predict every row."""
    model = train(df, ~held_out(doc_id), doc_id, text, lang)
    return predict_languages(df, model, text)
