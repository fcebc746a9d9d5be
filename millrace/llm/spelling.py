"""Spelling variants: words one letter apart, found in bidirectional FM-indexes.

Two words that differ by one inserted, deleted or replaced letter share the first or the
last half of the shorter one. So every word is looked up twice: its first half matched
exactly and extended to the right, and its last half matched exactly and extended to the
left, both with one error on the way. An index holds many words with a delimiter between
them; a match is an interval of suffix ranks, and the same interval is kept for the
reversed text, so it can be extended on either side.

Spark deals words by their halves: a word goes to the index of each half that it may share,
and is looked up there, so no word meets all others. Indexes take a bounded number of
words; where more share halves, they are dealt in blocks and their lookups visit each block.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import by_text, stored

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# One of so many occurrences loses a letter.
SLIPS = 199
# Distinct words and slips that a task counts before it passes the counts on.
COUNTED = 200_000
# Letters of an index on average, and at most (a longer word has one alone); lookups in one
# task have as many.
PER_INDEX, MOST = 80_000, 160_000
# Letters of lookups that advance together.
TOGETHER = 32_768
# Counts are kept for every sixteenth place, the symbols in between are counted again.
STRIDE = 16

END, DELIMITER, FIRST_LETTER = 0, 1, 2


def slipped(doc_id: str, word: str) -> str:
    """The word as this document has it: one letter is lost where the hash says so."""
    mark = zlib.crc32(f"{doc_id}:{word}".encode())
    if mark % SLIPS:
        return word
    place = mark % len(word)
    return word[:place] + word[place + 1 :]


def word_counts(df: DataFrame, doc_id: str, text: str, shortest: int, rarest: int) -> DataFrame:
    """``(word, n)`` of the words with enough letters and occurrences in all texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def batch_of():
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )
            counts.clear()
            return made

        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not value:
                    continue
                doc = doc or ""
                for word, n in Counter(RUNS.findall(value.translate(CAPITALS))).items():
                    word = slipped(doc, word)
                    if len(word) >= shortest:
                        counts[word] += n
                if len(counts) > COUNTED:
                    yield batch_of()
        yield batch_of()

    found = by_text(df, "word string, n bigint", rows, F.col(doc_id).cast("string"), F.col(text).cast("string"))
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= rarest)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Ranks by doubled prefixes; the last symbol is smaller than all others."""
    size, step = len(symbols), 1
    rank = symbols.astype(np.int64)
    while True:
        follow = np.zeros(size, np.int64)
        follow[: size - step] = rank[step:] + 1
        key = rank * (size + int(rank.max()) + 2) + follow
        order = np.argsort(key, kind="stable")
        sorted_keys = key[order]
        rank = np.empty(size, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_keys[1:] != sorted_keys[:-1])])
        if rank[order[-1]] == size - 1 or step >= size:
            return order
        step *= 2


class Ranks:
    """Burrows-Wheeler transform of a text with counts of smaller symbols before a place."""

    def __init__(self, symbols: np.ndarray, letters: int):
        self.suffixes = suffix_array(symbols)
        self.last = np.full(-(-(len(symbols) + 1) // STRIDE) * STRIDE, letters, np.uint8)
        self.last[: len(symbols)] = symbols[self.suffixes - 1]
        counts = np.zeros((len(self.last) // STRIDE + 1, letters + 2), np.int32)
        np.add.at(counts, (np.arange(len(self.last)) // STRIDE + 1, self.last.astype(np.int64) + 1), 1)
        self.kept = np.cumsum(np.cumsum(counts, axis=0), axis=1, dtype=np.int32)[:, : letters + 1]
        # Suffixes that begin with a smaller symbol.
        self.starts = np.cumsum(np.bincount(symbols + 1, minlength=letters + 1))

    def window(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols from the last kept place on, and which of them are before the place."""
        start, rest = place // STRIDE * STRIDE, place % STRIDE
        steps = np.arange(STRIDE)
        return self.last[start[:, None] + steps], steps < rest[:, None]

    def below(self, place: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """How many of the first ``place`` symbols of the transform are below ``symbol``."""
        window, before = self.window(place)
        return self.kept[place // STRIDE, symbol] + ((window < symbol[:, None]) & before).sum(axis=1)

    def counts(self, place: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first ``place`` ones."""
        window, before = self.window(place)
        found = np.diff(self.kept[place // STRIDE], axis=1)
        row, column = np.nonzero(before)
        np.add.at(found, (row, window[row, column]), 1)
        return found


class BidirectionalIndex:
    """FM-indexes of a delimited vocabulary and of its reversal, extended in step.

    A match is ``(low, back, size)``: where its suffixes begin in the index and in that of
    the reversed text, and how many there are. Methods work on arrays of matches.
    """

    def __init__(self, words: list[str]):
        self.words = words
        letters = sorted(set("".join(words)))
        self.code = {c: i + FIRST_LETTER for i, c in enumerate(letters)}
        self.letters = len(letters) + FIRST_LETTER
        lengths = np.array([len(w) for w in words])
        text = [DELIMITER]
        for word in words:
            text += [self.code[c] for c in word]
            text.append(DELIMITER)
        symbols = np.array(text, np.int64)
        self.size = len(symbols) + 1
        self.forward = Ranks(np.append(symbols, END), self.letters)
        self.backward = Ranks(np.append(symbols[::-1], END), self.letters)
        self.first = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])

    def everything(self, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.zeros(count, np.int64), np.zeros(count, np.int64), np.full(count, self.size, np.int64)

    def extend(self, match, symbol: np.ndarray, right: bool):
        """Every match with a symbol more on one side; a size of 0 is no match."""
        low, back, size = match
        if right:
            low, back = back, low
        index = self.backward if right else self.forward
        a, b = index.below(low, symbol), index.below(low + size, symbol)
        c, d = index.below(low, symbol + 1), index.below(low + size, symbol + 1)
        # Suffixes with a smaller symbol on this side come first in the other index.
        longer, other, count = index.starts[symbol] + (c - a), back + (b - a), (d - b) - (c - a)
        return (other, longer, count) if right else (longer, other, count)

    def children(self, match, right: bool) -> tuple[np.ndarray, np.ndarray]:
        """``(which match, letter)`` of all one-letter extensions that occur."""
        low, back, size = match
        start = back if right else low
        index = self.backward if right else self.forward
        which, letter = np.nonzero((index.counts(start + size) - index.counts(start))[:, FIRST_LETTER:])
        return which, letter + FIRST_LETTER

    def located(self, low: np.ndarray) -> np.ndarray:
        """The word that starts after the delimiter of each match."""
        return np.searchsorted(self.first, self.forward.suffixes[low])

    def near(self, queries: list[str], halves: list[int], right: bool) -> tuple[np.ndarray, np.ndarray]:
        """``(query, word)`` of the words that keep the first ``half`` letters of a query, if
        ``right``, else the last ones, and have exactly one error in the others."""
        count, longest = len(queries), max(map(len, queries))
        # Letters in the order in which they are matched: the half from the middle outwards,
        # the delimiter at its end, then the other half and the other delimiter.
        codes = np.full((count, longest + 3), -1, np.int64)
        for row, (query, half) in enumerate(zip(queries, halves)):
            known = [self.code.get(c, -1) for c in query]
            inner, outer = (known[:half][::-1], known[half:]) if right else (known[-half:], known[:-half][::-1])
            codes[row, : len(query) + 2] = [*inner, DELIMITER, *outer, DELIMITER]
        half, length = np.array(halves), np.array([len(q) for q in queries])
        match, alive = self.everything(count), np.arange(count)
        for step in range(int(half.max()) + 1):
            now = step <= half[alive]
            symbol = codes[alive, step]
            now &= symbol >= 0
            ready = step > half[alive]
            longer = self.extend(tuple(x[now] for x in match), symbol[now], not right)
            for part, new in zip(match, longer):
                part[now] = new
            keep = ready | (now & (match[2] > 0))
            match, alive = tuple(x[keep] for x in match), alive[keep]
        # Matches with and without the error, by how many letters of the query are used.
        found: list[tuple[np.ndarray, np.ndarray]] = []
        clean = (match, alive, half[alive] + 1)
        wrong = (tuple(np.empty(0, np.int64) for _ in range(3)), np.empty(0, np.int64), np.empty(0, np.int64))
        while len(clean[1]) or len(wrong[1]):
            fresh = self.with_error(clean, codes, length, right)
            clean = self.matched(clean, codes, right, length, None)
            wrong = tuple_of([wrong, fresh])
            wrong = self.matched(wrong, codes, right, length, found)
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([q for q, _ in found]), np.concatenate([w for _, w in found])

    def matched(self, state, codes: np.ndarray, right: bool, length: np.ndarray, found: list | None):
        """Extend by the query's next letter. Those that reach the last delimiter are
        finished: with an error they are answers, without they are the query itself."""
        match, query, used = state
        symbol = codes[query, used]
        go = symbol >= 0
        match, query, used, symbol = tuple(x[go] for x in match), query[go], used[go], symbol[go]
        match = self.extend(match, symbol, right)
        go = match[2] > 0
        match, query, used = tuple(x[go] for x in match), query[go], used[go] + 1
        over = used == length[query] + 2
        if found is not None and over.any():
            found.append((query[over], self.located(match[0][over])))
        return tuple(x[~over] for x in match), query[~over], used[~over]

    def with_error(self, state, codes: np.ndarray, length: np.ndarray, right: bool):
        """All ways to make the error here: another letter, a letter less, a letter more."""
        match, query, used = state
        which, letter = self.children(match, right)
        more = self.extend(tuple(x[which] for x in match), letter, right)
        inside = used <= length[query]
        other = inside[which] & (letter != codes[query[which], used[which]])
        return tuple_of(
            [
                (tuple(x[other] for x in more), query[which][other], used[which][other] + 1),
                (tuple(x[inside] for x in match), query[inside], used[inside] + 1),
                (more, query[which], used[which]),
            ]
        )


def tuple_of(states: list):
    """Several sets of matches as one."""
    return (
        tuple(np.concatenate([s[0][i] for s in states]) for i in range(3)),
        np.concatenate([s[1] for s in states]), np.concatenate([s[2] for s in states]),
    )


def looked_up(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """The near words of a block of lookups in a block of words."""
    parts = []
    if len(index) and len(queries):
        words = index.drop_duplicates("word")
        names, counts = words["word"].tolist(), words["n"].to_numpy()
        tree = BidirectionalIndex(names)
        for right, some in queries.groupby("right"):
            lengths = some["asked"].str.len()
            some = some.iloc[np.argsort(lengths, kind="stable")]
            for _, part in some.groupby(np.cumsum(np.sort(lengths)) // TOGETHER):
                asked, found = tree.near(part["asked"].tolist(), part["half"].tolist(), bool(right))
                if len(asked):
                    near = pd.DataFrame({"word": part["asked"].to_numpy()[asked], "near": np.array(names, object)[found], "n": counts[found]})
                    parts.append(near.drop_duplicates())
    return pd.concat(parts) if parts else pd.DataFrame({"word": [], "near": [], "n": []}).astype({"word": object, "near": object, "n": "int64"})


def near_words(words: DataFrame) -> DataFrame:
    """``(word, near, n)`` of all pairs of words one letter apart, ``n`` of the near one.

    The halves of a pair are those of its shorter word, which has as many letters as the
    word or one less. So a word has one or two lengths of halves, at each end.
    """
    size = F.length("word")
    halves = F.array_distinct(F.array(F.floor(F.greatest(size - 1, F.lit(1)) / 2), F.floor(size / 2)).cast("array<int>"))
    each = words.select("word", "n", F.explode(halves).alias("half")).where("half > 0")
    first = each.select("*", F.lit(True).alias("right"), F.expr("left(word, half)").alias("part"))
    last = each.select("*", F.lit(False).alias("right"), F.expr("right(word, half)").alias("part"))
    entries = stored(first.unionByName(last), "halves")
    total = entries.agg(F.sum(F.length("word"))).first()[0] or 0
    shards = max(1, -(-total // PER_INDEX))
    dealt = entries.withColumn("shard", F.pmod(F.xxhash64("right", "part"), F.lit(shards)))
    sizes = dealt.groupBy("shard").agg(F.ceil(F.sum(F.length("word")) / MOST).alias("blocks"))
    dealt = stored(dealt.join(sizes, "shard").withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks"))), "dealt")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    index = dealt.select("shard", F.col("block").alias("pb"), every.alias("qb"), "word", "n")
    asked = dealt.select(
        F.col("shard").alias("s"), every.alias("p"), F.col("block").alias("q"), F.col("word").alias("asked"), "half", "right"
    )
    found = index.groupBy("shard", "pb", "qb").cogroup(asked.groupBy("s", "p", "q"))
    return found.applyInPandas(looked_up, "word string, near string, n bigint").distinct()


def spelling_groups(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = 6, rarest: int = 5, times: int = 5
) -> DataFrame:
    """The words of all texts with their most likely spelling: ``word, form, root, n, n_near, form_n``.

    Words are the runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased, some
    with a letter lost (see ``slipped``), that have ``shortest`` letters and occur
    ``rarest`` times over all texts. ``form`` is the most frequent word one letter away,
    ties to the first in code-point order, if it occurs ``times`` times as often, else
    NULL; ``root`` follows the forms to the last. A null or empty text has no words; a null
    id counts as an empty one where letters are lost. Repeated rows count each time. An
    empty table has no words; other columns are ignored. Texts of any length are read whole;
    a word of very many letters takes an index and a time of its own, about a millisecond
    for each letter.
    """
    words = stored(word_counts(df, doc_id, text, shortest, rarest), "words", small=True)
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), "near")).alias("best")
    )
    joined = words.join(best, "word", "left")
    often = -F.col("best.n") >= times * F.col("n")
    facts = stored(
        joined.select(
            "word", F.when(often, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(often, -F.col("best.n")).alias("form_n"),
        ),
        "forms", small=True,
    )
    return facts.join(roots(facts), "word").select("word", "form", "root", "n", "n_near", "form_n")


def roots(facts: DataFrame) -> DataFrame:
    """``(word, root)``: each form is followed to its own, twice as far in every round.

    Counts rise by a factor with every form, so there is no circle and few rounds.
    """
    now = facts.select("word", F.coalesce("form", "word").alias("root"))
    while True:
        moving = now.where("word <> root").select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stored(now.join(moving, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots", small=True)
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")
