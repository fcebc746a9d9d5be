"""Token counts of a unigram vocabulary without making the tokens.

An Aho-Corasick automaton over the vocabulary lists every piece that ends at each character
of a word. A dynamic program carries, for each position, the best score and the number of
pieces of its best path; only the last number is read. Sums run forward in double precision
and a path replaces another only if it scores strictly higher, pieces in order of their
start: the tokenizer's own order of comparison, so ties fall alike.

Words are cut at white space as the tokenizer cuts them, so no piece spans two words and
each distinct word is counted once in a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import by_text

# The mark that replaces a blank and begins every word.
MARK = "▁"
# How far below the lowest score an unknown character scores.
UNKNOWN = 10.0
REMEMBERED = 300_000


class UnigramCounter:
    """Counts pieces of words; ``vocabulary`` holds (piece, log probability), one of them
    the unknown piece at ``unknown``."""

    def __init__(self, vocabulary: list[tuple[str, float]], unknown: int):
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN
        self.automaton = ahocorasick.Automaton()
        for number, (piece, score) in enumerate(vocabulary):
            if piece:
                self.automaton.add_word(piece, (len(piece), score, number == unknown))
        self.automaton.make_automaton()

    def count(self, word: str) -> int:
        """Pieces of the best path; neighbouring unknown characters are one piece."""
        n = len(word)
        ending: list[list[tuple[int, float, bool]]] = [[] for _ in range(n)]
        starts = bytearray(n)
        for end, (size, score, unknown) in self.automaton.iter(word):
            ending[end].append((size, score, unknown))
            if size == 1:
                starts[end] = 1
        best, count, unk = [0.0] + [-math.inf] * n, [0] * (n + 1), bytearray(n + 1)
        for end in range(n):
            # Longer pieces start earlier and are compared first.
            pieces = ending[end]
            if not starts[end]:
                pieces = [*pieces, (1, self.unknown, True)]
            for size, score, unknown in sorted(pieces, key=lambda p: -p[0]):
                start = end + 1 - size
                total = best[start] + score
                if total > best[end + 1]:
                    best[end + 1] = total
                    count[end + 1] = count[start] + (not (unknown and unk[start]))
                    unk[end + 1] = unknown
        return count[n]


def words_of(text: str) -> list[str]:
    """A text's words, each with the mark: every blank is a mark, and one begins the text."""
    if not text:
        return []
    marked = text.replace(" ", MARK)
    if not marked.startswith(MARK):
        marked = MARK + marked
    return [MARK + w for w in marked.split(MARK)[1:]]


def zipf_vocabulary(pieces: list[str]) -> list[tuple[str, float]]:
    """Log probabilities by rank: the files at hand carry ranks and no probabilities."""
    return [(piece, -math.log(rank + 2)) for rank, piece in enumerate(pieces)]


def count_tokens(
    df: DataFrame, vocabulary: list[tuple[str, float]], unknown: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, n_tokens)`` of every whole text, one row per input row.

    A null or empty text has 0 tokens. Repeated rows each get their row, an empty table
    gives none, other columns are ignored. The vocabulary is as large as its file.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, known = UnigramCounter(shared.value, unknown), {}
        for batch in batches:
            if len(known) > REMEMBERED:
                known.clear()
            counts = []
            for value in batch.column(1).to_pylist():
                words = words_of(value or "")
                for word in {w for w in words if w not in known}:
                    known[word] = counter.count(word)
                counts.append(sum(map(known.__getitem__, words)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    kind = df.schema[doc_id].dataType.simpleString()
    return by_text(df, f"doc_id {kind}, n_tokens bigint", rows, F.col(doc_id), F.col(text))
