"""Secret scans: fixed rules, and character Markov models for what the rules miss.

Two bigram models over the characters of credentials are trained from the table itself:
one on the values that the rules found, one on all other text. A stretch of such characters
is a secret if its log-likelihood ratio per character is high enough. Training counts
bigrams of every document, so only two small tables of counts reach the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import ASCII_LOWER, by_text

KINDS = ("assign", "access", "hex", "markov")
# The base rules and the least lengths of their matches.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_VALUE = 12
# Runs the models judge, the least length of a secret, and what separates parts of a run.
RUNS = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
SHORTEST = 20
SEPARATORS = "/_=-"
# A secret has digits and letters or is one word; a number, date or the like is none.
MIXED = re.compile(r"(?=.*[0-9]).*[A-Za-z]").match
LETTERS = re.compile(rf"(?<![A-Za-z0-9+])[A-Za-z]{{{SHORTEST},}}(?![A-Za-z0-9+])")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Place 0 stands for every other character.
PLACES = np.zeros(256, np.int64)
PLACES[list(ALPHABET.encode())] = np.arange(1, len(ALPHABET) + 1)
SIZE = len(ALPHABET) + 1

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """``(start, kind, end)`` of the rules, in order; leftmost, not overlapping per kind."""
    found = []
    low = text.encode().translate(ASCII_LOWER)
    if any(hint in low for hint in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def merged(spans: list[Span]) -> list[tuple[int, int]]:
    """What the spans cover, as stretches that do not touch, in order."""
    found: list[tuple[int, int]] = []
    for start, _, end in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1] = found[-1][0], max(end, found[-1][1])
        else:
            found.append((start, end))
    return found


def value_of(text: str, span: Span) -> str:
    start, kind, end = span
    return ASSIGN.match(text, start, end)[2] if kind == 0 else text[start:end]


def bigrams(text: str) -> np.ndarray:
    """Counts of neighbouring places; a character outside Latin-1 counts as any other."""
    at = PLACES[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]
    return np.bincount(at[:-1] * SIZE + at[1:], minlength=SIZE * SIZE)


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio of each bigram, and the least mean ratio of a secret."""

    ratio: np.ndarray
    least: float = 3.0

    def spans(self, text: str, base: list[Span]) -> list[Span]:
        """Further stretches that look random and lie outside the base spans. Runs and base
        spans are walked together, once."""
        found, covered, first = [], merged(base), 0
        for m in RUNS.finditer(text):
            at = m.start()
            while first < len(covered) and covered[first][1] <= at:
                first += 1
            for place in range(first, len(covered)):
                start, end = covered[place]
                if start >= m.end():
                    break
                found += [(at + a, 3, at + b) for a, b in self.stretches(text[at:start])]
                at, first = end, place
            found += [(at + a, 3, at + b) for a, b in self.stretches(text[at : m.end()])]
        return found

    def stretches(self, part: str) -> list[tuple[int, int]]:
        """Where a part of a run is random: all of it, or else its best stretches of at
        least ``SHORTEST`` characters, each widened to the separators around it."""
        if len(part) < SHORTEST:
            return []
        at = PLACES[np.frombuffer(part.encode(), np.uint8)]
        sums = np.r_[0.0, np.cumsum(self.ratio[at[:-1] * SIZE + at[1:]] - self.least)]
        if sums[-1] >= 0 and (part.isalpha() or MIXED(part)):
            return [(0, len(part))]
        found, rest = [], [(0, len(part))]
        while rest:
            low, high = rest.pop()
            if high - low < SHORTEST:
                continue
            # ``sums[b - 1] - sums[a]`` is the score of characters a to b.
            own = sums[low:high]
            least = np.minimum.accumulate(own[: len(own) - SHORTEST + 1])
            gain = own[SHORTEST - 1 :] - least
            last = int(np.argmax(gain))
            if gain[last] < 0:
                continue
            start, end = low + int(np.argmin(own[: last + 1])), low + last + SHORTEST
            while start > low and part[start - 1] not in SEPARATORS:
                start -= 1
            while end < high and part[end] not in SEPARATORS:
                end += 1
            if MIXED(part[start:end]):
                found.append((start, end))
            else:
                # Joined words may be new to the model; letters alone count if nothing joins them.
                for piece in LETTERS.finditer(part, start, end):
                    a, b = piece.span()
                    if sums[b - 1] >= sums[a]:
                        found.append((a, b))
            rest += [(low, start), (end, high)]
        return sorted(found)


def train(df: DataFrame, text: str = "text") -> Model:
    """Both models from all texts. The random one is half uniform, so that secrets of other
    alphabets than the labelled ones are likely too; without labelled values it is all uniform.
    Null texts count nothing, repeated rows each count, and an empty table gives two uniform
    models, by which nothing is a secret."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random, ordinary = np.zeros(SIZE * SIZE, np.int64), np.zeros(SIZE * SIZE, np.int64)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                text = value or ""
                inside = np.zeros(SIZE * SIZE, np.int64)
                for span in base_spans(text):
                    inside += bigrams(value_of(text, span))
                random += inside
                ordinary += bigrams(text) - inside
        keys = np.arange(SIZE * SIZE)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, random, ordinary)], ["k", "r", "o"])

    counted = by_text(df, "k bigint, r bigint, o bigint", rows, F.col(text))
    found = counted.groupBy("k").agg(F.sum("r").alias("r"), F.sum("o").alias("o")).collect()
    tables = np.zeros((2, SIZE * SIZE))
    for k, r, o in found:
        # A value found twice, by two rules, is taken off the ordinary text twice.
        tables[:, k] = max(r, 0), max(o, 0)
    shares = []
    for table, uniform in zip(tables.reshape(2, SIZE, SIZE), (0.5, 0.001)):
        total = table.sum(axis=1, keepdims=True)
        seen = np.divide(table, total, out=np.full_like(table, 1 / SIZE), where=total > 0)
        shares.append((1 - uniform) * seen + uniform / SIZE)
    return Model(np.log(shares[0] / shares[1]).ravel())


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan_texts(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of secrets in every whole text, one row per input row.

    Returns ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``. Positions are code
    points, ends exclusive. A null text is empty and has no spans. Repeated rows each get
    their row, an empty table gives none, other columns are ignored. Beyond the rules, a
    secret of fewer than SHORTEST characters is not found, nor one whose mean log-likelihood
    ratio per character is below the model's ``least``.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for value in batch.column(1).to_pylist():
                text = value or ""
                base = base_spans(text)
                kinds = [k for _, k, _ in base]
                for kind in range(3):
                    out[kind].append(kinds.count(kind))
                out[3].append(sha256(written(base).encode()).hexdigest())
                out[4].append(written(base + model.spans(text, base)))
            counts = [pa.array(x, pa.int64()) for x in out[:3]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(out[3], pa.string()), pa.array(out[4], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    kind = df.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return by_text(df, schema, rows, F.col(doc_id), F.col(text))


def redacted(text: str, spans: list[Span], mark: str) -> str:
    parts, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact_texts(df: DataFrame, model: Model, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The table with every secret in its texts replaced. Null texts stay null, repeated
    rows are each replaced, an empty table stays empty."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = []
            for value in batch.column(at).to_pylist():
                base = base_spans(value or "")
                spans = base + model.spans(value or "", base)
                texts.append(redacted(value, spans, mark) if spans else value)
            yield batch.set_column(at, text, pa.array(texts, pa.string()))

    return by_text(df, df.schema, rows, *[F.col(f"`{c}`") for c in df.columns])
