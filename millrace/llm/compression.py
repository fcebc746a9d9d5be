"""Quality rules with compression bands.

Natural text compresses within a band. Repetitive text compresses better, random text,
encoded data and text of single odd symbols worse. The ratio ``bytes / zstandard bytes``
is taken over the whole text and over fixed chunks that cover all of it, which catch a
stretch that the whole text hides. Limits depend on the length, as a compressor finds more
to reuse in a longer text.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .shared import SPACE, by_text

SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Bands:
    """Lowest and highest accepted ratios.

    ``sizes`` are upper limits of a text's bytes, ``whole`` the (low, high) for each size
    class, one more than there are sizes. ``part`` is the band of single chunks, which all
    have the same size, ``short_part`` that of the smaller chunks of texts that have no full
    one. Texts shorter than ``least`` bytes are one chunk, within ``brief`` from ``few`` bytes
    on; of fewer only the upper limit counts, as a few words compress as badly as noise.
    """

    least: int = 160
    sizes: tuple[int, ...] = (512, 2048, 8192, 32768)
    whole: tuple[tuple[float, float], ...] = ((1.0, 3.2), (1.2, 3.6), (1.35, 4.2), (1.4, 5.0), (1.4, 6.0))
    chunk: int = 4096
    part: tuple[float, float] = (1.35, 6.0)
    short_chunk: int = 512
    short_part: tuple[float, float] = (1.3, 4.0)
    few: int = 120
    brief: tuple[float, float] = (0.96, 3.0)
    fewest_high: float = 2.0
    # Share and number of a text's chunks that may lie outside their band.
    stray: float = 0.25
    most: int = 2
    level: int = 3

    def keeps(self, size: int, ratio: float, outside: int, chunks: int) -> bool:
        fits = outside <= min(self.stray * chunks, self.most)
        if size < self.least:
            return fits
        low, high = self.whole[bisect_right(self.sizes, size)]
        return low <= ratio <= high and fits

    def outside(self, data: bytes, press: Callable[[bytes], bytes]) -> tuple[int, int]:
        """How many chunks lie outside their band, and how many there are. The last chunk
        ends with the text and overlaps the one before it."""
        chunk, (low, high) = len(data), self.brief if len(data) >= self.few else (0.0, self.fewest_high)
        if len(data) >= self.chunk:
            chunk, (low, high) = self.chunk, self.part
        elif len(data) >= self.short_chunk:
            chunk, (low, high) = self.short_chunk, self.short_part
        elif len(data) >= self.least or not data:
            return 0, 0
        ends = [*range(chunk, len(data), chunk), len(data)]
        return sum(not low <= chunk / len(press(data[end - chunk : end])) <= high for end in ends), len(ends)


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of eight that occur at least twice in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    # Exact: each step joins two ids of half the span and numbers the joined pairs anew.
    span = 1
    while span < WINDOW:
        joined = codes[:-span] * np.uint64(len(words) + 1) + codes[span:]
        codes = np.unique(joined, return_inverse=True)[1].astype(np.uint64)
        span *= 2
    again = np.bincount(codes.astype(np.int64))[codes.astype(np.int64)] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += again
    edges[WINDOW:] -= again
    return int((np.cumsum(edges)[:-1] > 0).sum())


def measures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode().split()
    lines = [line for line in text.split("\n") if SPACE.sub("", line)] if "\n" in text else []
    return (
        len(words),
        len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def judge_texts(df: DataFrame, bands: Bands = Bands(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Base measures, compression ratios and the verdict of every whole text.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, ratio, chunks, chunks_outside``, one row per input row. A null text
    is an empty one: no words, so it fails the base rules and is not kept; its ratio is
    null. ``chunks`` are full ones; ``chunks_outside`` also counts the last, overlapping one and
    the smaller ones of a short text. Other columns are ignored and repeated rows each get
    their row.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=bands.level).compress
        for batch in batches:
            out: list[list] = [[] for _ in range(10)]
            for value in batch.column(1).to_pylist():
                text = value or ""
                base = measures(text)
                failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
                data = text.encode()
                ratio = len(data) / len(press(data)) if data else None
                outside, chunks = bands.outside(data, press)
                kept = not failed and bands.keeps(len(data), ratio, outside, chunks)
                for column, x in zip(out, (*base, failed, kept, ratio, len(data) // bands.chunk, outside)):
                    column.append(x)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, k) for x, k in zip(out, kinds))], [f"c{i}" for i in range(11)]
            )

    kind = df.schema[doc_id].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean, ratio double, chunks bigint, chunks_outside bigint"
    )
    return by_text(df, schema, rows, F.col(doc_id), F.col(text))
