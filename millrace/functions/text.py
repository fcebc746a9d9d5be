"""String pieces: byte slices, separated parts, subject segments, shard names."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from ..errors import InvalidPipelineError


def part_at(text: Column, separator: str, index: int) -> Column:
    """The part at ``index`` between literal separators; NULL when out of range.

    Negative indexes count from the end.
    """
    parts = F.split(text, re.escape(separator) if len(separator) == 1 else rf"\Q{separator}\E", -1)
    return F.try_element_at(parts, F.lit(index + 1 if index >= 0 else index))


def part_count(text: Column, separator: str) -> Column:
    return F.size(F.split(text, rf"\Q{separator}\E", -1))


def trim_set(text: Column, characters: str) -> Column:
    """Strip any of ``characters`` from both ends."""
    return F.btrim(text, F.lit(characters))


def byte_slice(text: Column, start: int, end: int | None = None) -> Column:
    """Slice by bytes with Python rules: negatives from the end, clamped, never an error."""
    raw = text.cast("binary")
    size = F.octet_length(raw)

    def clamp(index: int) -> Column:
        position = size + index if index < 0 else F.lit(index)
        return F.least(F.greatest(position, F.lit(0)), size)

    low = clamp(start)
    high = size if end is None else clamp(end)
    width = F.greatest(high - low, F.lit(0))
    return F.substr(raw, low + 1, width).cast("string")


def digest(text: Column, algorithm: str) -> Column:
    """Lowercase hex digest of a string."""
    if algorithm == "sha1":
        return F.sha1(text)
    if algorithm == "sha256":
        return F.sha2(text, 256)
    raise InvalidPipelineError(f"hash algorithm {algorithm!r} is not supported")


def shard_name(identifier: Column, prefix: str, hex_chars: int = 4) -> Column:
    """Table name of the shard an identifier belongs to; NULL without identifier."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(identifier), 1, hex_chars))


def valid_table_name(name: Column) -> Column:
    """True for a non-empty name that starts with an ASCII letter or digit."""
    return F.coalesce(name.rlike("^[A-Za-z0-9]"), F.lit(False))
