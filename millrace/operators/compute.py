"""Derived text fields: concat, split, hash, slice and text form.

Inputs must already hold text; nothing is coerced except by ``str``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from ..errors import InvalidPipelineError
from ..functions import numbers, text
from .fields import (
    Field, Scope, Slot, Step, field_path, first_of, option, plain_target, whole_option,
)

NAME = "compute_field"


def concat_parts(entries: object) -> list[tuple[str | None, list[str] | None]]:
    """Classify concat entries: quoted ones are literals, the others are field paths."""
    if not isinstance(entries, (list, tuple)) or not entries:
        raise InvalidPipelineError("concat needs a non-empty 'fields' list")
    parts = []
    for entry in entries:
        if not isinstance(entry, str):
            raise InvalidPipelineError(f"concat entry {entry!r} is not a string")
        if len(entry) >= 2 and entry[0] == entry[-1] == '"':
            parts.append((entry[1:-1], None))
        else:
            parts.append((None, field_path(entry)))
    return parts


def _concat(options: dict, target: str) -> Step:
    parts = concat_parts(options.get("fields"))

    def apply(scope: Scope) -> None:
        columns, checks = [], []
        for literal, path in parts:
            if path is None:
                columns.append(F.lit(literal))
                continue
            field = scope.lookup(path)
            value = scope.read(field, "text")
            columns.append(value)
            name = ".".join(path)
            checks.append(
                F.when(
                    value.isNull(),
                    F.when(field.exists(), f"field {name!r} is not text").otherwise(
                        f"field {name!r} not found"
                    ),
                )
            )

        def error(stored: Field) -> Column:
            return F.when(stored.text().isNull(), first_of(checks, "string"))

        scope.store(target, NAME, Field({"text": Slot(F.concat(*columns))}), error)

    reads = tuple(tuple(path) for _, path in parts if path is not None)
    return Step(NAME, apply, reads=reads, target=target)


def _from_text(options: dict, target: str, compute: Callable[[Column], Column], reason: str) -> Step:
    """A step computing a text from one text field."""
    source = option(options, "source", NAME)
    path = field_path(source)

    def apply(scope: Scope) -> None:
        field = scope.lookup(path)
        value = scope.read(field, "text")

        def error(stored: Field) -> Column:
            return (
                F.when(~field.exists(), f"field {source!r} not found")
                .when(value.isNull(), f"field {source!r} is not text")
                .when(stored.text().isNull(), reason)
            )

        scope.store(target, NAME, Field({"text": Slot(compute(value))}), error)

    return Step(NAME, apply, reads=(tuple(path),), target=target)


def _split(options: dict, target: str) -> Step:
    separator = option(options, "separator", "split")
    index = whole_option(options, "index", "split")
    return _from_text(
        options, target, lambda c: text.part_at(c, separator, index), f"split has no part {index}"
    )


def _hash(options: dict, target: str) -> Step:
    algorithm = option(options, "algorithm", "hash")
    text.digest(F.lit(""), algorithm)
    return _from_text(options, target, lambda c: text.digest(c, algorithm), "hash failed")


def _slice(options: dict, target: str) -> Step:
    start = whole_option(options, "start", "slice")
    end = whole_option(options, "end", "slice", required=False)
    return _from_text(options, target, lambda c: text.byte_slice(c, start, end), "slice failed")


def to_str(field: Field, number: Column) -> Column:
    """Text form of an integer, double, boolean or text; NULL for every other type.

    ``number`` is the field's double, held in a column.
    """
    return F.coalesce(
        field.text(),
        field.int().cast("string"),
        F.when(number.isNotNull(), numbers.float_text(number)),
        field.bool().cast("string"),
    )


def _str(options: dict, target: str) -> Step:
    source = option(options, "source", NAME)
    path = field_path(source)

    def apply(scope: Scope) -> None:
        field = scope.lookup(path)
        number = scope.read(field, "float")

        def error(stored: Field) -> Column:
            return F.when(
                stored.text().isNull(),
                F.when(field.exists(), f"field {source!r} has no text form").otherwise(
                    f"field {source!r} not found"
                ),
            )

        scope.store(target, NAME, Field({"text": Slot(to_str(field, number))}), error)

    return Step(NAME, apply, reads=(tuple(path),), target=target)


OPERATIONS = {"concat": _concat, "split": _split, "hash": _hash, "slice": _slice, "str": _str}


def compute_field_step(options: dict) -> Step:
    operation = option(options, "operation", NAME)
    target = plain_target(options, NAME)
    if operation not in OPERATIONS:
        raise InvalidPipelineError(f"compute_field operation {operation!r} is not supported")
    return OPERATIONS[operation](options, target)
