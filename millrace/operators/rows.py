"""Row filter, parse-outcome policy and typed output columns."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..errors import InvalidPipelineError
from ..schema import INT64_MIN, OUTPUT_TYPES
from .fields import Field, Scope

OK, PARTIAL, UNUSABLE = "ok", "partial", "unusable"

# Declared column type -> field type it accepts, without conversion.
ACCEPTS = {
    "timestamp": "time", "double": "float", "int64": "int",
    "blob": "bytes", "string": "text", "symbol": "text",
}


def output_column(scope: Scope, field: Field, kind: str) -> Column:
    """A declared column from the field of its name; NULL when missing or of another type."""
    value = scope.read(field, ACCEPTS[kind])
    if kind == "double":
        value = F.when(~F.isnan(value), value)
    return value.cast(OUTPUT_TYPES[kind])


def row_condition(columns: dict[str, str], mode: str, match: list[dict], prefix: str = "") -> Column:
    """Boolean column of a row filter: TRUE for rows to keep.

    ``columns`` maps column names to declared types. Equality on int64 and text
    columns, any entry may match. A NULL is the empty text or the smallest integer.
    """
    if mode not in ("whitelist", "blacklist"):
        raise InvalidPipelineError(f"filter mode must be whitelist or blacklist, got {mode!r}")
    if not match:
        raise InvalidPipelineError("filter needs at least one match entry")
    tests = []
    for entry in match:
        name, value = entry.get("column"), entry.get("value")
        kind = columns.get(name)
        if kind is None:
            raise InvalidPipelineError(f"filter column {name!r} is not an output column")
        if kind == "int64":
            fits, null_value = isinstance(value, int) and not isinstance(value, bool), INT64_MIN
        elif kind in ("string", "symbol"):
            fits, null_value = isinstance(value, str), ""
        else:
            raise InvalidPipelineError(f"filter column {name!r} of type {kind} cannot be filtered")
        if not fits:
            raise InvalidPipelineError(f"filter value {value!r} does not suit column {name!r}")
        column = F.col(f"{prefix}`{name}`")
        tests.append(F.coalesce(column == F.lit(value), F.lit(value == null_value)))
    matched = reduce(lambda a, b: a | b, tests)
    return matched if mode == "whitelist" else ~matched


def row_filter(df: DataFrame, mode: str | None = None, match: list[dict] | None = None) -> DataFrame:
    """Keep (whitelist) or drop (blacklist) rows equal to any entry; no mode passes all."""
    if not mode and not match:
        return df
    names = {"bigint": "int64", "int": "int64", "string": "string"}
    columns = {n: names.get(t, t) for n, t in df.dtypes}
    return df.filter(row_condition(columns, mode, match or []))


class Policy(NamedTuple):
    kept: DataFrame
    sent_back: DataFrame
    dropped: DataFrame


def check_action(action: str) -> str:
    if action not in ("drop", "fail"):
        raise InvalidPipelineError(f"parse error action must be drop or fail, got {action!r}")
    return action


def is_sent_back(action: str) -> Column:
    """Messages to deliver again: none when dropping, every imperfect one otherwise."""
    return F.lit(False) if check_action(action) == "drop" else F.col("outcome") != OK


def is_dropped(action: str) -> Column:
    return (F.col("outcome") == UNUSABLE) if check_action(action) == "drop" else F.lit(False)


def apply_policy(df: DataFrame, action: str = "drop") -> Policy:
    """Split parsed messages: ``drop`` keeps ok and partial, ``fail`` keeps only ok."""
    back, gone = is_sent_back(action), is_dropped(action)
    return Policy(df.filter(~back & ~gone), df.filter(back), df.filter(gone))
