"""Field extraction steps. A failure leaves the target unset and the message partial."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..errors import InvalidPipelineError
from ..functions import text
from ..functions.timestamps import EPOCH_UNITS, compile_layout, ts_from_float, ts_from_int, ts_from_text
from .fields import (
    CONVERT_TYPES, Field, Scope, Slot, Step, convert, field_path, option, plain_target, whole_option,
)

INDEX, TABLE = "$timestamp", "$table"


def missing_or(found: Column, name: str, failed: Column, reason: str) -> Column:
    return F.when(~found, f"field {name!r} not found").when(failed, reason)


def extract_field_step(options: dict) -> Step:
    step = "extract_field"
    source = option(options, "source", step)
    path = field_path(source)
    target = option(options, "target", step)
    kind = option(options, "type", step)
    if kind not in CONVERT_TYPES:
        raise InvalidPipelineError(f"extract_field type must be one of {', '.join(CONVERT_TYPES)}")
    skip = options.get("on_error") == "skip"

    def apply(scope: Scope) -> None:
        field = scope.lookup(path)

        def error(stored: Field) -> Column:
            reason = f"field {source!r} does not convert to {kind}"
            return missing_or(field.exists(), source, ~stored.exists(), reason)

        scope.store(target, step, convert(field, kind, scope), None if skip else error)

    return Step(step, apply, reads=(tuple(path),), target=target)


def safe_parse_number_step(options: dict) -> Step:
    step = "safe_parse_number"
    source = option(options, "source", step)
    path = field_path(source)
    target = option(options, "target", step)
    mode = options.get("on_error") or "null"

    def apply(scope: Scope) -> None:
        field = scope.lookup(path)
        found = field.exists()
        (number,) = scope.hold(float=convert(field, "float64", scope).float())
        slots = {"float": Slot(number)}
        if mode == "null":
            # A bad value clears the target without counting as an error.
            slots["nil"] = Slot(F.when(found & number.isNull(), F.lit(True)))
        if mode != "skip":
            failed = F.lit(False) if mode == "null" else number.isNull()
            reason = f"field {source!r} is not a number"
            scope.fail(step, missing_or(found, source, failed, reason))
        scope.assign(target, Field(slots))

    return Step(step, apply, reads=(tuple(path),), target=target)


def field_to_ts(scope: Scope, field: Field, fmt: str) -> Column:
    """Nanoseconds of a field in any of the types a timestamp may arrive in."""
    readers = [("text", ts_from_text), ("int", ts_from_int), ("float", ts_from_float)]
    parts = [field.time()] if "time" in field.slots else []
    for kind, read in readers:
        if kind in field.slots or ("json" in field.slots and kind != "int"):
            parts.append(read(scope.read(field, kind), fmt))
    return F.coalesce(*parts) if parts else F.lit(None).cast("bigint")


def _timestamp_step(step: str, source: str, target: str, fmt: str) -> Step:
    if fmt not in EPOCH_UNITS:
        compile_layout(fmt)

    def apply(scope: Scope) -> None:
        field = scope.lookup_flat(source)

        def error(stored: Field) -> Column:
            reason = f"field {source!r} is not a timestamp in format {fmt!r}"
            return missing_or(field.exists(), source, stored.time().isNull(), reason)

        scope.store(target, step, Field({"time": Slot(field_to_ts(scope, field, fmt))}), error)

    return Step(step, apply, reads=((source,),), target=target)


def extract_index_step(options: dict) -> Step:
    source = option(options, "source", "extract_index")
    fmt = option(options, "format", "extract_index", default="rfc3339")
    return _timestamp_step("extract_index", source, INDEX, fmt)


def extract_timestamp_step(options: dict) -> Step:
    source = option(options, "source", "extract_timestamp")
    target = plain_target(options, "extract_timestamp")
    fmt = option(options, "format", "extract_timestamp", default="rfc3339")
    return _timestamp_step("extract_timestamp", source, target, fmt)


def subject_piece(subject: Column, segment: int | None = None, trim: str | None = None) -> Column:
    """The whole subject or one of its segments, optionally trimmed; NULL out of range."""
    value = subject if segment is None else text.part_at(subject, ".", segment)
    return text.trim_set(value, trim) if trim else value


def extract_subject_step(options: dict) -> Step:
    step = "extract_subject"
    target = option(options, "target", step)
    segment = whole_option(options, "segment", step, required=False)
    trim = options.get("trim")
    if trim is not None and not isinstance(trim, str):
        raise InvalidPipelineError("extract_subject trim must be a string")

    def apply(scope: Scope) -> None:
        value = subject_piece(F.col(scope.subject), segment, trim)

        def error(stored: Field) -> Column:
            return F.when(stored.text().isNull(), f"subject has no segment {segment}")

        scope.store(target, step, Field({"text": Slot(value)}), error)

    return Step(step, apply, target=target)


def extract_table_step(options: dict) -> Step:
    step = "extract_table"
    value, source = options.get("value"), options.get("source")
    if isinstance(value, str) and isinstance(source, str):
        raise InvalidPipelineError("extract_table takes either 'value' or 'source'")
    if not isinstance(value, str) and not isinstance(source, str):
        source = TABLE

    def apply(scope: Scope) -> None:
        if isinstance(value, str):
            found, name = F.lit(True), F.lit(value)
        else:
            field = scope.lookup_flat(source)
            found, name = field.exists(), scope.read(field, "text")
        usable = F.when(text.valid_table_name(name), name)

        def error(stored: Field) -> Column:
            reason = "table name must be text starting with a letter or digit"
            return missing_or(found, source or "", stored.text().isNull(), reason)

        scope.store(TABLE, step, Field({"text": Slot(usable)}), error)

    return Step(step, apply, reads=() if isinstance(value, str) else ((source,),), target=TABLE)
