"""Structural steps: a message that fails one of them is unusable.

Gzip, packed arrays and protobuf run as Arrow functions, everything else as
column expressions. The ``*_step`` builders serve pipelines; ``decompress`` and
``parse_json`` work on any DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..errors import InvalidPipelineError
from ..functions import codecs, protobuf
from ..functions.numbers import json_overflows, parse_int
from .fields import (
    END_KEY, Field, Scope, Slot, Step, close_json, field_path, first_of, json_slot, option,
    plain_target, slot_of,
)

def decompress_step(options: dict) -> Step:
    algorithm = option(options, "algorithm", "decompress")
    if algorithm != "gzip":
        raise InvalidPipelineError(f"compression algorithm {algorithm!r} is not supported")

    def apply(scope: Scope) -> None:
        source = F.col(scope.data)
        name = scope.hold_as("data", codecs.gunzip(source))
        broken = (F.octet_length(source) > 0) & F.col(name).isNull()
        scope.fail("decompress", F.when(broken, "payload is not valid gzip"), structural=True)
        scope.data = name

    return Step("decompress", apply, structural=True)


def parse_json_step(options: dict) -> Step:
    def apply(scope: Scope) -> None:
        data = F.col(scope.data)
        (beyond,) = scope.hold(beyond=json_overflows(data.cast("string")))
        complete = scope.add_json(data.cast("string"))
        empty = F.coalesce(F.octet_length(data), F.lit(0)) == 0
        message = (
            F.when(empty, "payload is empty")
            .when(~complete, "payload is not a JSON object")
            .when(beyond, "payload has a number beyond the double range")
        )
        scope.fail("parse_json", message, structural=True)

    return Step("parse_json", apply, structural=True)


def _descriptor_set(options: dict) -> bytes:
    if options.get("proto_file"):
        raise InvalidPipelineError("parse_protobuf takes a compiled descriptor set, not .proto text")
    given = [key for key in ("descriptor_set", "descriptor_file") if options.get(key)]
    if len(given) != 1:
        raise InvalidPipelineError("parse_protobuf needs one of 'descriptor_set' or 'descriptor_file'")
    if given[0] == "descriptor_set":
        return bytes(options["descriptor_set"])
    try:
        with open(option(options, "descriptor_file", "parse_protobuf"), "rb") as file:
            return file.read()
    except OSError as cause:
        raise InvalidPipelineError(f"descriptor set cannot be read: {cause}") from cause


def parse_protobuf_step(options: dict) -> Step:
    descriptor_set = _descriptor_set(options)
    message_type = option(options, "message_type", "parse_protobuf")
    schema = protobuf.message_schema(descriptor_set, message_type)
    source = options.get("source")
    path = None if source is None else field_path(source)
    target = options.get("target")
    if target is not None and (not isinstance(target, str) or not target or "." in target):
        raise InvalidPipelineError("parse_protobuf target must be a name without '.'")

    def apply(scope: Scope) -> None:
        message: Column = F.lit(None).cast("string")
        if path is None:
            data = F.col(scope.data)
        else:
            field = scope.lookup(path)
            (data,) = scope.hold(raw=F.coalesce(field.bytes(), field.text().cast("binary")))
            message = F.when(~field.exists(), f"field {source!r} not found").when(
                data.isNull(), f"field {source!r} holds neither bytes nor text"
            )
        (decoded,) = scope.hold(msg=protobuf.decode_protobuf(data, descriptor_set, message_type))
        broken = F.when(F.octet_length(data) == 0, "message is empty").when(
            decoded.isNull(), f"bytes are not a valid {message_type}"
        )
        scope.fail("parse_protobuf", F.coalesce(message, broken), structural=True)
        if target is None:
            scope.add_message(decoded, schema)
        else:
            scope.assign(target, Field({"message": Slot(decoded, dtype=schema)}))

    reads = () if path is None else (tuple(path),)
    return Step("parse_protobuf", apply, reads=reads, target=target, structural=True)


def unpack_step(options: dict) -> Step:
    source = option(options, "source", "unpack")
    path = field_path(source)
    target = plain_target(options, "unpack")
    type_name = option(options, "type", "unpack")
    endianness = options.get("endianness")
    literal, scale_path = _scale_options(options.get("scale"))
    # Checks type, byte order and literal scale before any data is read.
    codecs.unpack(F.lit(None).cast("binary"), type_name, endianness, literal)
    scaled = literal is not None or scale_path is not None
    kind = codecs.unpacked_type(type_name, scaled)
    width = codecs.PACKED_TYPES[type_name][1]

    def apply(scope: Scope) -> None:
        field = scope.lookup(path)
        factor = None
        held = {"raw": field.bytes(), "found": field.exists()}
        if scale_path is not None:
            scale_field = scope.lookup(scale_path)
            held |= {"scale": scale_field.float(), "scale_found": scale_field.exists()}
        raw, found, *rest = scope.hold(**held)
        message = (
            F.when(~found, f"field {source!r} not found")
            .when(raw.isNull(), f"field {source!r} does not hold bytes")
            .when(F.octet_length(raw) % width != 0, f"field {source!r} is no whole number of {type_name}")
        )
        if rest:
            factor, factor_found = rest
            usable = ~F.isnan(factor) & (F.abs(factor) != float("inf")) & (factor != 0)
            message = (
                message.when(~factor_found, f"scale field {options['scale']['source']!r} not found")
                .when(factor.isNull(), "scale is not a double")
                .when(~usable, "scale must be finite and non-zero")
            )
        value = codecs.unpack(raw, type_name, endianness, literal, factor)
        scope.store(target, "unpack", Field({kind: Slot(value)}), lambda _: message, structural=True)

    reads = (tuple(path),) + (() if scale_path is None else (tuple(scale_path),))
    return Step("unpack", apply, reads=reads, target=target, structural=True, options=options)


def _scale_options(scale: object) -> tuple[float | None, list[str] | None]:
    if scale is None:
        return None, None
    if not isinstance(scale, dict) or ("value" in scale) == ("source" in scale):
        raise InvalidPipelineError("unpack scale needs exactly one of 'value' or 'source'")
    if "value" in scale:
        return codecs.check_scale(scale["value"]), None
    return None, field_path(scale["source"])


def extract_map_entry_step(options: dict) -> Step:
    step = "extract_map_entry"
    source = option(options, "source", step)
    path = field_path(source)
    key_target, value_target = option(options, "key_target", step), option(options, "value_target", step)
    on_multiple = option(options, "on_multiple", step, default="fail")
    if on_multiple not in ("first", "fail"):
        raise InvalidPipelineError(f"{step} on_multiple must be 'first' or 'fail'")
    allowed = _allowed_keys(options.get("allowed_keys"))

    def apply(scope: Scope) -> None:
        field = scope.lookup(path)
        json_map = field._json(("OBJ",), "map<string,variant>")
        held = {"found": field.exists()}
        if json_map is not None:
            held["json_map"] = json_map
        columns = dict(zip(held, scope.hold(**held)))
        entries = _entries(field, columns.get("json_map"))
        (keys,) = scope.hold(keys=first_of([k for k, _ in entries], "array<string>"))
        (key,) = scope.hold(key=F.when(F.size(keys) > 0, F.array_min(keys)))

        message = (
            F.when(~columns["found"], f"field {source!r} not found")
            .when(keys.isNull(), f"field {source!r} is not a map")
            .when(F.size(keys) == 0, f"map {source!r} is empty")
        )
        if on_multiple == "fail":
            message = message.when(F.size(keys) > 1, f"map {source!r} has more than one entry")
        if allowed is not None:
            message = message.when(~key.isin(*allowed), f"key of map {source!r} is not allowed")
        scope.fail(step, message, structural=True)

        value = Field({})
        for _, read in entries:
            value = value.or_else(read(key))
        number = parse_int(key)
        scope.store(
            key_target, step, Field({"int": Slot(number), "text": Slot(F.when(number.isNull(), key))})
        )
        scope.store(value_target, step, value)

    return Step(step, apply, reads=(tuple(path),), structural=True)


def _entries(field: Field, json_map: Column | None):
    """(keys, read value of key) for every map-like slot of a field."""
    found = []
    if json_map is not None:

        def read_json(key: Column) -> Field:
            return Field({"json": json_slot(F.try_element_at(json_map, key))})

        found.append((F.map_keys(json_map), read_json))
    if "map" in field.slots:
        slot = field.slots["map"]

        def read_map(key: Column) -> Field:
            return Field(dict([slot_of(F.try_element_at(slot.value, key), slot.dtype.valueType)]))

        found.append((F.map_keys(slot.value), read_map))
    if "message" in field.slots:
        message = field.slots["message"]
        members = {n: message.value.getField(n) for n in message.dtype.fieldNames()}
        names = F.array_compact(
            F.array(*[F.when(c.isNotNull(), F.lit(n)) for n, c in members.items()])
        )

        def read_message(key: Column) -> Field:
            result = Field({})
            for name, column in members.items():
                kind, slot = slot_of(column, message.dtype[name].dataType)
                result = result.or_else(Field({kind: slot.where(key == name)}))
            return result

        found.append((F.when(message.value.isNotNull(), names), read_message))
    return found


def _allowed_keys(raw: object) -> list[str] | None:
    if raw is None:
        return None
    if not isinstance(raw, (list, tuple)) or not raw:
        raise InvalidPipelineError("extract_map_entry allowed_keys must be a non-empty list")
    for key in raw:
        if isinstance(key, bool) or not isinstance(key, (str, int)):
            raise InvalidPipelineError(f"extract_map_entry allowed key {key!r} is neither text nor integer")
    return [str(key) for key in raw]


# The same decoders on plain DataFrames.


def decompress(df: DataFrame, column: str = "payload", algorithm: str = "gzip") -> DataFrame:
    """Replace a compressed column by its content (NULL when corrupt)."""
    decompress_step({"algorithm": algorithm})
    return df.withColumn(column, codecs.gunzip(F.col(column)))


def json_value(text: Column) -> Column:
    """VARIANT of a text that is exactly one JSON value, else NULL; ``text`` is a plain column."""
    document = F.try_parse_json(close_json(text))
    end = F.try_variant_get(document, f"$[1]['{END_KEY}']", "bigint")
    alone = (end == 1) & F.try_variant_get(document, "$[2]", "variant").isNull()
    return F.when(alone, F.try_variant_get(document, "$[0]", "variant"))


def parse_json(df: DataFrame, column: str = "payload", target: str = "body") -> DataFrame:
    """Add the VARIANT of a JSON object payload (NULL when it is none or has a number beyond
    the double range)."""
    text = F.col(column).cast("string")
    is_object = text.startswith("{") | text.rlike(r"^[ \t\r\n]*[{n]")
    return df.withColumn(target, F.when(is_object & ~json_overflows(text), json_value(text)))
