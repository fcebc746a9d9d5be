"""Named message fields and the scope a pipeline resolves them in.

A message field can hold a different type on every row (JSON) and a later step may
overwrite it on some rows only. A ``Field`` is therefore a set of typed slots, at
most one of them non-NULL per row; which one is known to Catalyst as plain columns.
"""

from __future__ import annotations

import re
import secrets
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field as attribute, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..errors import InvalidPipelineError
from ..functions import numbers

# Slot kinds with one fixed Spark type.
SCALARS = {
    "text": T.StringType(),
    "int": T.LongType(),
    "float": T.DoubleType(),
    "bool": T.BooleanType(),
    "bytes": T.BinaryType(),
    "time": T.LongType(),
    "floats": T.ArrayType(T.DoubleType()),
    "ints": T.ArrayType(T.LongType()),
    "nil": T.BooleanType(),
}
# Further kinds: "json" (VARIANT), "message" (STRUCT), "map" (string-keyed MAP), "list" (ARRAY).


@dataclass(frozen=True)
class Slot:
    value: Column
    tag: Column | None = None  # VARIANT type text, json slots only
    dtype: T.DataType | None = None  # message, map and list slots only

    def where(self, condition: Column) -> Slot:
        tag = None if self.tag is None else F.when(condition, self.tag)
        return replace(self, value=F.when(condition, self.value), tag=tag)


def slot_of(value: Column, dtype: T.DataType) -> tuple[str, Slot] | None:
    """Kind and slot of a decoded column, from its Spark type."""
    for kind in ("text", "int", "float", "bool", "bytes", "floats", "ints"):
        if dtype == SCALARS[kind]:
            return kind, Slot(value)
    if isinstance(dtype, T.StructType):
        return "message", Slot(value, dtype=dtype)
    if isinstance(dtype, T.MapType):
        return "map", Slot(value, dtype=dtype)
    return "list", Slot(value, dtype=dtype)


def json_slot(value: Column) -> Slot:
    return Slot(value, tag=F.schema_of_variant(value))


@dataclass(frozen=True)
class Field:
    slots: dict[str, Slot]
    reads: dict[str, Column] = attribute(default_factory=dict, compare=False)  # typed, held

    def get(self, kind: str) -> Column | None:
        slot = self.slots.get(kind)
        return None if slot is None else slot.value

    def exists(self) -> Column:
        present = [slot.value.isNotNull() for slot in self.slots.values()]
        return reduce(lambda a, b: a | b, present) if present else F.lit(False)

    def or_else(self, other: Field, taken: Column | None = None) -> Field:
        """This field where it is set, ``other`` on the remaining rows."""
        free = ~(self.exists() if taken is None else taken)
        merged = dict(self.slots)
        for kind, slot in other.slots.items():
            slot = slot.where(free)
            mine = merged.get(kind)
            if mine is None:
                merged[kind] = slot
            elif mine.dtype == slot.dtype:
                tag = None if mine.tag is None else F.coalesce(mine.tag, slot.tag)
                merged[kind] = replace(mine, value=F.coalesce(mine.value, slot.value), tag=tag)
        return Field(merged)

    # Typed reads. Each gives NULL on rows that hold another type.

    def _json(self, tags: tuple[str, ...], dtype: str) -> Column | None:
        slot = self.slots.get("json")
        if slot is None:
            return None
        match = F.substring(slot.tag, 1, 3).isin(*tags)
        return F.when(match, F.try_variant_get(slot.value, "$", dtype))

    def text(self) -> Column:
        return first_of([self.get("text"), self._json(("STR",), "string")], "string")

    def int(self) -> Column:
        return first_of([self.get("int")], "bigint")

    def float(self) -> Column:
        return first_of([self.get("float"), self._json(("BIG", "DEC", "DOU"), "double")], "double")

    def bool(self) -> Column:
        return first_of([self.get("bool"), self._json(("BOO",), "boolean")], "boolean")

    def bytes(self) -> Column:
        return first_of([self.get("bytes")], "binary")

    def time(self) -> Column:
        return first_of([self.get("time")], "bigint")

    def typed(self, kind: str) -> Column:
        reads = {
            "text": self.text, "int": self.int, "float": self.float,
            "bool": self.bool, "bytes": self.bytes, "time": self.time,
        }
        return reads[kind]()

    def is_held(self, kind: str) -> bool:
        """True when a typed read is just a held column."""
        return "json" not in self.slots and (kind in self.slots or kind == "int")

    def is_nil(self) -> Column:
        """True where the field is present but holds no value (JSON null)."""
        slot = self.slots.get("json")
        checks = [self.get("nil")]
        if slot is not None:
            checks.append(slot.tag == "VOID")
        return first_of(checks, "boolean").eqNullSafe(True)

    def child(self, name: str) -> Field:
        """Descend one level into objects, messages and maps."""
        found = Field({})
        slot = self.slots.get("json")
        if slot is not None:
            inner = F.try_variant_get(slot.value, variant_path([name]), "variant")
            found = Field({"json": json_slot(inner)})
        slot = self.slots.get("message")
        if slot is not None and name in slot.dtype.fieldNames():
            inner = slot_of(slot.value.getField(name), slot.dtype[name].dataType)
            found = found.or_else(Field(dict([inner])))
        slot = self.slots.get("map")
        if slot is not None:
            inner = slot_of(F.try_element_at(slot.value, F.lit(name)), slot.dtype.valueType)
            found = found.or_else(Field(dict([inner])))
        return found


def first_of(columns: Iterable[Column | None], dtype: str) -> Column:
    present = [c for c in columns if c is not None]
    if not present:
        return F.lit(None).cast(dtype)
    return present[0] if len(present) == 1 else F.coalesce(*present)


def convert(field: Field, target: str, scope: Scope) -> Field:
    """Convert to ``auto, string, int64, float64, bool`` or ``bytes``; unset where impossible."""
    if target == "auto":
        return field
    text = scope.read(field, "text")
    number = scope.read(field, "float") if {"float", "json"} & set(field.slots) else None
    whole = field.get("int")
    if target == "string":
        parts = [
            text,
            None if number is None else F.when(number.isNotNull(), numbers.float_text(number)),
            None if whole is None else whole.cast("string"),
        ]
        if {"bool", "json"} & set(field.slots):
            parts.append(field.bool().cast("string"))
        if {"nil", "json"} & set(field.slots):
            parts.append(F.when(field.is_nil(), F.lit("<nil>")))
        if "bytes" in field.slots:
            parts.append(numbers.bytes_text(field.bytes()))
        if "time" in field.slots:
            from ..functions.timestamps import ts_text

            parts.append(ts_text(field.time()))
        if "json" in field.slots:
            # Nested values print as JSON.
            parts.append(field._json(("OBJ", "ARR"), "string"))
        for kind in ("message", "map", "list", "floats", "ints"):
            if kind in field.slots:
                parts.append(F.to_json(field.get(kind)))
        return Field({"text": Slot(first_of(parts, "string"))})
    if target == "int64":
        truncated = None if number is None else numbers.float_to_int(number)
        return Field({"int": Slot(first_of([whole, truncated, numbers.parse_int(text)], "bigint"))})
    if target == "float64":
        widened = None if whole is None else whole.cast("double")
        return Field({"float": Slot(first_of([number, widened, numbers.parse_float(text)], "double"))})
    if target == "bool":
        return Field({"bool": Slot(F.coalesce(field.bool(), numbers.parse_bool(text)))})
    if target == "bytes":
        return Field({"bytes": Slot(F.coalesce(field.bytes(), text.cast("binary")))})
    raise InvalidPipelineError(f"unknown field type {target!r}")


CONVERT_TYPES = ("auto", "string", "int64", "float64", "bool", "bytes")


def field_path(path: object) -> list[str]:
    """Split and check a dot path."""
    if not isinstance(path, str) or not path:
        raise InvalidPipelineError("field path is empty")
    segments = path.split(".")
    if "" in segments:
        raise InvalidPipelineError(f"field path {path!r} has an empty segment")
    return segments


def variant_path(segments: list[str]) -> str:
    steps = []
    for segment in segments:
        if "[" not in segment and "'" not in segment:
            steps.append(f".{segment}" if segment.isidentifier() else f"['{segment}']")
        else:
            steps.append(f'["{segment}"]')
    return "$" + "".join(steps)


# Appended after a payload so that text trailing the object is noticed. Drawn anew by every
# driver, so that no sender can write it.
END_KEY = f"~{secrets.token_hex(16)}~"
STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def close_json(text: Column) -> Column:
    """The payload as the first of two array elements, the second being the end mark."""
    return F.concat(F.lit("["), text, F.lit(f',{{"{END_KEY}":1}}]'))


def json_paths(paths: list[list[str]]) -> list[tuple[str, ...]]:
    """Distinct paths without those below another one."""
    distinct = list(dict.fromkeys(map(tuple, paths)))
    return [p for p in distinct if not any(p[:n] in distinct for n in range(1, len(p)))]


def json_schema(types: dict[tuple[str, ...], T.DataType], apart: bool = False) -> T.ArrayType:
    """Schema that reads the given paths and the end mark; ``apart`` uses ``names_apart``."""

    def struct(below: dict[tuple[str, ...], T.DataType]) -> T.StructType:
        fields = []
        names = names_apart([path[0] for path in below])
        for name, alias in names.items():
            deeper = {path[1:]: t for path, t in below.items() if path[0] == name and len(path) > 1}
            fields.append(T.StructField(alias if apart else name, struct(deeper) if deeper else below[(name,)]))
        return T.StructType(fields)

    top = struct(types)
    return T.ArrayType(T.StructType([*top.fields, T.StructField(END_KEY, T.LongType())]))


def names_apart(names: list[str]) -> dict[str, str]:
    """Names as Spark can tell them apart: those that differ only by case get a number."""
    distinct = list(dict.fromkeys(names))
    lower = [n.lower() for n in distinct]
    return {n: n if lower.count(n.lower()) == 1 else f"{n}~{i}" for i, n in enumerate(distinct)}


def path_apart(path: tuple[str, ...], paths: list[tuple[str, ...]]) -> list[str]:
    """The path in a schema made with ``apart``."""
    found = []
    for depth, name in enumerate(path):
        siblings = [p[depth] for p in paths if p[:depth] == path[:depth] and len(p) > depth]
        found.append(names_apart(siblings)[name])
    return found


class Branch(Field):
    """An object of which only some descendants are known."""

    def __init__(self, below: dict[tuple[str, ...], Field]):
        present = reduce(lambda a, b: a | b, [field.exists() for field in below.values()])
        super().__init__({"object": Slot(F.when(present, F.lit(True)))})
        object.__setattr__(self, "below", below)

    def child(self, name: str) -> Field:
        if (name,) in self.below:
            return self.below[(name,)]
        deeper = {path[1:]: field for path, field in self.below.items() if path[0] == name}
        return Branch(deeper) if deeper else Field({})


@dataclass
class JsonBody:
    """A decoded JSON object: the fields read from it, by path."""

    paths: dict[tuple[str, ...], Field]

    def find(self, name: str) -> Field | None:
        if (name,) in self.paths:
            return self.paths[(name,)]
        # Only values below this name are read: a stand-in that descends to them.
        below = {path[1:]: field for path, field in self.paths.items() if path[0] == name}
        return Branch(below) if below else None


@dataclass
class MessageBody:
    """A decoded protobuf message: every set field in it is a field."""

    column: Column
    dtype: T.StructType

    def find(self, name: str) -> Field | None:
        if name not in self.dtype.fieldNames():
            return None
        return Field(dict([slot_of(self.column.getField(name), self.dtype[name].dataType)]))


@dataclass
class Assignment:
    """A field written by a step; unset on rows where the step failed."""

    name: str
    field: Field

    def find(self, name: str) -> Field | None:
        return self.field if name == self.name else None


class Scope:
    """Plan-time state of one pipeline: the DataFrame so far, its fields and errors."""

    def __init__(self, df: DataFrame, data: str = "payload", subject: str = "subject"):
        self.inputs = df.columns
        self.data = data
        self.subject = subject
        self.layers: list[JsonBody | MessageBody | Assignment] = []
        self.errors: list[tuple[str, str, bool]] = []  # (column, step, structural)
        self.upcoming: list[list[str]] = []  # paths later steps will read
        self.samples: set[tuple[str, ...]] = set()  # paths read as arrays of doubles only
        self._source = df
        self._lookups: dict[tuple, Field] = {}
        self._levels: list[dict[str, Column]] = []
        self._level_of: dict[str, int] = {}

    # Hidden columns

    def hold(self, **columns: Column) -> list[Column]:
        """Name computed columns so later steps refer to them instead of repeating them."""
        return [F.col(self.hold_as(hint, column)) for hint, column in columns.items()]

    def hold_as(self, hint: str, column: Column) -> str:
        """Like ``hold`` for one column, returning its name.

        Columns are collected by depth, so that the plan gets one projection per
        level of dependency instead of one per step.
        """
        name = f"__{hint}_{len(self._level_of) + 1}"
        used = re.findall(r"__[a-z_]+_[0-9]+", str(column))
        level = max((self._level_of[u] + 1 for u in used if u in self._level_of), default=0)
        if level == len(self._levels):
            self._levels.append({})
        self._levels[level][name] = column
        self._level_of[name] = level
        return name

    def frame(self) -> DataFrame:
        """The input with every held column."""
        return reduce(lambda df, level: df.withColumns(level), self._levels, self._source)

    # Fields

    def add_json(self, text: Column) -> Column:
        """Make the keys of a JSON object fields; returns whether the text is one object.

        One parse reads exactly the paths that steps ask for, each as a small VARIANT.
        """
        types: dict[tuple[str, ...], T.DataType] = {
            path: T.VariantType() for path in json_paths(self.upcoming)
        }
        for path in self.samples:
            # A sample array nothing else reads skips VARIANT; the JSON reader is as strict.
            related = [p for p in self.upcoming if tuple(p[: len(path)]) == path]
            if path in types and len(related) == 1:
                types[path] = T.ArrayType(T.DoubleType())
        read, apart = json_schema(types), json_schema(types, apart=True)
        parsed = F.from_json(close_json(text), read, STRICT_JSON)
        # Structs are cast by position, which gives keys that differ by case their own names.
        (document,) = self.hold(json=parsed if read == apart else parsed.cast(apart))
        first = F.try_element_at(document, F.lit(1))
        body = JsonBody({})
        for path, dtype in types.items():
            item = reduce(lambda column, name: column.getField(name), path_apart(path, list(types)), first)
            if isinstance(dtype, T.VariantType):
                v, t = self.hold(v=item, t=F.schema_of_variant(item))
                body.paths[path] = Field({"json": Slot(v, tag=t)})
            else:
                (values,) = self.hold(floats=item)
                body.paths[path] = Field({"floats": Slot(values)})
        self.layers.append(body)
        ends = F.try_element_at(document, F.lit(2)).getField(END_KEY)
        return F.coalesce((F.size(document) == 2) & (ends == 1), F.lit(False))

    def add_message(self, value: Column, dtype: T.StructType) -> None:
        """Make every set field of a decoded message a field; ``value`` is a held column."""
        self.layers.append(MessageBody(value, dtype))

    def lookup(self, path: str | list[str]) -> Field:
        """Resolve a dot path against the newest value of its first segment."""
        segments = field_path(path) if isinstance(path, str) else path
        head, rest = segments[0], segments[1:]
        found = [(layer, layer.find(head)) for layer in reversed(self.layers)]
        found = [(layer, field) for layer, field in found if field is not None]
        if not found:
            return Field({})
        if len(found) == 1 and isinstance(found[0][0], JsonBody):
            exact = found[0][0].paths.get(tuple(segments))
            if exact is not None:
                return exact
        key = (tuple(segments), *[id(layer) for layer, _ in found])
        if key not in self._lookups:
            field = found[0][1]
            for _, older in found[1:]:
                field = field.or_else(older)
            for name in rest:
                field = field.child(name)
            self._lookups[key] = field
        return self._lookups[key]

    def read(self, field: Field, kind: str) -> Column:
        """Typed read of a field, computed once however often it is used."""
        if field.is_held(kind):
            return field.typed(kind)
        if kind not in field.reads:
            (field.reads[kind],) = self.hold(**{f"as_{kind}": field.typed(kind)})
        return field.reads[kind]

    def lookup_flat(self, name: str) -> Field:
        """Resolve a name as written, dots included."""
        return self.lookup([name])

    def assign(self, name: str, field: Field) -> None:
        """Write a field; rows where every slot is NULL keep the previous value."""
        self.layers.append(Assignment(name, field))

    # Errors

    def fail(self, step: str, message: Column, structural: bool = False) -> None:
        """Record a step's error column (NULL where the step succeeded).

        Steps keep computing after a structural failure; errors they then report are
        cut off when the pipeline collects the list.
        """
        self.errors.append((self.hold_as("err", message), step, structural))

    def store(
        self,
        target: str,
        step: str,
        field: Field,
        error: Callable[[Field], Column] | None = None,
        structural: bool = False,
    ) -> None:
        """Hold a computed field under ``target``.

        ``error`` gets the held field, so the value is computed once for both.
        """
        columns: dict[str, Column] = {}
        for kind, slot in field.slots.items():
            columns[kind] = slot.value
            if slot.tag is not None:
                columns["tag"] = slot.tag
        held = dict(zip(columns, self.hold(**columns)))
        stored = Field(
            {
                kind: replace(slot, value=held[kind], tag=held["tag"] if slot.tag is not None else None)
                for kind, slot in field.slots.items()
            }
        )
        if error is not None:
            self.fail(step, error(stored), structural)
        self.assign(target, stored)


@dataclass(frozen=True)
class Step:
    """A configured step: what it does to a scope and which fields it reads."""

    name: str
    apply: Callable[[Scope], None]
    reads: tuple[tuple[str, ...], ...] = ()
    target: str | None = None
    structural: bool = False
    options: dict | None = None


def option(options: dict, key: str, step: str, default: object = None, kind: type = str):
    """Read one option; a missing or mistyped one without default is an error."""
    value = options.get(key)
    if value is None and default is not None:
        return default
    if not isinstance(value, kind) or isinstance(value, bool) or value == "":
        raise InvalidPipelineError(f"{step} needs a {kind.__name__} option {key!r}, got {value!r}")
    return value


def whole_option(options: dict, key: str, step: str, required: bool = True) -> int | None:
    value = options.get(key)
    if value is None and not required:
        return None
    if not isinstance(value, int) or isinstance(value, bool):
        raise InvalidPipelineError(f"{step} option {key!r} must be an integer, got {value!r}")
    return value


def plain_target(options: dict, step: str, key: str = "target") -> str:
    """A target name that is not one of the reserved ``$`` fields."""
    target = option(options, key, step)
    if target.startswith("$"):
        raise InvalidPipelineError(f"{step} {key} {target!r} must not start with '$'")
    return target
