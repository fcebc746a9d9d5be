"""Sample arrays to one row per sample on an exact nanosecond time axis."""

from __future__ import annotations

from dataclasses import dataclass, field as attribute

from pyspark.sql import Column, DataFrame, functions as F

from ..errors import InvalidPipelineError
from ..functions.codecs import unpacked_type
from ..functions.timestamps import duration_ns
from .fields import Field, Scope, Step, field_path, first_of, option

STEP = "explode"

# Nanoseconds per unit of a sourced interval.
INTERVAL_UNITS = {"ns": 1, "us": 1_000, "ms": 1_000_000, "s": 1_000_000_000}
INT64_MAX = (1 << 63) - 1


@dataclass(frozen=True)
class Series:
    """A checked explode configuration."""

    source: list[str]
    target: str
    kind: str  # "floats" or "ints"
    start: list[str]
    ordinal: str | None = None
    fixed_ns: int | None = None
    by_length: dict[int, int] = attribute(default_factory=dict)
    interval: list[str] | None = None
    unit_ns: int = 0

    @property
    def reads(self) -> tuple[tuple[str, ...], ...]:
        paths = [self.source, self.start] + ([self.interval] if self.interval else [])
        return tuple(tuple(p) for p in paths)

    @property
    def exploded(self) -> list[str]:
        return [self.target] + ([self.ordinal] if self.ordinal else [])


def compile_series(options: dict, columns: dict[str, str], steps: list[Step]) -> Series:
    source = field_path(option(options, "source", STEP))
    target = option(options, "target", STEP)
    if target.startswith("$"):
        raise InvalidPipelineError("explode target must not start with '$'")
    if columns.get(target) not in ("double", "int64"):
        raise InvalidPipelineError(f"explode target {target!r} must be a double or int64 output column")
    ordinal = options.get("ordinal")
    if ordinal is not None and (ordinal == target or columns.get(ordinal) != "int64"):
        raise InvalidPipelineError(f"explode ordinal {ordinal!r} must be another int64 output column")
    kind = "floats" if columns[target] == "double" else "ints"
    for step in steps:
        if step.name == "unpack" and [step.target] == source:
            produced = unpacked_type(step.options["type"], "scale" in step.options)
            if produced != kind:
                raise InvalidPipelineError(f"unpack gives {produced} but column {target!r} takes {kind}")

    index = options.get("index")
    if not isinstance(index, dict) or not isinstance(index.get("start"), dict):
        raise InvalidPipelineError("explode needs index.start.source")
    start = field_path(option(index["start"], "source", "explode index.start"))
    return Series(source, target, kind, start, ordinal, **_interval(index.get("interval")))


def _interval(raw: object) -> dict:
    modes = [m for m in ("value", "source", "by_length") if isinstance(raw, dict) and m in raw]
    if len(modes) != 1:
        raise InvalidPipelineError("explode index.interval needs one of 'value', 'source', 'by_length'")
    if "unit" in raw and modes != ["source"]:
        raise InvalidPipelineError("explode index.interval 'unit' goes with 'source' only")
    if modes == ["value"]:
        return {"fixed_ns": duration_ns(raw["value"])}
    if modes == ["source"]:
        if raw.get("unit") not in INTERVAL_UNITS:
            raise InvalidPipelineError("explode index.interval unit must be one of ns, us, ms, s")
        return {"interval": field_path(raw["source"]), "unit_ns": INTERVAL_UNITS[raw["unit"]]}
    table = raw["by_length"]
    if not isinstance(table, dict) or not table:
        raise InvalidPipelineError("explode by_length must map array lengths to durations")
    lengths = {}
    for length, duration in table.items():
        number = int(length) if str(length).isdecimal() else 0
        if number <= 0 or number in lengths:
            raise InvalidPipelineError(f"explode by_length key {length!r} must be a unique positive length")
        lengths[number] = duration_ns(duration)
    return {"by_length": lengths}


def series_array(field: Field, kind: str) -> Column:
    """The sample array of a field; NULL unless every element has the wanted type."""
    dtype = "array<double>" if kind == "floats" else "array<bigint>"
    parts = [field.get(kind)]
    other = field.get("ints" if kind == "floats" else "floats")
    if other is not None:
        # An empty list carries no element type.
        parts.append(F.when(F.size(other) == 0, F.array().cast(dtype)))
    slot = field.slots.get("json")
    if slot is not None:
        # JSON numbers are doubles, so only an empty list can feed an integer column.
        pattern = r"^ARRAY<(DOUBLE|BIGINT|DECIMAL\([0-9,]+\)|VOID)>$"
        values = F.when(slot.tag.rlike(pattern), F.try_variant_get(slot.value, "$", "array<double>"))
        if kind == "floats":
            parts.append(values)
        else:
            parts.append(F.when(F.size(values) == 0, F.array().cast(dtype)))
    found = first_of(parts, dtype)
    # An element of another type is NULL by now.
    return F.when(F.forall(found, lambda x: x.isNotNull()), found)


def sourced_interval(whole: Column, number: Column, unit_ns: int) -> Column:
    """Interval in ns from an integer or double count of units; NULL unless positive."""
    from_int = F.when((whole > 0) & (whole <= INT64_MAX // unit_ns), F.try_multiply(whole, F.lit(unit_ns)))
    ns = number * float(unit_ns)
    rounded = F.round(ns).try_cast("bigint")
    from_float = F.when(
        ~F.isnan(ns) & (ns > 0) & (ns < float(INT64_MAX)), F.when(rounded > 0, rounded)
    )
    return F.coalesce(from_int, from_float)


def resolve_series(scope: Scope, series: Series) -> tuple[Column, Column, Column, Column]:
    """Hold array, start and interval of every message; the last column is the error."""
    field, start_field = scope.lookup(series.source), scope.lookup(series.start)
    values, start = scope.hold(
        series=series_array(field, series.kind), start=start_field.time()
    )
    count = F.size(values)
    name, start_name = ".".join(series.source), ".".join(series.start)
    if series.fixed_ns is not None:
        interval, complaint = F.lit(series.fixed_ns), "interval is not usable"
    elif series.by_length:
        pairs = [F.lit(x) for item in sorted(series.by_length.items()) for x in item]
        interval = F.try_element_at(F.create_map(*pairs), count)
        complaint = "no interval for this array length"
    else:
        source = scope.lookup(series.interval)
        interval = sourced_interval(source.int(), source.float(), series.unit_ns)
        complaint = f"field {'.'.join(series.interval)!r} is not a positive interval"
    # The last sample's time must fit, so the per-row arithmetic cannot overflow.
    last = F.try_add(start, F.try_multiply((count - 1).cast("bigint"), interval.cast("bigint")))
    (interval,) = scope.hold(interval=F.when(last.isNotNull() | start.isNull(), interval.cast("bigint")))
    error = (
        F.when(
            values.isNull(), f"field {name!r} is missing or no array of {series.kind}"
        )
        .when(count == 0, F.lit(None))
        .when(
            start.isNull(),
            F.when(start_field.exists(), f"field {start_name!r} is not a timestamp").otherwise(
                f"field {start_name!r} not found"
            ),
        )
        .when(interval.isNull(), complaint)
    )
    return values, start, interval, error


def explode_series(
    df: DataFrame,
    source: str,
    target: str,
    start_ns: Column | str,
    interval_ns: Column | str | int,
    ordinal: str | None = None,
    ts: str = "ts_ns",
) -> DataFrame:
    """One row per array element with its nanosecond time; empty arrays give no row.

    ``interval_ns`` is a column or an integer number of nanoseconds. All other
    columns are repeated on every row, so project before exploding.
    """
    start = F.col(start_ns) if isinstance(start_ns, str) else start_ns
    step = F.lit(interval_ns) if isinstance(interval_ns, int) else interval_ns
    step = F.col(step) if isinstance(step, str) else step
    df = df.withColumns({"__start": start, "__interval": step})
    kept = [c for c in df.columns if c not in (source, "__start", "__interval", ts, target, ordinal)]
    rows = df.select(*[f"`{c}`" for c in kept], "__start", "__interval",
                     F.posexplode(source).alias("__at", "__value"))
    place = F.col("__at").cast("bigint")
    columns = [F.col(f"`{c}`") for c in kept]
    # A time beyond the BIGINT range is NULL instead of the end of the job.
    columns.append(F.try_add(F.col("__start"), F.try_multiply(place, F.col("__interval"))).alias(ts))
    if ordinal:
        columns.append(place.alias(ordinal))
    columns.append(F.col("__value").alias(target))
    return rows.select(*columns)


def interval_by_length(array: Column, lengths: dict[int, str]) -> Column:
    """Nanosecond interval looked up by array length; NULL for an unlisted length."""
    pairs = [F.lit(x) for n, d in sorted(lengths.items()) for x in (n, duration_ns(d))]
    return F.try_element_at(F.create_map(*pairs), F.size(array)).cast("bigint")
