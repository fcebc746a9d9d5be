"""A declared list of steps compiled into one Spark plan."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..errors import InvalidPipelineError
from ..functions.text import valid_table_name
from ..functions.timestamps import timestamp_to_ns
from ..operators.compute import compute_field_step
from ..operators.decode import (
    decompress_step, extract_map_entry_step, parse_json_step, parse_protobuf_step, unpack_step,
)
from ..operators.extract import (
    INDEX, TABLE, extract_field_step, extract_index_step, extract_subject_step,
    extract_table_step, extract_timestamp_step, safe_parse_number_step,
)
from ..operators.fields import Scope, Step
from ..operators.rows import (
    OK, PARTIAL, UNUSABLE, apply_policy, output_column, row_condition,
)
from ..operators.series import STEP as EXPLODE, compile_series, explode_series, resolve_series
from ..schema import check_output_columns

Builder = Callable[[dict], Step]

_BUILDERS: dict[str, Builder] = {
    "decompress": decompress_step,
    "parse_json": parse_json_step,
    "parse_protobuf": parse_protobuf_step,
    "unpack": unpack_step,
    "extract_map_entry": extract_map_entry_step,
    "extract_field": extract_field_step,
    "safe_parse_number": safe_parse_number_step,
    "extract_index": extract_index_step,
    "extract_timestamp": extract_timestamp_step,
    "extract_subject": extract_subject_step,
    "extract_table": extract_table_step,
    "compute_field": compute_field_step,
}

# Columns a parsed message carries besides its envelope.
PARSED = ("outcome", "errors", "table_name", "ts_ns", "n_rows", "selected", "row")


def register_step(name: str, builder: Builder) -> None:
    """Make ``builder`` (options -> Step) available to pipelines under ``name``."""
    if name in _BUILDERS or name == EXPLODE:
        raise InvalidPipelineError(f"step {name!r} is already registered")
    _BUILDERS[name] = builder


def registered_steps() -> list[str]:
    """Names of the steps a pipeline may use."""
    return [*_BUILDERS, EXPLODE]


def load_spec(path: str) -> dict:
    """Read a pipeline declaration from a YAML or JSON file."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as cause:
        raise InvalidPipelineError("reading YAML needs the yaml package; use JSON") from cause
    return yaml.safe_load(text)


class Pipeline:
    """Checks a declaration when constructed; ``transform`` then builds the plan.

    The declaration has ``output.columns``, ``transformations`` (a list of
    ``{"step": name, "config": {...}}``) and optionally ``filters``.
    """

    def __init__(self, spec: dict, action: str = "drop"):
        self.action = action
        self.columns = check_output_columns((spec.get("output") or {}).get("columns") or [])
        types = dict(self.columns)
        self.steps, explode = self._compile(spec.get("transformations") or [])
        self.series = None if explode is None else compile_series(explode, types, self.steps)
        self._check_bindings(types)

        filters = spec.get("filters") or {}
        self.filter: Column | None = None
        if filters.get("mode") or filters.get("match"):
            exploded = self.series.exploded if self.series else []
            for entry in filters.get("match") or []:
                if entry.get("column") in exploded:
                    raise InvalidPipelineError(f"cannot filter exploded column {entry['column']!r}")
            self.filter = row_condition(types, filters.get("mode"), filters.get("match") or [], "row.")

    @staticmethod
    def _compile(entries: list[dict]) -> tuple[list[Step], dict | None]:
        named = []
        for entry in entries:
            name = entry.get("step") or entry.get("block")
            named.append((name, entry.get("config") or {}))
        names = [name for name, _ in named]
        explode = None
        if names.count(EXPLODE) > 1:
            raise InvalidPipelineError("a pipeline explodes at most once")
        if EXPLODE in names:
            if names[-1] != EXPLODE:
                raise InvalidPipelineError("explode must be the last step")
            if "extract_index" in names:
                raise InvalidPipelineError("explode sets the index itself; remove extract_index")
            explode = named.pop()[1]
        if not named:
            raise InvalidPipelineError("the pipeline has no steps")
        if "extract_table" not in names:
            raise InvalidPipelineError("the pipeline needs an extract_table step")
        for name, _ in named:
            if name not in _BUILDERS:
                raise InvalidPipelineError(f"unknown step {name!r}")
        return [_BUILDERS[name](options) for name, options in named], explode

    def _check_bindings(self, types: dict[str, str]) -> None:
        for step in self.steps:
            if step.name == "unpack" and step.target in types:
                if self.series is None or self.series.source != [step.target]:
                    raise InvalidPipelineError(f"array column {step.target!r} needs an explode step")

    # Plans

    def parse(self, messages: DataFrame, payload: str = "payload", subject: str = "subject") -> DataFrame:
        """One row per message: outcome, errors, routing, typed ``row`` and row count."""
        taken = [c for c in PARSED if c in messages.columns]
        if taken:
            messages = messages.drop(*taken)
        scope = Scope(messages, payload, subject)
        if self.series is not None and self.series.kind == "floats":
            scope.samples = {tuple(self.series.source)}
        empty = F.coalesce(F.octet_length(F.col(payload)), F.lit(0)) == 0
        scope.fail("message", F.when(empty, "message is empty"), structural=True)
        for position, step in enumerate(self.steps):
            later = self.steps[position + 1 :]
            scope.upcoming = [list(p) for s in later for p in s.reads]
            scope.upcoming += [list(p) for p in (self.series.reads if self.series else ())]
            # A body key stays visible under its own name: as an output column, as table
            # or index, and under the target of a step that fails.
            scope.upcoming += [[name] for name, _ in self.columns] + [[INDEX], [TABLE]]
            scope.upcoming += [[s.target] for s in later if s.target]
            step.apply(scope)
        return self._finish(scope)

    def _finish(self, scope: Scope) -> DataFrame:
        index = scope.read(scope.lookup_flat(INDEX), "time")
        if any(step.name == "extract_index" for step in self.steps):
            scope.fail("extract_index", F.when(index.isNull(), "message has no index"), structural=True)
        elif self.series is None:
            # No index configured: processing time, constant within a (micro-)batch.
            index = F.coalesce(index, timestamp_to_ns(F.current_timestamp()))
        table = scope.read(scope.lookup_flat(TABLE), "text")
        unrouted = F.when(~valid_table_name(table), "message has no valid table name")
        scope.fail("extract_table", unrouted, structural=True)

        declared = dict(self.columns)
        extra: dict[str, Column] = {}
        count: Column = F.lit(1)
        if self.series is not None:
            for name in self.series.exploded:
                declared.pop(name)
            values, index, interval, error = resolve_series(scope, self.series)
            scope.fail(EXPLODE, error, structural=True)
            extra = {"series": values, "interval_ns": interval}
            count = F.size(values)

        row = [output_column(scope, scope.lookup_flat(n), k).alias(n) for n, k in declared.items()]
        broken = any_set([name for name, _, structural in scope.errors if structural])
        flawed = any_set([name for name, _, structural in scope.errors if not structural])
        outcome = F.when(broken, UNUSABLE).when(flawed, PARTIAL).otherwise(OK)
        # The condition always holds. As it depends on the partition, Catalyst evaluates
        # the outcome where it is defined; filters on it would otherwise move below every
        # step, and each of their references would decode the payload again.
        outcome = F.when(F.spark_partition_id() >= 0, outcome)
        parsed = scope.frame().select(
            *[F.col(f"`{c}`") for c in scope.inputs],
            outcome.alias("outcome"),
            F.when(broken | flawed, error_list(scope.errors)).otherwise(no_errors()).alias("errors"),
            F.when(~broken, table).alias("table_name"),
            F.when(~broken, index).alias("ts_ns"),
            F.when(~broken, count.cast("bigint")).otherwise(F.lit(0)).alias("n_rows"),
            F.struct(*(row or [F.lit(None).cast("string").alias("_")])).alias("row"),
            *[F.when(~broken, column).alias(name) for name, column in extra.items()],
        )
        keeps = F.lit(True) if self.filter is None else self.filter
        return parsed.withColumn("selected", (F.col("outcome") != UNUSABLE) & keeps)

    def rows(self, parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Output rows of parsed messages: routed, filtered, exploded, typed.

        ``keep`` lists envelope columns to carry along (default: ``sequence``).
        """
        carried = ["sequence"] if keep is None else keep
        carried = [c for c in carried if c in parsed.columns]
        chosen = parsed.filter((F.col("outcome") != UNUSABLE) & F.col("selected") & (F.col("n_rows") > 0))
        exploded = self.series.exploded if self.series else []
        flat = [F.col(f"row.`{n}`").alias(n) for n, _ in self.columns if n not in exploded]
        base = [F.col(c) for c in ("table_name", "ts_ns", *carried)]
        if self.series is None:
            return chosen.select(*base, *flat)
        narrow = chosen.select(*base, *flat, "series", "interval_ns")
        rows = explode_series(
            narrow, "series", self.series.target, "ts_ns", "interval_ns", self.series.ordinal
        ).drop("interval_ns")
        names = [n for n, _ in self.columns]
        if "double" == dict(self.columns)[self.series.target]:
            value = F.col(self.series.target)
            rows = rows.withColumn(self.series.target, F.when(~F.isnan(value), value))
        return rows.select("table_name", "ts_ns", *carried, *[f"`{n}`" for n in names])

    def transform(self, messages: DataFrame, where: Column | None = None, **columns: str) -> DataFrame:
        """Messages to output rows under the pipeline's policy.

        ``where`` is a condition on envelopes. It applies before anything is decoded, so a
        scan of stored messages reads only what it needs.
        """
        if where is not None:
            messages = messages.filter(where)
        return self.rows(apply_policy(self.parse(messages, **columns), self.action).kept)


def any_set(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns], F.lit(False))


def no_errors() -> Column:
    return F.array().cast("array<struct<step:string,structural:boolean,message:string>>")


def error_list(errors: list[tuple[str, str, bool]]) -> Column:
    """Errors in step order, ending with the first structural one."""
    entries = [
        F.when(
            F.col(name).isNotNull(),
            F.struct(
                F.lit(step).alias("step"),
                F.lit(structural).alias("structural"),
                F.col(name).alias("message"),
            ),
        )
        for name, step, structural in errors
    ]
    found = F.array_compact(F.array(*entries))
    stop = F.array_position(found.getField("structural"), True).cast("int")
    return F.when(stop > 0, F.slice(found, 1, stop)).otherwise(found)


def validate_pipeline(spec: dict) -> None:
    """Raise ``InvalidPipelineError`` when the declaration cannot run."""
    Pipeline(spec)


def check_only(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """The parser that stores nothing: messages are checked to be non-empty, zero rows each."""
    empty = F.coalesce(F.octet_length(F.col(payload)), F.lit(0)) == 0
    return messages.withColumns(
        {"outcome": F.when(empty, UNUSABLE).otherwise(OK), "n_rows": F.lit(0).cast("bigint")}
    )
