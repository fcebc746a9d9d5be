"""Registered queries: each operator over whole tables, next to the SQL it must equal."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.functions import codecs, text, timestamps
from millrace.functions.buckets import exp_buckets
from millrace.operators import decode, stats
from millrace.operators.compare import compare_tables, comparison_summary
from millrace.operators.rows import apply_policy
from millrace.operators.series import explode_series, interval_by_length
from millrace.operators.fields import Field, Slot, Step
from millrace.plans.pipeline import Pipeline, check_only, register_step, registered_steps
from millrace.schema import sentinel_fill
from millrace.session import configure
from millrace.sources import detect, envelopes, lines
from millrace.streaming import ingest, live, rolling, sinks, unique

from . import messages as m

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def columns(**types: str) -> dict:
    return {"columns": [{"name": n, "type": t} for n, t in types.items()]}


def step(name: str, **options) -> dict:
    return {"step": name, "config": options}


def field(source: str, target: str, kind: str, **options) -> dict:
    return step("extract_field", source=source, target=target, type=kind, **options)


def compute(operation: str, target: str, **options) -> dict:
    return step("compute_field", operation=operation, target=target, **options)


NS = "epoch_us({}) * 1000"

# Flagship: decode, extract, compute, route, classify, filter, tally


def event_spec(**filters) -> dict:
    return {
        "output": columns(kind="string", k="int64", value="double", user="string", tag="string"),
        "transformations": [
            step("parse_json"),
            field("event_type", "kind", "string"),
            field("props.k", "k", "int64"),
            step("extract_subject", target="user", segment=-1),
            compute("concat", "tag", fields=["kind", '"/"', "user"]),
            compute("concat", "table", fields=['"events."', "kind"]),
            step("extract_table", source="table"),
            step("extract_index", source="ts", format="rfc3339"),
        ],
        "filters": filters,
    }


@query(
    "ingest_event_tallies",
    """SELECT 'events.' || event_type AS table_name, count(*) AS rows, count(*) AS msgs
       FROM events WHERE event_type <> 'click' GROUP BY 1""",
)
def ingest_event_tallies(spark, sf_dir):
    spec = event_spec(mode="blacklist", match=[{"column": "kind", "value": "click"}])
    pipeline = Pipeline(spec)
    return stats.table_tallies(apply_policy(pipeline.parse(m.event_messages(spark, sf_dir))).kept)


@query(
    "ingest_event_rows",
    f"""SELECT 'events.' || event_type AS table_name, {NS.format('ts')} AS ts_ns,
          event_id AS sequence, event_type AS kind,
          CAST(json_extract(props, '$.k') AS BIGINT) AS k, value,
          CAST(user_id AS VARCHAR) AS "user", event_type || '/' || user_id AS tag
        FROM events""",
)
def ingest_event_rows(spark, sf_dir):
    return Pipeline(event_spec()).transform(m.event_messages(spark, sf_dir))


@query(
    "numbers_beyond_double",
    """SELECT event_id AS sequence, CASE WHEN event_id % 20 > 8 THEN 'unusable' ELSE 'ok' END AS outcome,
         CASE WHEN event_id % 20 <= 8 THEN user_id END AS who
       FROM events""",
)
def numbers_beyond_double(spark, sf_dir):
    # 1e308 is a double, 1e309 is none; in a text both are fine.
    power = F.concat(F.lit("1e"), (F.col("event_id") % 20 + 300).cast("string"))
    body = F.format_string('{"who": %d, "list": [{"v": %s}], "note": "1e999 \\\\\\" %s"}', F.col("user_id"), power, "event_type")
    spec = {
        "output": columns(who="int64"),
        "transformations": [step("parse_json"), field("who", "who", "int64"), step("extract_table", value="t")],
    }
    parsed = Pipeline(spec).parse(m.event_messages(spark, sf_dir, body))
    return parsed.select("sequence", "outcome", F.when(F.col("outcome") == "ok", F.col("row.who")).alias("who"))


# Type conversions

@query(
    "convert_types",
    """SELECT o_orderkey AS sequence, CAST(trunc(o_totalprice) AS BIGINT) AS whole,
         o_custkey AS from_text, CAST(o_custkey AS DOUBLE) AS number,
         CAST(o_orderkey AS VARCHAR) AS key_text, 'true' AS flag_text, o_orderstatus AS status,
         CAST(NULL AS DOUBLE) AS mismatch
       FROM orders""",
)
def convert_types(spark, sf_dir):
    orders = m.table(spark, sf_dir, "orders")
    body = F.to_json(F.struct(
        "o_totalprice", F.col("o_custkey").cast("string").alias("cust"), F.lit(True).alias("flag"),
        F.col("o_orderkey").alias("key"), F.struct("o_orderstatus").alias("nested"),
    ))
    messages = m.envelope(orders, F.lit("orders"), F.col("o_orderkey"), m.utc("o_orderdate"), body)
    spec = {
        "output": columns(
            whole="int64", from_text="int64", number="double", key_text="string", flag_text="string",
            status="string", mismatch="double",
        ),
        "transformations": [
            step("parse_json"),
            field("o_totalprice", "whole", "int64"),
            field("cust", "from_text", "int64"),
            field("cust", "number", "float64"),
            step("extract_map_entry", source="nested", key_target="column", value_target="status"),
            field("o_totalprice", "mismatch", "int64"),
            field("flag", "flag_value", "bool"),
            field("flag_value", "flag_text", "string"),
            compute("concat", "ignored", fields=["cust", '"-"', "status"]),
            step("extract_table", value="orders"),
            step("extract_index", source="key", format="unix"),
            compute("str", "key_text", source="key_number"),
        ],
    }
    spec["transformations"].insert(1, field("key", "key_number", "int64"))
    return Pipeline(spec).transform(messages).drop("table_name", "ts_ns")


NUMBER_TEXT = """CASE WHEN {0} = floor({0}) AND abs({0}) < 1000000 THEN CAST(CAST({0} AS BIGINT) AS VARCHAR)
    ELSE CAST({0} AS VARCHAR) END"""


@query(
    "registered_step",
    "SELECT event_id AS sequence, reverse(event_type) AS backwards, 'ok' AS outcome FROM events",
)
def registered_step(spark, sf_dir):
    """A step of the user's own inside a pipeline."""

    def backwards(options: dict) -> Step:
        def apply(scope) -> None:
            value = F.reverse(scope.read(scope.lookup(options["source"]), "text"))
            scope.store(options["target"], "backwards", Field({"text": Slot(value)}))

        return Step("backwards", apply, reads=((options["source"],),), target=options["target"])

    if "backwards" not in registered_steps():
        register_step("backwards", backwards)
    spec = {
        "output": columns(backwards="string"),
        "transformations": [
            step("parse_json"),
            step("backwards", source="event_type", target="backwards"),
            step("extract_table", value="t"),
        ],
    }
    return Pipeline(spec).parse(m.event_messages(spark, sf_dir)).select("sequence", "row.backwards", "outcome")


@query(
    "number_text",
    f"""SELECT event_id AS sequence, {NUMBER_TEXT.format('value')} AS value_text,
          CAST(user_id AS VARCHAR) AS user_text FROM events""",
)
def number_text(spark, sf_dir):
    spec = {
        "output": columns(value_text="string", user_text="string"),
        "transformations": [
            step("parse_json"),
            compute("str", "value_text", source="value"),
            field("user_id", "user_number", "int64"),
            compute("str", "user_text", source="user_number"),
            step("extract_table", value="t"),
        ],
    }
    rows = Pipeline(spec).transform(m.event_messages(spark, sf_dir))
    return rows.select("sequence", "value_text", "user_text")


@query(
    "safe_parse_number",
    """SELECT event_id AS sequence,
         CASE WHEN event_type IN ('error', 'view', 'signup') THEN NULL ELSE value END AS measurement,
         CASE WHEN event_type = 'signup' THEN 'partial' ELSE 'ok' END AS outcome
       FROM events""",
)
def safe_parse_number(spark, sf_dir):
    events = m.table(spark, sf_dir, "events")
    kind = F.col("event_type")
    reading = (
        F.when(kind == "error", "SENSOR_FAULT")
        .when(kind == "view", "12 ")
        .when(kind != "signup", F.col("value").cast("string"))
    )
    body = F.to_json(F.struct("event_id", reading.alias("temp")))
    messages = m.envelope(events, F.lit("s"), F.col("event_id"), m.utc("ts"), body)
    spec = {
        "output": columns(measurement="double"),
        "transformations": [
            step("parse_json"),
            step("safe_parse_number", source="temp", target="measurement", on_error="null"),
            step("extract_table", value="t"),
        ],
    }
    return Pipeline(spec).parse(messages).select("sequence", "row.measurement", "outcome")


FORMATS = {
    "as_rfc3339": ("rfc3339", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    "as_offset": ("rfc3339nano", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"),
    "as_plain": ("2006-01-02 15:04:05", "yyyy-MM-dd HH:mm:ss"),
    "as_date": ("2006-01-02", "yyyy-MM-dd"),
    "as_us": ("01/02/2006 03:04:05 PM", "MM/dd/yyyy hh:mm:ss a"),
    "as_named": ("02 Jan 2006 15:04:05 -0700", "dd MMM yyyy HH:mm:ss '+0000'"),
}


@query(
    "safe_parse_number_modes",
    """SELECT event_id AS sequence, CASE WHEN bad THEN NULL ELSE value END AS skipped,
         CASE WHEN bad THEN NULL ELSE value END AS failed, CASE WHEN bad THEN 'partial' ELSE 'ok' END AS outcome
       FROM (SELECT *, event_type IN ('error', 'view') AS bad FROM events)""",
)
def safe_parse_number_modes(spark, sf_dir):
    """A bad number under ``skip``, which leaves no error, and under ``fail``, which leaves one."""
    events = m.table(spark, sf_dir, "events")
    bad = F.col("event_type").isin("error", "view")
    body = F.to_json(F.struct(F.when(bad, "n/a").otherwise(F.col("value").cast("string")).alias("reading")))
    messages = m.envelope(events, F.lit("s"), F.col("event_id"), m.utc("ts"), body)
    spec = {
        "output": columns(skipped="double", failed="double"),
        "transformations": [
            step("parse_json"),
            step("safe_parse_number", source="reading", target="skipped", on_error="skip"),
            step("safe_parse_number", source="reading", target="failed", on_error="fail"),
            step("extract_table", value="t"),
        ],
    }
    return Pipeline(spec).parse(messages).select("sequence", "row.skipped", "row.failed", "outcome")


@query(
    "timestamp_nanoseconds",
    """SELECT event_id, epoch_us(date_trunc('day', ts)) * 1000 + 3600000000000 * (event_id % 10)
         + CAST(rpad(CAST(1000000 + event_id AS VARCHAR), 9, '0') AS BIGINT) AS utc_ns,
         epoch_us(date_trunc('day', ts)) * 1000 + 3600000000000 * (event_id % 10)
         + CAST(rpad(CAST(1000000 + event_id AS VARCHAR), 9, '0') AS BIGINT) AS plain_ns
       FROM events""",
)
def timestamp_nanoseconds(spark, sf_dir):
    """Seven to nine digits of the second, hours of one digit."""
    events = m.table(spark, sf_dir, "events")
    key = F.col("event_id")
    day, clock = F.date_format(m.utc("ts"), "yyyy-MM-dd"), F.concat((key % 10).cast("string"), F.lit(":00:00."))
    fraction = (1_000_000 + key).cast("string")
    utc = F.concat(day, F.lit("T"), clock, fraction, F.lit("Z"))
    plain = F.concat(day, F.lit(" "), clock, fraction)
    return events.select(
        "event_id",
        timestamps.to_ts_ns(utc, "rfc3339nano").alias("utc_ns"),
        timestamps.to_ts_ns(plain, "2006-01-02 15:04:05").alias("plain_ns"),
    )


@query(
    "timestamp_formats",
    f"""SELECT event_id AS sequence, epoch_us(date_trunc('second', ts)) * 1000 AS as_rfc3339,
          {NS.format('ts')} AS as_offset, epoch_us(date_trunc('second', ts)) * 1000 AS as_plain,
          epoch_us(date_trunc('day', ts)) * 1000 AS as_date,
          epoch_us(date_trunc('second', ts)) * 1000 AS as_us,
          epoch_us(date_trunc('second', ts)) * 1000 AS as_named,
          {NS.format('ts')} AS as_unix_us, epoch_us(date_trunc('second', ts)) * 1000 AS as_unix_text
        FROM events""",
)
def timestamp_formats(spark, sf_dir):
    events = m.table(spark, sf_dir, "events")
    parts = [F.date_format(m.utc("ts"), pattern).alias(n) for n, (_, pattern) in FORMATS.items()]
    parts.append(F.unix_micros(m.utc("ts")).alias("as_unix_us"))
    parts.append(F.unix_seconds(m.utc("ts")).cast("string").alias("as_unix_text"))
    messages = m.envelope(
        events, F.lit("s"), F.col("event_id"), m.utc("ts"), F.to_json(F.struct(*parts))
    )
    formats = {n: fmt for n, (fmt, _) in FORMATS.items()} | {"as_unix_us": "unix_us", "as_unix_text": "unix"}
    spec = {
        "output": columns(**{n: "timestamp" for n in formats}),
        "transformations": [step("parse_json")]
        + [step("extract_timestamp", source=n, target=n, format=f) for n, f in formats.items()]
        + [step("extract_table", value="t"), step("extract_index", source="as_offset")],
    }
    return Pipeline(spec).transform(messages).drop("table_name", "ts_ns")


@query(
    "subject_segments",
    """SELECT event_id AS sequence, event_type AS kind, rtrim(CAST(user_id AS VARCHAR), '0') AS trimmed,
         'events.' || event_type || '.' || user_id AS whole, CAST(NULL AS VARCHAR) AS beyond,
         'partial' AS outcome
       FROM events""",
)
def subject_segments(spark, sf_dir):
    spec = {
        "output": columns(kind="string", trimmed="string", whole="string", beyond="string"),
        "transformations": [
            step("extract_subject", target="kind", segment=-2),
            step("extract_subject", target="trimmed", segment=2, trim="0"),
            step("extract_subject", target="whole"),
            step("extract_subject", target="beyond", segment=3),
            step("extract_table", source="kind"),
        ],
    }
    parsed = Pipeline(spec).parse(m.event_messages(spark, sf_dir))
    return parsed.select("sequence", "row.*", "outcome")


# Derived text and routing


@query(
    "compute_chain",
    """SELECT c_custkey AS sequence, sha1(c_name) AS digest, sha256(c_mktsegment) AS long_digest,
         sha1(c_name)[1:4] AS shard, string_split(c_name, '#')[-1] AS number,
         c_name[-4:] AS tail, c_name[1:length(c_name) - 2] AS head,
         string_split(c_name, '#')[-1] || ':' || c_mktsegment AS tag
       FROM customer""",
)
def compute_chain(spark, sf_dir):
    customer = m.table(spark, sf_dir, "customer")
    body = F.to_json(F.struct("c_name", "c_mktsegment"))
    messages = m.envelope(customer, F.lit("c"), F.col("c_custkey"), F.current_timestamp(), body)
    spec = {
        "output": columns(
            digest="string", long_digest="string", shard="string", number="string", tail="string",
            head="string", tag="string",
        ),
        "transformations": [
            step("parse_json"),
            compute("hash", "digest", source="c_name", algorithm="sha1"),
            compute("hash", "long_digest", source="c_mktsegment", algorithm="sha256"),
            compute("slice", "shard", source="digest", start=0, end=4),
            compute("split", "number", source="c_name", separator="#", index=-1),
            compute("slice", "tail", source="c_name", start=-4),
            compute("slice", "head", source="c_name", start=0, end=-2),
            compute("concat", "tag", fields=["number", '":"', "c_mktsegment"]),
            step("extract_table", value="customers"),
        ],
    }
    return Pipeline(spec).transform(messages).drop("table_name", "ts_ns")


@query(
    "shard_route",
    """SELECT 'shard/' || sha1(CAST(o_custkey AS VARCHAR))[1:4] AS table_name, count(*) AS rows
       FROM orders GROUP BY 1""",
)
def shard_route(spark, sf_dir):
    orders = m.table(spark, sf_dir, "orders")
    routed = orders.select(
        text.shard_name(F.col("o_custkey").cast("string"), "shard/").alias("table_name")
    )
    return stats.row_tallies(routed.filter(text.valid_table_name(F.col("table_name"))))


@query(
    "text_slices",
    """SELECT doc_id, octet_length(encode(text)) AS n_bytes,
         array_length(string_split(text, chr(10))) AS n_lines,
         sha1(text) AS digest, string_split(text, chr(10))[-1] AS last_line
       FROM documents""",
)
def text_slices(spark, sf_dir):
    documents = m.table(spark, sf_dir, "documents")
    whole = text.byte_slice(F.col("text"), 0)
    return documents.select(
        "doc_id",
        F.octet_length(whole).cast("bigint").alias("n_bytes"),
        text.part_count(F.col("text"), "\n").cast("bigint").alias("n_lines"),
        text.digest(whole, "sha1").alias("digest"),
        text.part_at(F.col("text"), "\n", -1).alias("last_line"),
    )


# Outcomes, policy and filters

FLAWED = """WITH o AS (SELECT *, CASE WHEN event_type IN ('error', 'signup', 'purchase') THEN 'unusable'
    WHEN event_type = 'view' THEN 'partial' ELSE 'ok' END AS outcome FROM events)"""


def flawed_pipeline(action: str = "drop", **filters) -> Pipeline:
    spec = {
        "output": columns(kind="string", amount="double"),
        "transformations": [
            step("parse_json"),
            field("event_type", "kind", "string"),
            field("value", "amount", "float64"),
            compute("concat", "table", fields=['"t."', "kind"]),
            step("extract_table", source="table"),
            step("extract_index", source="ts"),
        ],
        "filters": filters,
    }
    return Pipeline(spec, action)


@query(
    "classify_messages",
    FLAWED + """ SELECT event_id AS sequence, outcome,
         CAST(CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2
           WHEN 'view' THEN 1 ELSE 0 END AS BIGINT) AS n_errors,
         CASE event_type WHEN 'error' THEN 'parse_json' WHEN 'signup' THEN 'message'
           WHEN 'purchase' THEN 'extract_index' WHEN 'view' THEN 'extract_field' END AS first_step,
         CASE WHEN outcome <> 'unusable' THEN 't.' || event_type END AS table_name
       FROM o""",
)
def classify_messages(spark, sf_dir):
    parsed = flawed_pipeline().parse(m.flawed_event_messages(spark, sf_dir))
    return parsed.select(
        "sequence",
        "outcome",
        F.size("errors").cast("bigint").alias("n_errors"),
        F.try_element_at("errors", F.lit(1)).getField("step").alias("first_step"),
        "table_name",
    )


POLICY_SQL = (
    FLAWED
    + """ SELECT {group} AS {name}, count(*) AS fetched,
     count(*) FILTER (WHERE {kept} OR {dropped}) AS processed, count(*) FILTER (WHERE {back}) AS parse_failures,
     count(*) FILTER (WHERE {dropped}) AS dropped, CAST(0 AS BIGINT) AS zero_rows,
     count(*) FILTER (WHERE {kept}) AS rows_written,
     count(*) FILTER (WHERE {kept} OR {dropped}) AS acks, count(*) FILTER (WHERE {back}) AS nacks
   FROM o GROUP BY 1"""
)
DROP = {"kept": "outcome <> 'unusable'", "dropped": "outcome = 'unusable'", "back": "false"}
FAIL = {"kept": "outcome = 'ok'", "dropped": "false", "back": "outcome <> 'ok'"}


def policy_counters(spark, sf_dir, action):
    messages = m.flawed_event_messages(spark, sf_dir)
    parsed = flawed_pipeline(action).parse(messages)
    worker = F.split("subject", "[.]")[1].alias("worker")
    return stats.outcome_counters(parsed.withColumn("worker", worker), ["worker"], action)


@query("outcome_counters_drop", POLICY_SQL.format(group="event_type", name="worker", **DROP))
def outcome_counters_drop(spark, sf_dir):
    return policy_counters(spark, sf_dir, "drop")


@query("outcome_counters_fail", POLICY_SQL.format(group="event_type", name="worker", **FAIL))
def outcome_counters_fail(spark, sf_dir):
    return policy_counters(spark, sf_dir, "fail")


@query(
    "empty_series_counters",
    """SELECT count(*) AS fetched, count(*) AS processed, CAST(0 AS BIGINT) AS parse_failures, CAST(0 AS BIGINT) AS dropped,
         count(*) FILTER (WHERE label = 0) AS zero_rows,
         CAST(sum(CASE WHEN label = 0 THEN 0 ELSE len(embedding) END) AS BIGINT) AS rows_written,
         count(*) AS acks, CAST(0 AS BIGINT) AS nacks FROM embeddings""",
)
def empty_series_counters(spark, sf_dir):
    """Messages with an empty series are acknowledged and write no row."""
    messages = series_messages(spark, sf_dir, F.col("label") == 0)
    return stats.outcome_counters(series_pipeline({"value": "1ms"}).parse(messages))


@query(
    "observed_counters",
    POLICY_SQL.format(group="'all'", name="scope", **DROP),
)
def observed_counters(spark, sf_dir):
    """Counters that arrive with the progress of a stream, summed over its batches."""
    folder = m.work_folder(spark)
    inbox = os.path.join(folder, "inbox")
    m.flawed_event_messages(spark, sf_dir).repartition(3, "sequence").write.parquet(inbox)
    messages = envelopes.read_messages(spark, inbox, streaming=True, files_per_trigger=1)
    parsed = ingest.observe_batches(flawed_pipeline().parse(messages), "observed")
    seen: list[dict] = []
    observer = ingest.BatchObserver(seen.append, "observed")
    spark.streams.addListener(observer)
    try:
        writer = parsed.writeStream.format("noop").option("checkpointLocation", os.path.join(folder, "checkpoint"))
        writer.trigger(availableNow=True).start().awaitTermination()
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(observer)
    rows = [("all", *[int(b[c]) for c in stats.COUNTERS]) for b in seen if b.get("fetched")]
    shape = "scope string, " + ", ".join(f"{c} bigint" for c in stats.COUNTERS)
    sums = [F.sum(c).alias(c) for c in stats.COUNTERS]
    return spark.createDataFrame(rows, shape).groupBy("scope").agg(*sums)


@query(
    "rollup_counters",
    POLICY_SQL.format(group="event_type", name="worker", **FAIL).replace("GROUP BY 1", "GROUP BY ROLLUP (event_type)"),
)
def rollup_counters(spark, sf_dir):
    return stats.rollup_counters(policy_counters(spark, sf_dir, "fail")).drop("is_total")


@query(
    "row_filter_whitelist",
    """SELECT 't.' || event_type AS table_name, count(*) AS rows FROM events
       WHERE event_type IN ('click', 'view') GROUP BY 1""",
)
def row_filter_whitelist(spark, sf_dir):
    kinds = [{"column": "kind", "value": k} for k in ("click", "view", "error")]
    pipeline = flawed_pipeline(mode="whitelist", match=kinds)
    return stats.row_tallies(pipeline.transform(m.flawed_event_messages(spark, sf_dir)))


@query(
    "row_filter_blacklist",
    """SELECT event_type AS kind, count(*) AS rows FROM events
       WHERE event_type <> 'click' AND CAST(json_extract(props, '$.k') AS BIGINT) <> 7 GROUP BY 1""",
)
def row_filter_blacklist(spark, sf_dir):
    entries = [{"column": "kind", "value": "click"}, {"column": "k", "value": 7}]
    pipeline = Pipeline(event_spec(mode="blacklist", match=entries))
    rows = pipeline.transform(m.event_messages(spark, sf_dir))
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "check_only",
    """SELECT CASE WHEN event_type = 'signup' THEN 'unusable' ELSE 'ok' END AS outcome,
         count(*) AS n, CAST(0 AS BIGINT) AS rows FROM events GROUP BY 1""",
)
def check_only_outcomes(spark, sf_dir):
    checked = check_only(m.flawed_event_messages(spark, sf_dir))
    return checked.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.sum("n_rows").alias("rows"))


@query(
    "sentinel_fill",
    FLAWED + """ SELECT event_id AS sequence, event_type AS kind, coalesce(value, 0) AS amount,
         false AS is_null FROM o WHERE outcome = 'ok'
       UNION ALL SELECT event_id, event_type, 0, true FROM o WHERE outcome = 'partial'""",
)
def sentinel_values(spark, sf_dir):
    rows = flawed_pipeline().transform(m.flawed_event_messages(spark, sf_dir))
    filled = sentinel_fill(rows, columns(kind="string", amount="double")["columns"])
    return filled.select("sequence", "kind", F.nanvl("amount", F.lit(0.0)).alias("amount"),
                         F.isnan("amount").alias("is_null"))


@query(
    "sentinel_kinds",
    """SELECT event_id AS sequence, event_type AS kind,
         CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS word,
         CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS tag,
         CASE WHEN event_type = 'view' THEN -9223372036854775808 ELSE user_id END AS number,
         CASE WHEN event_type = 'view' THEN -9223372036854775808 ELSE event_id * 1000000000 END AS moment,
         event_type = 'view' AS no_value, CASE WHEN event_type = 'view' THEN 0 ELSE octet_length(encode(event_type)) END AS n_bytes
       FROM events""",
)
def sentinel_kinds(spark, sf_dir):
    """The sentinel of every column type."""
    rows = m.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("sequence"), F.col("event_type").alias("kind"),
        *[F.when(F.col("event_type") != "view", value).alias(name) for name, value in {
            "word": F.col("event_type"), "tag": F.col("event_type"), "number": F.col("user_id"),
            "moment": F.col("event_id") * 1_000_000_000, "ratio": F.col("value"), "raw": F.col("event_type").cast("binary"),
        }.items()],
    )
    kinds = columns(word="string", tag="symbol", number="int64", moment="timestamp", ratio="double", raw="blob")
    filled = sentinel_fill(rows, kinds["columns"])
    return filled.select("sequence", "kind", "word", "tag", "number", "moment", F.isnan("ratio").alias("no_value"),
                         F.octet_length("raw").cast("bigint").alias("n_bytes"))


# Sample series


SERIES_SQL = """SELECT vec_id, {start} + (i - 1) * {interval} AS ts_ns, i - 1 AS sample_index,
    CAST(embedding[i] AS DOUBLE) AS value
  FROM embeddings, LATERAL (SELECT unnest(generate_series(1, len(embedding))) AS i)"""


def vectors(spark, sf_dir):
    start = (F.lit(1_704_067_200_000_000_000) + F.col("vec_id") * 1_000_000_000).alias("start_ns")
    values = F.col("embedding").cast("array<double>").alias("samples")
    return m.table(spark, sf_dir, "embeddings").select("vec_id", start, values)


START = "1704067200000000000 + vec_id * 1000000000"


@query("explode_fixed_interval", SERIES_SQL.format(start=START, interval=200_000))
def explode_fixed_interval(spark, sf_dir):
    return explode_series(vectors(spark, sf_dir), "samples", "value", "start_ns", 200_000, "sample_index").drop("start_ns")


@query("explode_by_length", SERIES_SQL.format(start=START, interval=333_333))
def explode_by_length(spark, sf_dir):
    lengths = {32: "1ms", 64: "333333ns", 8192: "200us"}
    df = vectors(spark, sf_dir)
    step_ns = interval_by_length(F.col("samples"), lengths)
    return explode_series(df, "samples", "value", "start_ns", step_ns, "sample_index").drop("start_ns")


def series_pipeline(interval: dict) -> Pipeline:
    """Embeddings as series, one table for each label."""
    return Pipeline({
        "output": columns(vector="string", place="int64", level="double"),
        "transformations": [
            step("parse_json"),
            compute("concat", "to", fields=['"label."', "label"]),
            step("extract_table", source="to"),
            step("extract_timestamp", source="seen", target="first", format="unix_ms"),
            step("explode", source="parts", target="level", ordinal="place", index={"start": {"source": "first"}, "interval": interval}),
        ],
    })


def series_messages(spark, sf_dir, empty=None):
    vectors = m.table(spark, sf_dir, "embeddings")
    key, label = F.col("vec_id"), F.col("label")
    parts = F.col("embedding").cast("array<double>")
    if empty is not None:
        parts = F.when(empty, F.array().cast("array<double>")).otherwise(parts)
    body = F.to_json(F.struct(
        parts.alias("parts"),
        F.concat(F.lit("v"), key.cast("string")).alias("vector"),
        label.cast("string").alias("label"),
        (label + 0.5).alias("every"),
        (key * 1000 + 1_700_000_000_500).alias("seen"),
    ))
    return m.envelope(vectors, F.lit("vectors"), key, F.current_timestamp(), body)


@query(
    "waveform_pipeline",
    """SELECT 'label.' || label AS table_name,
         (vec_id * 1000 + 1700000000500) * 1000000 + (i - 1) * CAST((label + 0.5) * 1000000 AS BIGINT) AS ts_ns,
         vec_id AS sequence, 'v' || vec_id AS vector, i - 1 AS place, CAST(embedding[i] AS DOUBLE) AS level
       FROM embeddings, LATERAL (SELECT unnest(generate_series(1, len(embedding))) AS i)""",
)
def waveform_pipeline(spark, sf_dir):
    return series_pipeline({"source": "every", "unit": "ms"}).transform(series_messages(spark, sf_dir))


@query(
    "waveform_tallies",
    """SELECT 'label.' || label AS table_name, CAST(sum(len(embedding)) AS BIGINT) AS rows, count(*) AS msgs
       FROM embeddings GROUP BY 1""",
)
def waveform_tallies(spark, sf_dir):
    return stats.table_tallies(series_pipeline({"value": "200us"}).parse(series_messages(spark, sf_dir)))


@query(
    "waveform_by_length",
    """SELECT 'label.' || label AS table_name, (vec_id * 1000 + 1700000000500) * 1000000 + (i - 1) * 333333 AS ts_ns,
         vec_id AS sequence, 'v' || vec_id AS vector, i - 1 AS place, CAST(embedding[i] AS DOUBLE) AS level
       FROM embeddings, LATERAL (SELECT unnest(generate_series(1, len(embedding))) AS i)""",
)
def waveform_by_length(spark, sf_dir):
    lengths = {"by_length": {32: "1ms", 64: "333333ns"}}
    return series_pipeline(lengths).transform(series_messages(spark, sf_dir))


# Packed arrays and codecs


@query(
    "unpack_integers",
    """SELECT l_orderkey, i - 1 AS place, n[i] AS l_linenumber
       FROM (SELECT l_orderkey, list(l_linenumber ORDER BY l_linenumber) AS n FROM lineitem GROUP BY 1),
         LATERAL (SELECT unnest(generate_series(1, len(n))) AS i)""",
)
def unpack_integers(spark, sf_dir):
    lineitem = m.table(spark, sf_dir, "lineitem")
    # An order has a handful of lines, so the list per order stays small.
    numbers = F.sort_array(F.collect_list("l_linenumber"))
    packed = lineitem.groupBy("l_orderkey").agg(numbers.alias("n"))
    packed = packed.select("l_orderkey", m.pack(F.col("n"), ">i2").alias("raw"))
    unpacked = packed.select("l_orderkey", codecs.unpack(F.col("raw"), "int16", "big").alias("n"))
    rows = unpacked.select("l_orderkey", F.posexplode("n").alias("place", "l_linenumber"))
    return rows.withColumns(
        {"place": F.col("place").cast("bigint"), "l_linenumber": F.col("l_linenumber").cast("int")}
    )


@query(
    "unpack_scaled",
    """SELECT vec_id, i - 1 AS place, CAST(embedding[i] AS DOUBLE) * 2.5 AS value
       FROM embeddings, LATERAL (SELECT unnest(generate_series(1, len(embedding))) AS i)""",
)
def unpack_scaled(spark, sf_dir):
    packed = m.table(spark, sf_dir, "embeddings").select("vec_id", m.pack(F.col("embedding"), "<f4").alias("raw"))
    values = codecs.unpack(F.col("raw"), "float32", "little", scale=2.5)
    rows = packed.select("vec_id", F.posexplode(values).alias("place", "value"))
    return rows.withColumn("place", F.col("place").cast("bigint"))


@query(
    "gzip_base64_roundtrip",
    """SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""",
)
def gzip_base64_roundtrip(spark, sf_dir):
    orders = m.table(spark, sf_dir, "orders")
    names = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    armoured = orders.select(
        codecs.encode_payload([F.col(n) for n in names], ("json", "gzip", "base64")).alias("value")
    )
    folder = m.work_folder(spark)
    armoured.write.mode("overwrite").text(folder)
    payloads = lines.read_base64_lines(spark, folder).messages
    plain = decode.parse_json(decode.decompress(payloads))
    types = dict(zip(names, ["bigint", "string", "double", "string"]))
    return plain.select(*[F.try_variant_get("body", f"$.{n}", t).alias(n) for n, t in types.items()])


@query(
    "map_entry",
    """SELECT event_id AS sequence, CAST(user_id AS BIGINT) AS entry_key, value AS entry_value, 'ok' AS outcome
       FROM events WHERE event_type <> 'error'
       UNION ALL SELECT event_id, NULL, NULL, 'unusable' FROM events WHERE event_type = 'error'""",
)
def map_entry(spark, sf_dir):
    events = m.table(spark, sf_dir, "events")
    entry = F.create_map(F.col("user_id").cast("string"), F.col("value"))
    # A key sorting after every digit, so that the number stays the smallest key.
    second = F.map_concat(entry, F.create_map(F.lit("z"), F.lit(0.0)))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    blobs = F.when(F.col("event_type") == "error", empty).when(F.col("event_type") == "view", second).otherwise(entry)
    messages = m.envelope(
        events, F.lit("s"), F.col("event_id"), m.utc("ts"), F.to_json(F.struct(blobs.alias("blobs")))
    )
    spec = {
        "output": columns(entry_key="int64", entry_value="double"),
        "transformations": [
            step("parse_json"),
            step("extract_map_entry", source="blobs", key_target="entry_key",
                 value_target="entry_value", on_multiple="first"),
            step("extract_table", value="t"),
        ],
    }
    return Pipeline(spec).parse(messages).select("sequence", "row.*", "outcome")


@query(
    "map_entry_rules",
    """SELECT event_id AS sequence, CASE WHEN event_type = 'click' THEN CAST(7 AS BIGINT) END AS entry_key,
         CASE WHEN event_type = 'click' THEN value END AS entry_value,
         CASE WHEN event_type = 'click' THEN 'ok' ELSE 'unusable' END AS outcome
       FROM events""",
)
def map_entry_rules(spark, sf_dir):
    """Keys outside the list and second entries make a message unusable."""
    events = m.table(spark, sf_dir, "events")
    kind = F.col("event_type")
    one = F.create_map(F.when(kind == "view", "8").otherwise("7"), F.col("value"))
    two = F.map_concat(one, F.create_map(F.lit("9"), F.lit(0.0)))
    entries = F.when(kind.isin("click", "view"), one).otherwise(two)
    body = F.to_json(F.struct(entries.alias("entries")))
    spec = {
        "output": columns(entry_key="int64", entry_value="double"),
        "transformations": [
            step("parse_json"),
            step("extract_map_entry", source="entries", key_target="entry_key", value_target="entry_value",
                 on_multiple="fail", allowed_keys=["7", "9"]),
            step("extract_table", value="t"),
        ],
    }
    messages = m.envelope(events, F.lit("s"), F.col("event_id"), m.utc("ts"), body)
    good = F.col("outcome") == "ok"  # an unusable message has no row
    cells = [F.when(good, F.col(f"row.{c}")).alias(c) for c in ("entry_key", "entry_value")]
    return Pipeline(spec).parse(messages).select("sequence", *cells, "outcome")


@query(
    "protobuf_decode",
    f"""SELECT event_id AS sequence, 'pb.' || event_type AS table_name, {NS.format('ts')} AS ts_ns, event_id AS id,
          event_type AS kind, value, user_id AS "user", event_type AS blob FROM events""",
)
def protobuf_decode(spark, sf_dir):
    descriptor_set = m.event_descriptor()
    events = m.table(spark, sf_dir, "events")
    payload = m.event_protobuf(descriptor_set, F.unix_micros(m.utc("ts")))
    messages = m.envelope(events, F.lit("pb"), F.col("event_id"), m.utc("ts"), payload)
    spec = {
        "output": columns(id="int64", kind="string", value="double", user="int64", blob="string"),
        "transformations": [
            step("parse_protobuf", descriptor_set=descriptor_set, message_type="feed.Event"),
            step("extract_map_entry", source="blobs", key_target="user", value_target="blob"),
            compute("concat", "to", fields=['"pb."', "kind"]),
            step("extract_table", source="to"),
            step("extract_index", source="ts_us", format="unix_us"),
        ],
    }
    return Pipeline(spec).transform(messages)


# Sources


@query(
    "subject_filter",
    """SELECT 'events.*.7' AS pattern, count(*) AS n FROM events WHERE user_id = 7
       UNION ALL SELECT 'events.click.>', count(*) FROM events WHERE event_type = 'click'
       UNION ALL SELECT 'events.>', count(*) FROM events
       UNION ALL SELECT 'events.view.7', count(*) FROM events WHERE event_type = 'view' AND user_id = 7""",
)
def subject_filter(spark, sf_dir):
    patterns = ["events.*.7", "events.click.>", "events.>", "events.view.7"]
    events = m.table(spark, sf_dir, "events").select(m.event_subject().alias("subject"))
    counts = events.agg(*[
        F.count(F.when(envelopes.subject_condition(F.col("subject"), p), 1)).alias(p) for p in patterns
    ])
    pairs = F.explode(F.array(*[F.struct(F.lit(p).alias("pattern"), F.col(f"`{p}`").alias("n")) for p in patterns]))
    return counts.select(pairs.alias("x")).select("x.*")


@query(
    "jsonlines_split",
    """SELECT CASE WHEN event_type = 'error' THEN 'reject' ELSE 'message' END AS side, count(*) AS n,
         CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE event_id END) AS BIGINT) AS ids
       FROM events WHERE event_type <> 'signup' GROUP BY 1""",
)
def jsonlines_split(spark, sf_dir):
    folder = m.work_folder(spark)
    flawed = m.flawed_event_messages(spark, sf_dir)
    flawed.select(F.col("payload").cast("string").alias("value")).write.mode("overwrite").text(folder)
    split = lines.read_jsonlines(spark, folder)
    number = F.try_variant_get(F.try_parse_json(F.col("payload").cast("string")), "$.event_id", "bigint")
    good = split.messages.select(F.lit("message").alias("side"), number.alias("id"))
    bad = split.rejects.select(F.lit("reject").alias("side"), F.lit(0).cast("bigint").alias("id"))
    return good.unionByName(bad).groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


@query(
    "base64_lines_split",
    """SELECT CASE WHEN event_type = 'view' THEN 'reject' ELSE 'message' END AS side, count(*) AS n,
         CAST(sum(CASE WHEN event_type = 'view' THEN 0 ELSE octet_length(encode(props)) END) AS BIGINT) AS n_bytes
       FROM events GROUP BY 1""",
)
def base64_lines_split(spark, sf_dir):
    folder = m.work_folder(spark)
    events = m.table(spark, sf_dir, "events")
    line = F.base64(F.col("props").cast("binary"))  # short enough for one line
    line = F.when(F.col("event_type") == "view", F.concat(line, F.lit("*"))).otherwise(line)
    events.select(line.alias("value")).write.mode("overwrite").text(folder)
    split = lines.read_base64_lines(spark, folder)
    good = split.messages.select(F.lit("message").alias("side"), F.octet_length("payload").cast("bigint").alias("b"))
    bad = split.rejects.select(F.lit("reject").alias("side"), F.lit(0).cast("bigint").alias("b"))
    return good.unionByName(bad).groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("n_bytes"))


TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query(
    "detect_formats",
    """SELECT CASE event_type WHEN 'click' THEN 'parquet' WHEN 'view' THEN 'jsonl' WHEN 'purchase' THEN 'json.gz' END AS format,
         CASE WHEN event_type IN ('signup', 'error') THEN 'unknown file format' END AS error,
         CASE WHEN event_type IN ('click', 'view', 'purchase') THEN count(*) ELSE 0 END AS rows
       FROM events GROUP BY event_type UNION ALL SELECT NULL, 'empty file', 0""",
)
def detect_formats(spark, sf_dir):
    """A file of each kind of event in a format of its own, and one without any."""
    folder = m.work_folder(spark)
    events = m.table(spark, sf_dir, "events")
    kind = lambda name: events.filter(F.col("event_type") == name).coalesce(1)
    text = lambda name: kind(name).select(F.to_json(F.struct("event_id", "value")).alias("value"))
    kind("click").write.parquet(f"{folder}/good/a")
    text("view").write.text(f"{folder}/good/b")
    text("purchase").write.text(f"{folder}/good/c", compression="gzip")
    for name in ("signup", "error"):
        kind(name).select(F.concat(F.lit("id "), "event_id").alias("value")).write.text(f"{folder}/bad/{name}")
    events.limit(0).select("event_type").coalesce(1).write.text(f"{folder}/bad/none")
    read = detect.read_detected(spark, f"{folder}/good")
    counts = [
        (read[f] if f == "parquet" else read[f].messages).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(f).alias("format"), "rows")
        for f in ("parquet", "jsonl", "json.gz")
    ]
    counts = counts[0].unionByName(counts[1]).unionByName(counts[2])
    good = detect.detect_format(spark, f"{folder}/good").join(counts, "format").select("format", "error", "rows")
    bad = detect.detect_format(spark, f"{folder}/bad").select("format", "error", F.lit(0).cast("bigint").alias("rows"))
    return good.unionByName(bad)


@query("read_messages_back", "SELECT event_type AS kind, count(*) AS n FROM events GROUP BY 1")
def read_messages_back(spark, sf_dir):
    folder = m.work_folder(spark)
    m.event_messages(spark, sf_dir).write.mode("overwrite").parquet(folder)
    back = envelopes.subject_filter(envelopes.read_messages(spark, folder), "events.*.*")
    return back.groupBy(F.split("subject", "[.]")[1].alias("kind")).agg(F.count(F.lit(1)).alias("n"))


# Sinks


@query(
    "write_routed",
    f"""SELECT 'events.' || event_type AS table_name, count(*) AS rows,
          CAST(sum({NS.format('ts')} // 1000000000) AS BIGINT) AS seconds
        FROM events GROUP BY 1""",
)
def write_routed(spark, sf_dir):
    folder = m.work_folder(spark)
    rows = Pipeline(event_spec()).transform(m.event_messages(spark, sf_dir))
    sinks.write_routed(rows, folder, "overwrite")
    seconds = F.call_function("div", F.col("ts_ns"), F.lit(1_000_000_000))
    return sinks.read_routed(spark, folder).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(seconds).alias("seconds")
    )


@query(
    "write_routed_numbers",
    """SELECT lpad(CAST(o_custkey % 50 AS VARCHAR), 3, '0') AS table_name, count(*) AS rows,
         count(*) FILTER (WHERE o_orderkey % 2 = 0) AS both_set, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1""",
)
def write_routed_numbers(spark, sf_dir):
    """Tables named by digits, from bodies whose keys differ only by case."""
    folder = m.work_folder(spark)
    orders = m.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    body = F.to_json(
        F.struct(
            key.alias("value"), F.when(key % 2 == 0, F.col("o_orderstatus")).alias("status"),
            F.lpad((F.col("o_custkey") % 50).cast("string"), 3, "0").alias("table"), m.iso("o_orderdate").alias("ts"),
        )
    )
    # Another key of the same letters, which a body may hold beside the first.
    body = F.regexp_replace(body, "^[{]", '{"Value":"upper",')
    messages = m.envelope(orders, F.lit("orders.all"), key, m.utc("o_orderdate"), body)
    spec = {
        "output": columns(number="int64", label="string", status="string"),
        "transformations": [
            step("parse_json"),
            field("value", "number", "int64"),
            field("Value", "label", "string"),
            step("extract_table", source="table"),
            step("extract_index", source="ts"),
        ],
    }
    sinks.write_routed(Pipeline(spec).transform(messages), folder, "overwrite")
    back = sinks.read_routed(spark, folder).filter("label = 'upper'")
    return back.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count("status").alias("both_set"), F.sum("number").alias("keys")
    )


def resent(spark, sf_dir):
    """Routed event rows, clicks delivered twice."""
    rows = m.table(spark, sf_dir, "events").select(
        F.concat(F.lit("events."), "event_type").alias("table_name"),
        timestamps.timestamp_to_ns(m.utc("ts")).alias("ts_ns"),
        F.col("event_id").alias("sequence"),
        "user_id",
        "value",
    )
    return rows.unionByName(rows.filter("table_name = 'events.click'"))


@query(
    "dedup_drop",
    f"""SELECT 'events.' || event_type AS table_name, {NS.format('ts')} AS ts_ns, event_id AS sequence,
          user_id, value FROM events""",
)
def dedup_drop(spark, sf_dir):
    return sinks.dedup(resent(spark, sf_dir), "drop")


@query(
    "dedup_upsert",
    """SELECT 'hour' AS table_name, epoch_us(date_trunc('hour', ts)) * 1000 AS ts_ns, user_id,
         max(event_id) AS sequence, arg_max(value, event_id) AS value
       FROM events GROUP BY 2, 3""",
)
def dedup_upsert(spark, sf_dir):
    hourly = m.table(spark, sf_dir, "events").select(
        F.lit("hour").alias("table_name"),
        timestamps.timestamp_to_ns(F.date_trunc("hour", m.utc("ts"))).alias("ts_ns"),
        "user_id",
        F.col("event_id").alias("sequence"),
        "value",
    )
    return sinks.dedup(hourly.unionByName(hourly), "upsert", ["user_id"])


@query(
    "write_csv",
    """SELECT 'events.' || event_type AS table_name, count(*) AS rows, round(sum(value), 2) AS total
       FROM events GROUP BY 1""",
)
def write_csv(spark, sf_dir):
    folder = m.work_folder(spark)
    rows = Pipeline(event_spec()).transform(m.event_messages(spark, sf_dir))
    stored = os.path.join(folder, "rows")
    sinks.write_routed(rows, stored, "overwrite")
    folder = os.path.join(folder, "csv")
    sinks.write_csv(sinks.read_routed(spark, stored), folder)
    layout = "ts_ns bigint, sequence bigint, kind string, k bigint, value double, user string, tag string, table_name string"
    back = spark.read.schema(layout).csv(folder, header=True)
    return back.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("value"), 2).alias("total")
    )


@query(
    "write_csv_cells",
    f"""SELECT event_type AS table_name, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS place,
          {NS.format('ts')} AS ts_ns, event_id AS sequence, user_id, value FROM events""",
)
def write_csv_cells(spark, sf_dir):
    """Every cell of the CSV files, with its place in the order of files and lines."""
    folder = m.work_folder(spark)
    rows = m.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("table_name"), timestamps.timestamp_to_ns(m.utc("ts")).alias("ts_ns"),
        F.col("event_id").alias("sequence"), "user_id", "value",
    )
    sinks.write_csv(rows, folder)
    layout = "ts_ns bigint, sequence bigint, user_id bigint, value double, table_name string"
    back = spark.read.schema(layout).csv(folder, header=True)
    # A file's first line says where the file belongs; lines keep their order inside it.
    line = F.struct(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line"))
    lines_read = back.select("*", line.alias("at"))
    order = Window.partitionBy("table_name").orderBy("at.file", "at.line")
    return lines_read.withColumn("place", F.row_number().over(order).cast("bigint")).drop("at")


@query(
    "quarantine_reread",
    FLAWED + """ SELECT event_id AS sequence, 'events.' || event_type || '.' || user_id AS subject,
         CAST(CASE event_type WHEN 'purchase' THEN 2 ELSE 1 END AS BIGINT) AS n_errors
       FROM o WHERE outcome <> 'ok'""",
)
def quarantine_reread(spark, sf_dir):
    folder = m.work_folder(spark)
    parsed = flawed_pipeline("fail").parse(m.flawed_event_messages(spark, sf_dir))
    sinks.write_quarantine(apply_policy(parsed, "fail").sent_back, folder)
    # Reprocessing reads the envelope only; the same messages fail again.
    again = flawed_pipeline("fail").parse(envelopes.read_messages(spark, folder))
    sent_back = apply_policy(again, "fail").sent_back
    return sent_back.select("sequence", "subject", F.size("errors").cast("bigint").alias("n_errors"))


# Statistics

BOUNDS = exp_buckets(1.0, 2.0, 8)
LAG_DAYS = """(SELECT greatest(CAST(epoch_us(l_shipdate) - epoch_us(o_orderdate) AS DOUBLE) / 86400000000.0, 0.0) AS v
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
BOUND_LIST = ", ".join(str(b) for b in BOUNDS)


def ship_lags(spark, sf_dir, *keep):
    """Days from order to shipment; both tables meet on the order key."""
    lineitem = m.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", *keep)
    orders = m.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    days = (F.unix_micros(m.utc("l_shipdate")) - F.unix_micros(m.utc("o_orderdate"))) / 86400e6
    return joined.select(days.alias("lag"), *keep)


@query(
    "lag_histogram",
    f"""SELECT le, count(*) FILTER (WHERE v <= le) AS cumulative, round(sum(v), 2) AS total
        FROM {LAG_DAYS}, (SELECT CAST(unnest([{BOUND_LIST}, 'inf'::DOUBLE]) AS DOUBLE) AS le) GROUP BY 1""",
)
def lag_histogram(spark, sf_dir):
    rows = stats.histogram(ship_lags(spark, sf_dir), F.col("lag"), BOUNDS)
    return rows.withColumn("total", F.round("total", 2))


@query(
    "lag_quantiles",
    f"""WITH h AS (SELECT le, count(*) FILTER (WHERE v <= le) AS up
          FROM {LAG_DAYS}, (SELECT CAST(unnest([{BOUND_LIST}, 'inf'::DOUBLE]) AS DOUBLE) AS le) GROUP BY 1),
        b AS (SELECT le, up, coalesce(lag(up) OVER (ORDER BY le), 0) AS below,
          coalesce(lag(le) OVER (ORDER BY le), 0) AS low, max(up) OVER () AS total FROM h),
        q AS (SELECT unnest([0.5, 0.9, 0.99]) AS q)
        SELECT CAST(q AS DOUBLE) AS q, round(arg_min(CASE WHEN isinf(le) THEN low
            ELSE low + (le - low) * (q * total - below) / (up - below) END, le), 6) AS quantile
        FROM b, q WHERE up > below AND up >= q * total GROUP BY q""",
)
def lag_quantiles(spark, sf_dir):
    h = stats.histogram(ship_lags(spark, sf_dir), F.col("lag"), BOUNDS).withColumn("of", F.lit("all"))
    found = [
        stats.bucket_quantile(h, q, ["of"]).select(F.lit(q).alias("q"), F.round("quantile", 6).alias("quantile"))
        for q in (0.5, 0.9, 0.99)
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


def value_snapshots(spark, sf_dir):
    """Cumulative histograms of the event value at the end of every day, per event kind.

    A day's increments are counted first; the running totals add few rows per kind.
    """
    from pyspark.sql import Window

    events = m.table(spark, sf_dir, "events").select(
        "event_type", F.datediff(m.utc("ts"), F.lit("2024-01-01")).cast("bigint").alias("day"), "value"
    )
    daily = stats.histogram(events, F.col("value"), BOUNDS, ["event_type", "day"])
    upto = Window.partitionBy("event_type", "le").orderBy("day")
    return daily.select("event_type", F.col("day").alias("snapshot_id"), "le",
                        F.sum("cumulative").over(upto).alias("cumulative"))


DAILY = f"""WITH d AS (SELECT event_type, date_diff('day', TIMESTAMP '2024-01-01', ts) AS snapshot_id, value FROM events),
  e AS (SELECT CAST(unnest([{BOUND_LIST}, 'inf'::DOUBLE]) AS DOUBLE) AS le),
  c AS (SELECT event_type, snapshot_id, le, count(*) FILTER (WHERE value <= le) AS up FROM d, e GROUP BY ALL),
  n AS (SELECT event_type, snapshot_id, le,
      up - coalesce(lag(up) OVER (PARTITION BY event_type, snapshot_id ORDER BY le), 0) AS n,
      up, coalesce(lag(up) OVER (PARTITION BY event_type, snapshot_id ORDER BY le), 0) AS below,
      coalesce(lag(le) OVER (PARTITION BY event_type, snapshot_id ORDER BY le), 0) AS low,
      max(up) OVER (PARTITION BY event_type, snapshot_id) AS total
    FROM c WHERE (event_type, snapshot_id) NOT IN (SELECT (event_type, min(snapshot_id)) FROM d GROUP BY event_type))"""


@query("histogram_delta", DAILY + " SELECT event_type, snapshot_id, le, n FROM n")
def histogram_delta(spark, sf_dir):
    return stats.histogram_delta(value_snapshots(spark, sf_dir), ["event_type"])


@query(
    "lag_summary",
    DAILY + """, p AS (SELECT event_type, snapshot_id, q, arg_min(CASE WHEN isinf(le) THEN low
          ELSE low + (le - low) * (q * total - below) / (up - below) END, le) AS v
        FROM n, (SELECT unnest([0.5, 0.99]) AS q) WHERE n > 0 AND up >= q * total GROUP BY ALL)
      SELECT n.event_type, n.snapshot_id, max(total) AS samples,
        round(max(a.v), 6) AS p50, round(max(b.v), 6) AS p99,
        least(max(CASE WHEN n > 0 THEN le END), 128.0) AS max_le
      FROM n JOIN p a ON a.event_type = n.event_type AND a.snapshot_id = n.snapshot_id AND a.q = 0.5
        JOIN p b ON b.event_type = n.event_type AND b.snapshot_id = n.snapshot_id AND b.q = 0.99
      GROUP BY 1, 2""",
)
def lag_summary(spark, sf_dir):
    summary = stats.lag_summary(value_snapshots(spark, sf_dir), ["event_type"])
    return summary.withColumns({"p50": F.round("p50", 6), "p99": F.round("p99", 6)})


@query(
    "interval_rates",
    """WITH t AS (SELECT event_type AS worker, date_trunc('hour', ts) AS tick, count(*) AS msgs,
          sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS gauge FROM events GROUP BY 1, 2),
        s AS (SELECT worker, tick, sum(msgs) OVER (PARTITION BY worker ORDER BY tick) AS msgs, gauge FROM t),
        l AS (SELECT *, lag(tick) OVER w AS pat, lag(msgs) OVER w AS pmsgs, lag(gauge) OVER w AS pgauge
          FROM s WINDOW w AS (PARTITION BY worker ORDER BY tick))
        SELECT worker, epoch_us(tick) AS at_us, CAST(epoch_us(tick) - epoch_us(pat) AS DOUBLE) / 1e6 AS interval_s,
          round(CAST(msgs - pmsgs AS DOUBLE) / ((epoch_us(tick) - epoch_us(pat)) / 1e6), 9) AS msgs_per_s,
          round(CASE WHEN gauge < pgauge THEN 0
            ELSE CAST(gauge - pgauge AS DOUBLE) / ((epoch_us(tick) - epoch_us(pat)) / 1e6) END, 9) AS gauge_per_s
        FROM l WHERE pat IS NOT NULL""",
)
def interval_rates(spark, sf_dir):
    from pyspark.sql import Window

    events = m.table(spark, sf_dir, "events")
    k = F.try_variant_get(F.parse_json("props"), "$.k", "bigint")
    hourly = events.groupBy(F.col("event_type").alias("worker"), F.date_trunc("hour", m.utc("ts")).alias("at")).agg(
        F.count(F.lit(1)).alias("msgs"), F.sum(k).alias("gauge")
    )
    upto = Window.partitionBy("worker").orderBy("at")
    snapshots = hourly.withColumn("msgs", F.sum("msgs").over(upto))
    rates = stats.interval_rates(snapshots, ["msgs", "gauge"], "at", ["worker"])
    return rates.select(
        "worker",
        F.unix_micros("at").alias("at_us"),
        "interval_s",
        F.round("msgs_per_s", 9).alias("msgs_per_s"),
        F.round("gauge_per_s", 9).alias("gauge_per_s"),
    )


@query("state_counts", "SELECT o_orderstatus AS state, count(*) AS n FROM orders GROUP BY 1")
def state_counts(spark, sf_dir):
    orders = m.table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("state"))
    return stats.state_counts(orders)


@query(
    "reconcile_counts",
    FLAWED + """ SELECT 't.' || event_type AS table_name,
         count(*) FILTER (WHERE outcome <> 'unusable') AS actual, count(*) AS expected,
         count(*) FILTER (WHERE outcome = 'unusable') AS missing
       FROM o GROUP BY 1""",
)
def reconcile_counts(spark, sf_dir):
    rows = flawed_pipeline().transform(m.flawed_event_messages(spark, sf_dir))
    expected = m.table(spark, sf_dir, "events").select(F.concat(F.lit("t."), "event_type").alias("table_name"))
    return stats.reconcile_counts(rows, stats.row_tallies(expected))


USER_TABLES = """(SELECT event_type || '.' || user_id AS table_name, count(*) AS rows, count(DISTINCT event_id) AS msgs
    FROM events GROUP BY 1)"""


@query(
    "top_tables",
    f"""SELECT table_name, rows, msgs, rows / (SELECT sum(rows) FROM {USER_TABLES}) * 100 AS share_pct,
          (SELECT count(*) FROM {USER_TABLES}) AS tables_distinct,
          (SELECT CAST(sum(rows) AS BIGINT) FROM {USER_TABLES}) AS total_rows
        FROM {USER_TABLES} ORDER BY rows DESC, table_name LIMIT 10""",
)
def top_tables(spark, sf_dir):
    return stats.top_tables(user_tallies(spark, sf_dir))


def user_tallies(spark, sf_dir):
    one = F.lit(1).cast("bigint")
    return m.table(spark, sf_dir, "events").select(
        F.concat_ws(".", "event_type", F.col("user_id").cast("string")).alias("table_name"),
        one.alias("rows"), one.alias("msgs"), F.col("event_id").alias("sequence"), m.utc("ts").alias("ts"),
    )


ROLLING = """WITH c AS (SELECT epoch_us(ts) // {width}000000 AS bucket, event_type || '.' || user_id AS table_name,
      count(*) AS rows, min(event_id) AS first_seen FROM events GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY first_seen, table_name) AS place FROM c),
    f AS (SELECT bucket, CASE WHEN place <= {cap} THEN table_name ELSE 'other' END AS table_name,
      sum(rows) AS rows, min(first_seen) AS first_seen FROM r GROUP BY 1, 2),
    w AS (SELECT bucket + s AS window_bucket, table_name, CAST(sum(rows) AS BIGINT) AS rows,
        min(first_seen) AS first_seen
      FROM f, (SELECT unnest([0, 1, 2, 3, 4]) AS s) GROUP BY 1, 2)"""


@query(
    "rolling_table_counts",
    ROLLING.format(width=60, cap=10**15) + " SELECT window_bucket, table_name, rows, rows AS msgs, first_seen FROM w",
)
def rolling_table_counts(spark, sf_dir):
    return rolling.rolling_table_counts(user_tallies(spark, sf_dir), F.col("ts"))


@query(
    "rolling_overflow",
    ROLLING.format(width=3600, cap=3) + " SELECT window_bucket, table_name, rows, rows AS msgs, first_seen FROM w",
)
def rolling_overflow(spark, sf_dir):
    return rolling.rolling_table_counts(user_tallies(spark, sf_dir), F.col("ts"), 3600, max_distinct=3)


@query(
    "stream_bucket_counts",
    """SELECT epoch_us(ts) // 3600000000 AS bucket, event_type || '.' || user_id AS table_name,
         count(*) AS rows, count(*) AS msgs, min(event_id) AS first_seen FROM events GROUP BY 1, 2""",
)
def stream_bucket_counts(spark, sf_dir):
    """Tallies in an order that has nothing to do with time, many of them late."""
    folder = m.work_folder(spark)
    inbox, sink = os.path.join(folder, "inbox"), os.path.join(folder, "sink")
    tallies = user_tallies(spark, sf_dir)
    tallies.repartition(4, F.xxhash64("sequence")).write.mode("overwrite").parquet(inbox)
    stream = spark.readStream.schema(tallies.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    rolling.stream_bucket_counts(stream, sink, os.path.join(folder, "checkpoint"), "ts", 3600).awaitTermination()
    return rolling.read_bucket_counts(spark, sink)


@query(
    "window_report",
    ROLLING.format(width=3600, cap=10**15)
    + """, p AS (SELECT *, row_number() OVER (PARTITION BY window_bucket ORDER BY rows DESC, table_name) AS place,
          sum(rows) OVER (PARTITION BY window_bucket) AS total, count(*) OVER (PARTITION BY window_bucket) AS tables
        FROM w)
        SELECT window_bucket, place, table_name, rows, rows AS msgs, rows / total * 100 AS share_pct,
          tables AS tables_distinct, CAST(total AS BIGINT) AS total_rows FROM p WHERE place <= 10""",
)
def window_report(spark, sf_dir):
    window = rolling.rolling_table_counts(user_tallies(spark, sf_dir), F.col("ts"), 3600)
    return rolling.window_report(window).withColumn("place", F.col("place").cast("bigint"))


LIVE = """WITH o AS (SELECT event_id % 4 AS batch, event_type AS name, event_id, count(*) OVER () AS c FROM events),
    b AS (SELECT batch, name, count(*) AS rows, row_number() OVER (PARTITION BY batch ORDER BY min(event_id), name) AS r FROM o GROUP BY 1, 2),
    f AS (SELECT batch, CASE WHEN r <= 3 THEN name ELSE 'other' END AS name, sum(rows) AS rows FROM b GROUP BY 1, 2),
    w AS (SELECT t.n AS batch, name AS table_name, sum(rows) AS rows FROM range(4) AS t(n) JOIN f ON f.batch BETWEEN t.n - 2 AND t.n GROUP BY 1, 2)"""


@query(
    "live_window_reports",
    LIVE + """, p AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY rows DESC, table_name) AS place,
          sum(rows) OVER (PARTITION BY batch) AS total, count(*) FILTER (WHERE table_name <> 'other') OVER (PARTITION BY batch) AS tables FROM w)
        SELECT batch, 100 + 2 * batch AS window_bucket, place::INTEGER AS place, table_name, rows::BIGINT AS rows, rows::BIGINT AS msgs,
          rows / total * 100 AS share_pct, tables AS tables_distinct, total::BIGINT AS total_rows FROM p WHERE place <= 2""",
)
def live_window_reports(spark, sf_dir):
    """Four batches two minutes apart by the clock; a bucket keeps the three names that came first."""
    folder = m.work_folder(spark)
    inbox, sink, checkpoint = (os.path.join(folder, x) for x in ("inbox", "sink", "checkpoint"))
    one = F.lit(1).cast("bigint")
    tallies = m.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("table_name"), one.alias("rows"), one.alias("msgs"), F.col("event_id").alias("sequence")
    )
    for part in range(4):
        tallies.filter(F.col("sequence") % 4 == part).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(tallies.schema).parquet(inbox)
        clock = lambda part=part: 60.0 * (100 + 2 * part) + 30
        live.stream_window_reports(stream, sink, checkpoint, clock, n=2, max_distinct=3).awaitTermination()
    return live.read_reports(spark, sink)


HISTOGRAM_SQL = """WITH o AS (SELECT event_id % 3 AS batch, greatest(1800000000.0 - epoch_us(ts) / 1e6, 0) AS lag FROM events),
    n AS (SELECT batch, count(*) AS size FROM o GROUP BY 1)
    SELECT t.n AS snapshot_id, 'lag' AS kind, le, count(*) FILTER (WHERE lag <= le) AS cumulative
    FROM range(3) AS t(n), (SELECT unnest(list_transform(range(20), lambda i: 0.001 * 2 ** i) || ['inf'::DOUBLE]) AS le), o
    WHERE batch <= t.n GROUP BY ALL
    UNION ALL SELECT t.n, 'batch_size', le, count(*) FILTER (WHERE size <= le)
    FROM range(3) AS t(n), (SELECT unnest(list_transform(range(12), lambda i: 2.0 ** i) || ['inf'::DOUBLE]) AS le), n
    WHERE batch <= t.n GROUP BY ALL"""


@query("stream_histograms", HISTOGRAM_SQL)
def stream_histograms(spark, sf_dir):
    """Lag and batch size after each of three batches."""
    folder = m.work_folder(spark)
    inbox, sink, checkpoint = (os.path.join(folder, x) for x in ("inbox", "sink", "checkpoint"))
    messages = m.event_messages(spark, sf_dir)
    for part in range(3):
        messages.filter(F.col("sequence") % 3 == part).write.mode("append").parquet(inbox)
        stream = envelopes.read_messages(spark, inbox, streaming=True)
        live.stream_histograms(stream, sink, checkpoint, lambda: 1_800_000_000.0).awaitTermination()
    kinds = [live.read_histograms(spark, sink, k).withColumn("kind", F.lit(k)).drop("total") for k in ("lag", "batch_size")]
    return kinds[0].unionByName(kinds[1])


# Comparison


def altered_orders(spark, sf_dir):
    """Orders with urgent prices nudged, some statuses changed, cancelled priority missing, one status doubled."""
    orders = m.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    urgent, low = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "5-LOW"
    price = F.when(urgent, F.col("o_totalprice") + 0.0005).when(low, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    altered = orders.withColumn("o_totalprice", price)
    altered = altered.withColumn("o_orderstatus", F.when(low, "X").otherwise(F.col("o_orderstatus")))
    kept = altered.filter("o_orderpriority <> '3-MEDIUM'")
    extra = altered.filter(urgent).withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return orders, kept.unionByName(extra).unionByName(altered.filter("o_orderpriority = '2-HIGH'"))


@query(
    "compare_tables",
    """SELECT 'value' AS issue, c AS column_name, count(*) AS n
         FROM orders, (SELECT unnest(['o_orderstatus', 'o_totalprice']) AS c)
         WHERE o_orderpriority = '5-LOW' GROUP BY c
       UNION ALL SELECT 'missing', NULL, count(*) FROM orders WHERE o_orderpriority = '3-MEDIUM'
       UNION ALL SELECT 'extra', NULL, count(*) FROM orders WHERE o_orderpriority = '1-URGENT'
       UNION ALL SELECT 'duplicate', NULL, count(*) FROM orders WHERE o_orderpriority = '2-HIGH'""",
)
def compare_orders(spark, sf_dir):
    golden, actual = altered_orders(spark, sf_dir)
    return comparison_summary(compare_tables(actual, golden, ["o_orderkey"]))


@query(
    "compare_repeated",
    """WITH o AS (SELECT l_orderkey, count(*) AS n, bool_or(l_linenumber = 1) AS one FROM lineitem GROUP BY 1)
       SELECT 'rows' AS issue, NULL AS column_name, count(*) AS n FROM o WHERE n > 1 AND one
       UNION ALL SELECT 'value', 'l_quantity', count(*) FROM o WHERE n = 1 AND one
       UNION ALL SELECT 'column', 'note', 1 UNION ALL SELECT 'column', 'l_tax', 1""",
)
def compare_repeated(spark, sf_dir):
    """Lines by order, so keys repeat: first lines change, quantities are text, a column goes and one comes."""
    lineitem = m.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("string").alias("l_quantity"), "l_tax"
    )
    changed = F.when(F.col("l_linenumber") == 1, (F.col("l_quantity").cast("double") + 1000).cast("string"))
    actual = lineitem.drop("l_tax").withColumns({"l_quantity": F.coalesce(changed, "l_quantity"), "note": F.lit("x")})
    return comparison_summary(compare_tables(actual, lineitem, ["l_orderkey"]))


# Streams


@query(
    "ingest_stream",
    FLAWED + """ SELECT 't.' || event_type AS table_name, count(*) AS rows,
         round(coalesce(sum(CASE WHEN outcome = 'ok' THEN value END), 0), 2) AS total
       FROM o WHERE outcome <> 'unusable' GROUP BY 1""",
)
def ingest_stream(spark, sf_dir):
    folder = m.work_folder(spark)
    inbox, sink = os.path.join(folder, "inbox"), os.path.join(folder, "sink")
    m.flawed_event_messages(spark, sf_dir).write.mode("overwrite").parquet(inbox)
    messages = envelopes.read_messages(spark, inbox, streaming=True)
    query = ingest.ingest_stream(flawed_pipeline(), messages, sink, os.path.join(folder, "checkpoint"))
    query.awaitTermination()
    # Every message is delivered once more, in a later batch.
    m.flawed_event_messages(spark, sf_dir).write.mode("append").parquet(inbox)
    again = ingest.ingest_stream(flawed_pipeline(), messages, sink, os.path.join(folder, "checkpoint"))
    again.awaitTermination()
    return ingest.read_tables(spark, sink).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.coalesce(F.sum("amount"), F.lit(0.0)), 2).alias("total")
    )


@query(
    "ingest_stream_fail",
    FLAWED + """ SELECT 'table' AS side, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM o WHERE outcome = 'ok'
       UNION ALL SELECT 'quarantine', 2 * count(*), CAST(2 * sum(event_id) AS BIGINT) FROM o WHERE outcome <> 'ok'""",
)
def ingest_stream_fail(spark, sf_dir):
    """Two deliveries under ``fail``: good messages count once, the others are sent back twice."""
    folder = m.work_folder(spark)
    inbox, sink = os.path.join(folder, "inbox"), os.path.join(folder, "sink")
    for mode in ("overwrite", "append"):
        m.flawed_event_messages(spark, sf_dir).write.mode(mode).parquet(inbox)
        messages = envelopes.read_messages(spark, inbox, streaming=True)
        query = ingest.ingest_stream(flawed_pipeline("fail"), messages, sink, os.path.join(folder, "checkpoint"))
        query.awaitTermination()
    good = ingest.read_tables(spark, sink).select(F.lit("table").alias("side"), "sequence")
    back = envelopes.read_messages(spark, os.path.join(sink, "quarantine"))
    bad = back.select(F.lit("quarantine").alias("side"), "sequence")
    return good.unionByName(bad).groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("sequence").alias("ids"))


def hourly_pipeline() -> Pipeline:
    """The latest value of a user in an hour."""
    return Pipeline({
        "output": columns(user="int64", value="double"),
        "transformations": [
            step("parse_json"),
            field("user_id", "user", "int64"),
            field("value", "value", "float64"),
            step("extract_table", value="hour"),
            step("extract_index", source="hour"),
        ],
    })


def hourly_messages(spark, sf_dir):
    hour = F.date_format(F.date_trunc("hour", m.utc("ts")), m.ISO).alias("hour")
    return m.event_messages(spark, sf_dir, F.to_json(F.struct(hour, "user_id", "value")))


def upsert_sink(spark, sf_dir) -> str:
    """Three batches that update each other, in no order of sequence."""
    folder = m.work_folder(spark)
    inbox, sink = os.path.join(folder, "inbox"), os.path.join(folder, "sink")
    hourly_messages(spark, sf_dir).repartition(3, F.xxhash64("sequence")).write.parquet(inbox)
    messages = envelopes.read_messages(spark, inbox, streaming=True, files_per_trigger=1)
    checkpoint = os.path.join(folder, "checkpoint")
    ingest.ingest_stream(hourly_pipeline(), messages, sink, checkpoint, dedup_mode="upsert", upsert_keys=("user",)).awaitTermination()
    return sink


UPSERT_SQL = """SELECT 'hour' AS table_name, epoch_us(date_trunc('hour', ts)) * 1000 AS ts_ns, user_id AS "user",
    max(event_id) AS sequence, arg_max(value, event_id) AS value FROM events GROUP BY 2, 3"""


@query("ingest_stream_upsert", UPSERT_SQL)
def ingest_stream_upsert(spark, sf_dir):
    """The rows of a sink as its batches have left them, merged when read."""
    return ingest.read_latest(spark, upsert_sink(spark, sf_dir), ["user"])


@query("compacted_upsert", UPSERT_SQL)
def compacted_upsert(spark, sf_dir):
    """The same rows after compaction, as they are stored."""
    sink = upsert_sink(spark, sf_dir)
    sinks.compact_tables(spark, sink, ["user"])
    return ingest.read_tables(spark, sink).drop("batch")


def failing_sink(spark, sf_dir) -> str:
    """Even events arrive while the sink is down, then odd ones, then what was sent back."""
    folder = m.work_folder(spark)
    inbox, sink = os.path.join(folder, "inbox"), os.path.join(folder, "sink")
    calls = []

    def write(rows, path):
        calls.append(path)
        if len(calls) == 1:
            raise OSError("the sink is down")
        return ingest.write_tables(rows, path)

    def run():
        messages = envelopes.read_messages(spark, inbox, streaming=True)
        checkpoint = os.path.join(folder, "checkpoint")
        ingest.ingest_stream(flawed_pipeline("fail"), messages, sink, checkpoint, write_rows=write).awaitTermination()

    events = m.flawed_event_messages(spark, sf_dir)
    for part in (0, 1):
        events.filter(F.col("sequence") % 2 == part).write.mode("append").parquet(inbox)
        run()
    envelopes.read_messages(spark, os.path.join(sink, "quarantine", "batch=0")).write.mode("append").parquet(inbox)
    run()
    return sink


@query(
    "failed_batch_counters",
    FLAWED + """, b AS (
          SELECT 0 AS batch, outcome, event_id FROM o WHERE event_id % 2 = 0 UNION ALL
          SELECT 1, outcome, event_id FROM o WHERE event_id % 2 = 1 UNION ALL
          SELECT 2, outcome, event_id FROM o WHERE event_id % 2 = 0)
        SELECT CAST(batch AS VARCHAR) AS batch, count(*) AS fetched, count(*) FILTER (WHERE outcome = 'ok') AS processed,
          count(*) FILTER (WHERE outcome <> 'ok') AS parse_failures,
          CASE batch WHEN 0 THEN 0 ELSE count(*) FILTER (WHERE outcome = 'ok') END AS rows_written,
          CASE batch WHEN 0 THEN 0 ELSE count(*) FILTER (WHERE outcome = 'ok') END AS acks,
          CASE batch WHEN 0 THEN count(*) ELSE count(*) FILTER (WHERE outcome <> 'ok') END AS nacks,
          CAST(batch = 0 AS BIGINT) AS write_failures FROM b GROUP BY batch""",
)
def failed_batch_counters(spark, sf_dir):
    """Counters after the write: a batch that could not be written is sent back as a whole."""
    return ingest.read_commits(spark, failing_sink(spark, sf_dir)).drop("stages", "dropped", "zero_rows")


@query(
    "failed_batch_rows",
    FLAWED + """ SELECT 'table' AS side, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM o WHERE outcome = 'ok'
        UNION ALL SELECT 'quarantine ' || batch, count(*), CAST(sum(event_id) AS BIGINT) FROM (
          SELECT 0 AS batch, event_id FROM o WHERE event_id % 2 = 0 UNION ALL
          SELECT 1 + n, event_id FROM o, range(2) AS t(n) WHERE outcome <> 'ok' AND event_id % 2 = 1 - n) GROUP BY batch""",
)
def failed_batch_rows(spark, sf_dir):
    """Every good message ends in a table once, though its batch failed before."""
    sink = failing_sink(spark, sf_dir)
    good = ingest.read_tables(spark, sink).select(F.lit("table").alias("side"), "sequence")
    back = spark.read.schema("sequence bigint, batch string").parquet(os.path.join(sink, "quarantine"))
    both = good.unionByName(back.select(F.concat(F.lit("quarantine "), "batch").alias("side"), "sequence"))
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("sequence").alias("ids"))


@query(
    "stream_stage_counts",
    FLAWED + """ SELECT unnest(['parse', 'write', 'quarantine', 'commit']) AS stage,
          unnest([count(*), count(*) FILTER (WHERE outcome = 'ok'), count(*) FILTER (WHERE outcome <> 'ok'),
            count(*) FILTER (WHERE outcome = 'ok')]) AS n FROM o""",
)
def stream_stage_counts(spark, sf_dir):
    """What the observers of every stage have counted, over three batches."""
    folder = m.work_folder(spark)
    inbox, sink = os.path.join(folder, "inbox"), os.path.join(folder, "sink")
    m.flawed_event_messages(spark, sf_dir).repartition(3, F.xxhash64("sequence")).write.parquet(inbox)
    messages = envelopes.read_messages(spark, inbox, streaming=True, files_per_trigger=1)
    ingest.ingest_stream(flawed_pipeline("fail"), messages, sink, os.path.join(folder, "checkpoint")).awaitTermination()
    return ingest.read_stages(spark, sink).groupBy("stage").agg(F.sum("count").alias("n"))


@query(
    "ingest_stream_unsequenced",
    """SELECT 'events.' || event_type AS table_name, count(*) AS rows, count(DISTINCT event_id) AS events, round(sum(value), 2) AS total
       FROM events GROUP BY 1""",
)
def ingest_stream_unsequenced(spark, sf_dir):
    """Messages without a sequence, all at one time, in two batches and then all again."""
    folder = m.work_folder(spark)
    inbox, sink = os.path.join(folder, "inbox"), os.path.join(folder, "sink")
    body = F.to_json(F.struct(F.lit("2024-05-01T00:00:00Z").alias("ts"), "event_id", "event_type", "value"))
    events = m.event_messages(spark, sf_dir, body)
    pipeline = Pipeline({
        "output": columns(event="int64", value="double"),
        "transformations": [
            step("parse_json"), field("event_id", "event", "int64"), field("value", "value", "float64"),
            field("event_type", "kind", "string"), compute("concat", "table", fields=['"events."', "kind"]),
            step("extract_table", source="table"), step("extract_index", source="ts"),
        ],
    })
    nameless = events.withColumn("sequence", F.lit(None).cast("bigint"))
    for part in (nameless.filter("crc32(payload) % 2 = 0"), nameless.filter("crc32(payload) % 2 = 1"), nameless):
        part.write.mode("append").parquet(inbox)
        messages = envelopes.read_messages(spark, inbox, streaming=True)
        ingest.ingest_stream(pipeline, messages, sink, os.path.join(folder, "checkpoint")).awaitTermination()
    return ingest.read_tables(spark, sink).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("event").alias("events"), F.round(F.sum("value"), 2).alias("total")
    )


@query(
    "routed_added_columns",
    """SELECT 'events.' || event_type AS table_name, event_id AS sequence, value,
         CASE WHEN event_id % 3 > 0 THEN user_id END AS user_id, CASE WHEN event_id % 3 > 1 THEN event_type END AS kind FROM events""",
)
def routed_added_columns(spark, sf_dir):
    """Three writes to one sink, each with a column more."""
    folder = m.work_folder(spark)
    events = m.table(spark, sf_dir, "events").select(
        F.concat(F.lit("events."), "event_type").alias("table_name"), F.col("event_id").alias("sequence"), "value",
        "user_id", F.col("event_type").alias("kind"),
    )
    for part, gone in ((0, ["user_id", "kind"]), (1, ["kind"]), (2, [])):
        sinks.write_routed(events.filter(F.col("sequence") % 3 == part).drop(*gone), folder)
    return sinks.read_routed(spark, folder)


@query(
    "dedup_stream",
    "SELECT 'events.' || event_type AS table_name, count(*) AS rows FROM events GROUP BY 1",
)
def dedup_stream(spark, sf_dir):
    folder = m.work_folder(spark)
    inbox, out = os.path.join(folder, "inbox"), os.path.join(folder, "out")
    rows = resent(spark, sf_dir).withColumn("ts", timestamps.ns_to_timestamp(F.col("ts_ns")))
    rows.write.mode("overwrite").parquet(inbox)
    stream = spark.readStream.schema(rows.schema).parquet(inbox)
    unique = ingest.dedup_stream(stream)
    writer = unique.writeStream.format("parquet").option("path", out)
    writer = writer.option("checkpointLocation", os.path.join(folder, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return stats.row_tallies(spark.read.parquet(out))


@query(
    "unique_stream",
    "SELECT 'events.' || event_type AS table_name, count(*) AS rows FROM events GROUP BY 1",
)
def unique_stream(spark, sf_dir):
    """Batches that bring rows again, early and late, into a sink that knows them all."""
    folder = m.work_folder(spark)
    inbox, sink = os.path.join(folder, "inbox"), os.path.join(folder, "out")
    rows = resent(spark, sf_dir)
    late = F.crc32(F.col("sequence").cast("string")) % 3 == 0
    for part in (rows.filter(~late), rows, rows.filter(late)):
        part.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(rows.schema).parquet(inbox)
        unique.unique_stream(stream, sink, os.path.join(folder, "checkpoint")).awaitTermination()
    return stats.row_tallies(unique.read_unique(spark, sink))
