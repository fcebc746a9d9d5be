import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("MILLRACE_DRIVER_MEMORY", "4g")
    session = local_session(4, "tests")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column on a single row."""
    return lambda column: spark.range(1).select(column.alias("v")).first()["v"]


@pytest.fixture
def messages(spark):
    """Envelopes from payload texts or bytes."""

    def build(payloads, subject="a.b.c"):
        rows = [
            (subject, i, None if p is None else bytearray(p if isinstance(p, bytes) else p.encode()))
            for i, p in enumerate(payloads)
        ]
        return spark.createDataFrame(rows, "subject string, sequence bigint, payload binary")

    return build


@pytest.fixture
def run(messages):
    """Parse payloads with steps; returns one row per message in order."""
    from millrace.plans.pipeline import Pipeline

    def go(payloads, steps, columns, filters=None, table=True, subject="a.b.c"):
        spec = {
            "output": {"columns": [{"name": n, "type": t} for n, t in columns.items()]},
            "transformations": list(steps) + ([("extract_table", {"value": "t"})] if table else []),
            "filters": filters or {},
        }
        spec["transformations"] = [
            {"step": s[0], "config": s[1]} if isinstance(s, tuple) else s for s in spec["transformations"]
        ]
        explode = [s for s in spec["transformations"] if s["step"] == "explode"]
        rest = [s for s in spec["transformations"] if s["step"] != "explode"]
        spec["transformations"] = rest + explode
        pipeline = Pipeline(spec)
        parsed = pipeline.parse(messages(payloads, subject))
        go.pipeline, go.parsed = pipeline, parsed
        return parsed.orderBy("sequence").collect()

    return go
