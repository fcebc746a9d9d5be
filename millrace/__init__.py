"""Declarative message ingest on Spark."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Arrow functions travel to the executors with their code, so a job does not need
# the package installed on every machine.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
