"""Model runs that are built once a session and shared by their readers.

A run is known by the state of its input files (names, sizes, times) and its
parameters. Whoever asks for a run that this session has built gets its stored
tables; changed input or other parameters give another run, and a run whose
tables were dropped is built again. ``session.clear_materialized`` drops runs.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import fields

from pyspark.sql import SparkSession

from ..session import scratch_path, scratch_table
from ..sources.parquet import input_digest
from .models import Models

_RUNS: dict[str, dict[str, str]] = {}  # by application, input and parameters: table names


def shared_run(spark: SparkSession, inputs: list[str], parameters: dict,
               build: Callable[[Callable[[str], str], str], Models]) -> Models:
    """The models of ``inputs`` (paths) and ``parameters``. ``build`` gets a
    function from model names to table names, and a folder for the files."""
    key = json.dumps([spark.sparkContext.applicationId, input_digest(spark, *inputs),
                      sorted(inputs), parameters], sort_keys=True)
    names = _RUNS.get(key)
    if not names or not all(spark.catalog.tableExists(t) for t in names.values()):
        names = {f.name: scratch_table(f.name) for f in fields(Models)}
        build(names.__getitem__, scratch_path(spark, "run"))
        _RUNS[key] = names  # complete: only now do others see it
    return Models(**{model: spark.table(t) for model, t in names.items()})
