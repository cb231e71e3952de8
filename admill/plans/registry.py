"""Every registered query with its SQL twin."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (spark, sf_dir) under its name, with the SQL that gives the same rows."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


for _name in ("relational", "ordered", "lifecycle", "scalar", "statistics", "similarity", "modelling", "evaluation", "pages"):
    importlib.import_module(f"admill.plans.{_name}")
