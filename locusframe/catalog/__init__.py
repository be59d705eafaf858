"""Registered queries: one per operator key of SURVEY §2.

Each entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` built
from the library's operators with, where the operator is SQL-expressible,
an independent DuckDB SQL text over the same base tables (fixture views
inlined).  Keys without SQL are checked by property tests instead.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from locusframe.fixtures import oracle


@dataclass(frozen=True)
class QuerySpec:
    key: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, QuerySpec] = {}

_MODULES = ("sources", "filters", "joins", "aggregates", "windows", "sets",
            "scalars", "reshape", "cohort", "streams")


def register(key: str, sql: str | None = None):
    """Decorator: register ``fn`` under ``key`` with optional oracle SQL."""

    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = QuerySpec(key, fn, oracle(sql) if sql else None)
        return fn

    return deco


def load_all() -> dict[str, QuerySpec]:
    for m in _MODULES:
        try:
            importlib.import_module(f"locusframe.catalog.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"locusframe.catalog.{m}":
                raise
    return REGISTRY
