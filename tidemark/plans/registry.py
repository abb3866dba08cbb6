"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and their oracles.

The query modules (``q_*.py``) register themselves on import; ``load_all``
imports every one of them.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

MODULES = ("q_ranking", "q_feed", "q_queue", "q_load", "q_report", "q_stream", "q_commands",
           "q_plan", "q_files")


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"tidemark.plans.{m}")


def queries() -> dict[str, Query]:
    load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(_ORACLES)
