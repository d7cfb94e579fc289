"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from checks.common import Tables, out

GROUPS = ["features", "feeds", "quality", "evaluation", "charging", "models", "streams"]


def _entries():
    for group in GROUPS:
        yield from import_module(f"checks.{group}").QUERIES.items()


def _bind(build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: out(build(Tables(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(build) for name, (build, _) in _entries()}


def oracle_sql() -> dict[str, str]:
    return {name: text for name, (_, text) in _entries() if text}
