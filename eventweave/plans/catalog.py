"""The registry of driver-table queries: name -> Spark builder and SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import q_analytics, q_cleaning, q_keys, q_published, q_spans, q_survey, q_text  # noqa: F401  (each registers its queries)
from .base import REGISTRY


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.build for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}


def operators_of() -> dict[str, str]:
    return {name: q.operators for name, q in REGISTRY.items()}
