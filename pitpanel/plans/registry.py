"""All registered queries of the panel operators, by name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import contracts, evidence, facts, gates, lineage, quality, ranking, rules, scores, sinks, streams, time
from .base import COVERS, QUERIES, SQL

MODULES = (ranking, time, facts, rules, scores, contracts, evidence, sinks, quality, gates, lineage, streams)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def covers() -> dict[str, str]:
    """Which operators each query exercises."""
    return dict(COVERS)
