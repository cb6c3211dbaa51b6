"""Queries by name, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioflow.catalogue.standins import Tables
from folioflow.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register ``fn(tables)``, under its own name unless another is given; without SQL the check is rows only."""
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(configure(spark), sf_dir))

        key = name or fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql:
            ORACLES[key] = sql.strip()
        return fn

    return register
