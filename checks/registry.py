"""Registration of a query together with the SQL that has to give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.inputs import comparable
from tripmart.config import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``query(spark, sf_dir)``; without SQL only its rows can be looked at."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(query(use_utc(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register
