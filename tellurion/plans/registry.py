"""Named queries with the SQL that states their result independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tellurion.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its checking SQL if there is one."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        name = function.__name__
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check
        return function

    return register
