"""Registry of the queries and of the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, needs: tuple[str, ...] = ()):
    """Register a query. ``needs`` names the input definitions (``inputs.SQL``) the SQL builds on."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # event times are UTC wall times
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            from tidemark.plans.inputs import with_inputs

            ORACLE[name] = with_inputs(sql, needs)
        return fn

    return add
