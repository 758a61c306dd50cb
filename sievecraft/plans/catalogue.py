"""Every registered query of the library by name, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its own name, and its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


from . import layout_queries, more_queries, page_queries, pair_queries, record_queries, run_queries, small_queries, stream_queries, text_queries  # noqa: E402, F401
