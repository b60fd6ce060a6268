"""The table of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its SQL statement, if SQL can state it."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_u(seed: int | str, *keys: str) -> str:
    """The SQL form of :func:`corpusloom.functions.det.u`."""
    parts = ", ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"(CAST('0x' || substr(md5(concat_ws(':', {parts})), 1, 13) AS BIGINT) / CAST(16 AS DOUBLE) ** 13)"
