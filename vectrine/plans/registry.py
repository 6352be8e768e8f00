"""Registered queries: a Spark callable and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} exists already")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query_vector(spark: SparkSession, folder: str) -> list[float]:
    """The searched-for vector: that of ``vec_id`` 0."""
    row = read(spark, folder, "embeddings").filter("vec_id = 0").select("embedding").first()
    return list(row["embedding"])


# The searched-for vector on the SQL side.
SQL_VECTOR = "(SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)"
DIGITS = 6
