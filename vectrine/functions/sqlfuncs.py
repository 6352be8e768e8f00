"""The vector functions under their SQL names, and SQL text over DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PRODUCT = "(x, y) -> cast(x as double) * cast(y as double)"
_SQUARE_SUM = "(acc, x) -> acc + cast(x as double) * cast(x as double)"
_SUM = "(acc, x) -> acc + x"

SQL_FUNCTIONS = {
    "l2_distance": (
        "a array<float>, b array<float>",
        f"sqrt(aggregate(zip_with(a, b, (x, y) -> cast(x as double) - cast(y as double)), 0d, {_SQUARE_SUM}))",
    ),
    "cosine_distance": (
        "a array<float>, b array<float>",
        f"1d - try_divide(aggregate(zip_with(a, b, {_PRODUCT}), 0d, {_SUM}), "
        f"sqrt(aggregate(a, 0d, {_SQUARE_SUM})) * sqrt(aggregate(b, 0d, {_SQUARE_SUM})))",
    ),
    "inner_product": (
        "a array<float>, b array<float>",
        f"aggregate(zip_with(a, b, {_PRODUCT}), 0d, {_SUM})",
    ),
    "hamming_bool_distance": (
        "a array<boolean>, b array<boolean>",
        f"aggregate(zip_with(a, b, (x, y) -> cast(x <> y as double)), 0d, {_SUM})",
    ),
}


def register_functions(spark: SparkSession) -> None:
    """Make the distances callable from SQL as temporary SQL functions."""
    for name, (arguments, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS DOUBLE RETURN {body}")


def run_sql(
    spark: SparkSession,
    text: str,
    tables: Mapping[str, DataFrame] | None = None,
    args: Mapping | None = None,
) -> DataFrame:
    """Run SQL text with ``tables`` as views and the distance functions available.

    ``args`` fills the named markers (``:name``) of the text; a list becomes an array.
    The views last for the call: a temporary view of the caller's with the same name
    is back afterwards.
    """
    register_functions(spark)
    tables = tables or {}
    held = {n: spark.table(n) for n in tables if any(t.isTemporary for t in spark.catalog.listTables(pattern=n))}
    values = {n: F.array(*[F.lit(x) for x in v]) if isinstance(v, (list, tuple)) else v for n, v in (args or {}).items()}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(text, args=values) if values else spark.sql(text)
    finally:
        for name in tables:
            if name in held:
                held[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)
