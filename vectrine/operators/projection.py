"""Choosing output columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Output = Column | str


def expression(item: Output) -> Column:
    """A Column as it is, a string as a SQL expression."""
    return F.expr(item) if isinstance(item, str) else item


def output_columns(
    default: Sequence[str],
    names: Sequence[str] | None = None,
    columns: Output | Sequence[Output] | None = None,
    extra: Sequence[Output] | None = None,
) -> list[Column]:
    """Column objects win over names, names over the default; extras come after."""
    if isinstance(columns, (Column, str)):
        columns = [columns]
    if columns:
        chosen = [expression(c) for c in columns]
    else:
        chosen = [F.col(n) for n in (names or default)]
    return chosen + [expression(c) for c in (extra or [])]


def project(
    df: DataFrame,
    names: Sequence[str] | None = None,
    columns: Output | Sequence[Output] | None = None,
    extra: Sequence[Output] | None = None,
) -> DataFrame:
    return df.select(*output_columns(df.columns, names, columns, extra))
