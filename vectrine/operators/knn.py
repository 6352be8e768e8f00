"""Nearest rows to one query vector."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import Metric, Query, metric as find_metric, rounded
from .filters import Condition, apply_filter, in_partitions
from .projection import Output, output_columns

SCORE = "score"
_RANK = "__score"


def score_column(m: Metric, vector: str, query: Query) -> Column:
    return m.score(vector, query)


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def knn(
    df: DataFrame,
    query: Query,
    column: str,
    metric: str | Metric = "l2",
    k: int = 10,
    *,
    key: str | Sequence[str],
    where: Condition | None = None,
    threshold: float | None = None,
    partitions: Sequence[str] | None = None,
    names: Sequence[str] | None = None,
    columns: Output | Sequence[Output] | None = None,
    extra: Sequence[Output] | None = None,
    with_score: bool = False,
    digits: int | None = None,
    post_filter: bool = False,
    expand: int | None = None,
) -> DataFrame:
    """Top ``k`` rows by distance, ties by ``key``, NULL distances last.

    ``query`` is a list of numbers, or ``{index: value}`` for a sparse column.
    ``where`` filters before ranking. With ``post_filter`` and ``expand`` it filters
    the best ``k * expand`` rows in a single pass and may leave fewer than ``k``;
    without ``expand`` the candidates widen until ``k`` rows pass or none are left,
    which are the rows that filtering first gives. ``threshold`` is inclusive. ``digits`` rounds the distance before it is ranked.
    Each task keeps its own best ``k`` and only those travel.
    """
    if not isinstance(query, (list, tuple, Mapping, Column)):
        raise ValueError("a query vector must be a list or a dict")
    m = find_metric(metric)
    output = output_columns(df.columns, names, columns, extra)
    if with_score:
        output.append(F.col(_RANK).alias(SCORE))
    rows = in_partitions(df, partitions)
    narrow = post_filter and expand is not None
    if not narrow:
        rows = apply_filter(rows, where)
    rows = rows.withColumn(_RANK, rounded(score_column(m, column, query), digits))
    order = [m.order(F.col(_RANK)), *[F.col(c).asc() for c in _keys(key)]]
    if narrow:
        rows = apply_filter(rows.orderBy(*order).limit(k * expand), where)
    best = rows.orderBy(*order).limit(k)
    if threshold is not None:
        # rows within the threshold lead the ranking: testing the k best is enough
        best = best.filter(m.within(F.col(_RANK), threshold))
    return best.select(*output)


def search(
    df: DataFrame,
    query: Query,
    column: str = "vector",
    *,
    key: str | Sequence[str],
    search_params: Mapping | None = None,
    limit: int = 10,
    **options,
) -> DataFrame:
    """``knn`` with the metric named in ``search_params["metric_type"]`` (l2 if absent)."""
    return knn(df, query, column, (search_params or {}).get("metric_type", "l2"), limit, key=key, **options)
