"""Distances between a vector column and a query, as Spark expressions.

Vectors are stored as ``array<float>``; arithmetic runs in double. A query given
as a list is rounded to float32 first, so it compares like a stored vector.
A NULL vector, a NULL element or a length mismatch gives a NULL distance.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

Query = Column | Sequence | Mapping


def to_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def float32(v: float) -> float:
    """The nearest float32 of a number, as a Python float."""
    return struct.unpack("<f", struct.pack("<f", float(v)))[0]


def dense_query(query: Query) -> Column:
    if isinstance(query, Column):
        return query
    if not isinstance(query, (list, tuple)) and not hasattr(query, "__iter__"):
        raise ValueError("a query vector must be a list of numbers")
    values = list(query)
    if values and all(isinstance(v, bool) for v in values):
        return F.array(*[F.lit(v) for v in values])
    return F.lit(np.array([float32(v) for v in values], dtype=np.float64))


def _fold(terms: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)


def inner_product(vector: Column | str, query: Query) -> Column:
    """Dot product; larger is nearer."""
    return _fold(
        F.zip_with(to_column(vector), dense_query(query), lambda x, y: x.cast("double") * y.cast("double"))
    )


def l2_distance(vector: Column | str, query: Query) -> Column:
    """Euclidean distance."""
    gaps = F.zip_with(to_column(vector), dense_query(query), lambda x, y: x.cast("double") - y.cast("double"))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda acc, d: acc + d * d))


def squared_norm(vector: Column | str) -> Column:
    return F.aggregate(to_column(vector), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))


def cosine_distance(vector: Column | str, query: Query) -> Column:
    """``1 - cos``; NULL when either vector has length zero."""
    v, q = to_column(vector), dense_query(query)
    norms = F.sqrt(squared_norm(v)) * F.sqrt(squared_norm(q))
    return F.lit(1.0) - F.try_divide(inner_product(v, q), norms)


def hamming_bool_distance(vector: Column | str, query: Query) -> Column:
    """Number of positions where two boolean vectors differ."""
    differs = F.zip_with(to_column(vector), dense_query(query), lambda x, y: (x != y).cast("double"))
    return _fold(differs)


def binarise(vector: Column | str) -> Column:
    """Sign bits of a float vector, the boolean input of the hamming distance."""
    return F.transform(to_column(vector), lambda x: x > F.lit(0.0))


# --- sparse vectors: map<int, float> ------------------------------------------


def _sparse_literal(query: Mapping) -> Column:
    """The query as a literal ``map<int,double>`` of float32 values."""
    if not query:
        return F.expr("cast(map() as map<int, double>)")
    return F.create_map(*[F.lit(x) for i, v in query.items() for x in (int(i), float32(v))])


def _sparse_fold(vector: Column, term: Callable[[Column, Column], Column]) -> Column:
    """Sum ``term(key, value)`` over the entries of a map."""
    return F.aggregate(
        F.map_entries(vector), F.lit(0.0), lambda acc, e: acc + term(e["key"], e["value"].cast("double"))
    )


def _sparse_norm(vector: Column) -> Column:
    return F.sqrt(_sparse_fold(vector, lambda _, x: x * x))


def sparse_inner_product(vector: Column | str, query: Mapping) -> Column:
    """Dot product with a ``{index: value}`` query: one pass over the row's entries."""
    q = _sparse_literal(query)
    return _sparse_fold(to_column(vector), lambda i, x: x * F.coalesce(F.try_element_at(q, i), F.lit(0.0)))


def sparse_l2_distance(vector: Column | str, query: Mapping) -> Column:
    v, q = to_column(vector), _sparse_literal(query)
    stored = _sparse_fold(v, lambda i, x: F.pow(x - F.coalesce(F.try_element_at(q, i), F.lit(0.0)), F.lit(2.0)))
    only_in_query = _sparse_fold(q, lambda i, x: F.when(F.map_contains_key(v, i), 0.0).otherwise(x * x))
    return F.sqrt(stored + only_in_query)


def sparse_cosine_distance(vector: Column | str, query: Mapping) -> Column:
    v = to_column(vector)
    norms = _sparse_norm(v) * _sparse_norm(_sparse_literal(query))
    return F.lit(1.0) - F.try_divide(sparse_inner_product(v, query), norms)


# --- metric names ---------------------------------------------------------------


@dataclass(frozen=True)
class Metric:
    """A named metric: how to score a row and which end of the scale is near."""

    name: str
    dense: Callable[[Column, Query], Column]
    sparse: Callable[[Column, Mapping], Column] | None
    ascending: bool = True

    def score(self, vector: Column | str, query: Query) -> Column:
        """The score of a row; NULL, which ranks last, also where it is no number."""
        if isinstance(query, Mapping):
            if self.sparse is None:
                raise ValueError(f"metric {self.name!r} has no sparse form")
            return F.nanvl(self.sparse(to_column(vector), query), F.lit(None).cast("double"))
        return F.nanvl(self.dense(to_column(vector), query), F.lit(None).cast("double"))

    def order(self, score: Column) -> Column:
        return score.asc_nulls_last() if self.ascending else score.desc_nulls_last()

    def within(self, score: Column, threshold: float) -> Column:
        return score <= F.lit(float(threshold)) if self.ascending else score >= F.lit(float(threshold))


METRICS = {
    m.name: m
    for m in (
        Metric("l2", l2_distance, sparse_l2_distance),
        Metric("cosine", cosine_distance, sparse_cosine_distance),
        Metric("hamming", hamming_bool_distance, None),
        Metric("ip", inner_product, sparse_inner_product, ascending=False),
    )
}


def metric(name: str | Metric) -> Metric:
    """Metric by name, case-insensitive."""
    if isinstance(name, Metric):
        return name
    if not isinstance(name, str):
        raise TypeError(f"a metric name must be a string, not {type(name).__name__}")
    try:
        return METRICS[name.lower()]
    except KeyError:
        raise ValueError(f"unknown metric {name!r}; known: {', '.join(METRICS)}") from None


def rounded(score: Column, digits: int | None) -> Column:
    """Round a score before it is ranked, so near-ties order the same on every plan."""
    return score if digits is None else F.round(score, digits)
