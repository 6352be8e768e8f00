"""BM25 scores computed in place, without an index.

Okapi BM25 (Robertson & Zaragoza 2009) with ``idf = ln(1 + (N-df+0.5)/(df+0.5))``.
N, df and the mean length always describe the whole corpus, not a filtered part.
One pass over the text gathers those statistics (a scalar subquery), one scores
the rows where they lie; nothing is exploded or shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, or_
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import terms_of, tokens
from ..functions.vectors import rounded
from ..session import spread
from .filters import Condition, apply_filter, in_partitions
from .knn import SCORE, _keys
from .projection import Output, output_columns

if TYPE_CHECKING:
    from ..indexes.postings import TextIndex

# The usual saturation and length weights.
K1 = 1.2
B = 0.75
DIGITS = 6

_SCORE = "__bm25"
_MATCHED = "__matched"


def idf(n: Column, df: Column) -> Column:
    return F.ln(F.lit(1.0) + (n - df + F.lit(0.5)) / (df + F.lit(0.5)))


def term_weight(tf: Column, length: Column, mean_length: Column, k1: float = K1, b: float = B) -> Column:
    """Saturated term frequency; 0 for an absent term."""
    norm = F.lit(1.0 - b) + F.lit(b) * length / mean_length
    return F.when(tf > 0, tf * F.lit(k1 + 1.0) / (tf + F.lit(k1) * norm)).otherwise(F.lit(0.0))


def counted(text: Column, terms: Sequence[str]) -> Column:
    """struct(length, tf per term) of a text, cutting it once.

    The one-element arrays bind a value to a name, so it is not computed per use.
    """
    known = F.array(*[F.lit(t) for t in terms])

    def count(cut: Column) -> Column:
        hits = F.filter(cut, lambda x: x.isin(list(terms)))
        tf = F.transform(
            F.array(hits), lambda h: F.transform(known, lambda t: F.size(F.filter(h, lambda x: x == t)))
        )[0]
        return F.struct(F.size(cut).alias("length"), tf.alias("tf"))

    return F.transform(F.array(tokens(text)), count)[0]


@dataclass
class _Texts:
    """The clauses on one text: its distinct query terms, and how many clauses hold each."""

    column: Column
    terms: list[str]
    times: list[int]


def _by_text(spark: SparkSession, clauses: Sequence[tuple[str | Column, str]]) -> list[_Texts]:
    """Clauses on one named column share its cut; clauses without a term fall away."""
    found: dict[object, _Texts] = {}
    for i, ((field, _), terms) in enumerate(zip(clauses, terms_of(spark, [text for _, text in clauses]))):
        if not terms:
            continue
        named = isinstance(field, str)
        group = found.setdefault(field if named else i, _Texts(F.col(field) if named else field, [], []))
        for t in terms:
            if t in group.terms:
                group.times[group.terms.index(t)] += 1
            else:
                group.terms.append(t)
                group.times.append(1)
    return list(found.values())


def _corpus_statistics(corpus: DataFrame, texts: Sequence[_Texts]) -> Column:
    """Scalar subquery, one pass over the corpus: per text a struct(n, mean_length, df per term)."""
    cuts = [counted(F.col(f"x{i}"), t.terms).alias(f"c{i}") for i, t in enumerate(texts)]
    counts = spread(corpus.select(*[t.column.alias(f"x{i}") for i, t in enumerate(texts)])).select(*cuts)
    # SQL text: a Column call per term would take longer than the query itself
    parts = [
        f"named_struct('n', double(count(1)), 'mean_length', avg(c{i}.length), "
        f"'df', array({', '.join(f'sum(double(c{i}.tf[{j}] > 0))' for j in range(len(t.terms)))})) AS s{i}"
        for i, t in enumerate(texts)
    ]
    return counts.selectExpr(*parts).agg(F.first(F.struct(*[f"s{i}" for i in range(len(texts))])).alias("s")).scalar()


def _summed_weights(counts: Column, text: _Texts, stats: Column, k1: float, b: float) -> Column:
    """Sum over the terms of idf times saturated frequency, a term counting once per clause that holds it."""
    weights = F.zip_with(
        counts["tf"],
        stats["df"],
        lambda f, d: idf(stats["n"], d) * term_weight(f, counts["length"], stats["mean_length"], k1, b),
    )
    if any(n > 1 for n in text.times):
        weights = F.zip_with(weights, F.lit([float(n) for n in text.times]), lambda w, n: w * n)
    return F.aggregate(weights, F.lit(0.0), lambda acc, w: acc + w)


def with_bm25(
    df: DataFrame,
    clauses: Sequence[tuple[str | Column, str]],
    *,
    corpus: DataFrame | None = None,
    score: str = _SCORE,
    matched: str = _MATCHED,
    digits: int | None = DIGITS,
    k1: float = K1,
    b: float = B,
    few_rows: bool = False,
) -> DataFrame:
    """Append the summed BM25 score of (text column, query text) clauses, and whether any term matched.

    Without a clause or a query term the score is 0.0 and nothing matches.
    ``corpus`` supplies the statistics when ``df`` is a part of it; ``few_rows``
    says that this part is small and need not be spread over the cores.
    """
    corpus = df if corpus is None else corpus
    texts = _by_text(df.sparkSession, clauses)
    if not texts:
        return df.withColumns({score: F.lit(0.0), matched: F.lit(False)})
    out = df if few_rows else spread(df)
    counts = {f"__counts{i}": counted(t.column, t.terms) for i, t in enumerate(texts)}
    out = out.withColumns({**counts, "__stats": _corpus_statistics(corpus, texts)})
    parts = [_summed_weights(F.col(c), t, F.col("__stats")[f"s{i}"], k1, b) for i, (c, t) in enumerate(zip(counts, texts))]
    hits = [F.array_max(F.col(c)["tf"]) > 0 for c in counts]
    return out.withColumns({score: rounded(reduce(add, parts), digits), matched: reduce(or_, hits)}).drop(*counts, "__stats")


def bm25_search(
    df: DataFrame,
    text: str,
    column: str | Column,
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
    matching_only: bool = True,
    digits: int | None = DIGITS,
) -> DataFrame:
    """Top ``k`` rows by BM25, ties by ``key``; ``threshold`` is inclusive.

    ``matching_only=False`` also ranks rows holding no query term, with score 0.0.
    """
    if not isinstance(text, str):
        raise ValueError("a search text must be a string")
    output = output_columns(df.columns, names, columns, extra)
    if with_score:
        output.append(F.col(_SCORE).alias(SCORE))
    rows = apply_filter(in_partitions(df, partitions), where)
    rows = with_bm25(rows, [(column, text)], corpus=df, digits=digits)
    # Both conditions hold for a leading part of the ranking, so they can follow the
    # limit; ahead of it they would be pushed into the scan and cut the text twice.
    order = [F.col(_SCORE).desc_nulls_last(), F.col(_MATCHED).desc(), *[F.col(c).asc() for c in _keys(key)]]
    best = rows.orderBy(*order).limit(k)
    if matching_only:
        best = best.filter(_MATCHED)
    if threshold is not None:
        best = best.filter(F.col(_SCORE) >= F.lit(float(threshold)))
    return best.select(*output)


def match_against(
    df: DataFrame,
    text: str,
    columns: Sequence[str],
    k: int = 10,
    *,
    key: str | Sequence[str],
    index: TextIndex | None = None,
    **options,
) -> DataFrame:
    """BM25 of one query against several columns read as one text; through an index over the same columns if given."""
    if not columns:
        raise ValueError("match_against needs at least one column")
    if index is not None:
        if index.columns != list(columns):
            raise ValueError(f"the index reads {index.columns}, not {list(columns)}")
        return index.search(df, text, k, **options)
    return bm25_search(df, text, F.concat_ws(" ", *columns), k, key=key, **options)


def sum_scores(parts: Sequence[DataFrame], key: str, digits: int | None = DIGITS) -> DataFrame:
    """(key, score) summed over the (key, score) rows of several clauses."""
    union = reduce(DataFrame.unionByName, parts)
    return union.groupBy(key).agg(rounded(F.sum(SCORE), digits).alias(SCORE))
