"""Tokens of a text column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .vectors import to_column

# Fixed value: a token is one Han character, or a run of other letters and digits.
TOKEN_PATTERN = r"[\x{4E00}-\x{9FFF}]|[\p{L}\p{N}&&[^\x{4E00}-\x{9FFF}]]+"


def tokens(text: Column | str) -> Column:
    """Lower-cased tokens in text order; NULL text has none."""
    found = F.regexp_extract_all(F.lower(to_column(text)), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def terms_of(spark: SparkSession, texts: Sequence[str]) -> list[list[str]]:
    """Distinct tokens of each query text, cut by the same expression as the corpus, in one small job."""
    if not all(isinstance(t, str) for t in texts):
        raise ValueError("a search text must be a string")
    if not texts:
        return []
    cut = spark.range(1).select(F.array(*[F.array_distinct(tokens(F.lit(t))) for t in texts]).alias("t"))
    return [list(t) for t in cut.first()["t"]]


def query_terms(spark: SparkSession, text: str) -> list[str]:
    """Distinct tokens of one query text."""
    return terms_of(spark, [text])[0]


def term_counts(text: Column | str, places: bool = False) -> Column:
    """struct(length, array of (term, tf)): a text's tokens counted inside its row.

    The tokens are sorted, so a term's count is the distance to the next one's first
    place. The one-element arrays bind a value to a name, so it is not computed per use.
    With ``places`` every term also has the ascending ``places`` of its tokens in the text.
    """

    def runs(s: Column) -> Column:
        def term(i: Column) -> Column:
            return F.get(s, i)["term"] if places else F.get(s, i)

        n = F.size(s)
        all_of = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        first = F.filter(all_of, lambda i: (i == 0) | (term(i) != term(i - 1)))

        def counted(at: Column, i: Column, j: Column) -> Column:
            tf = F.coalesce(F.get(at, j + 1), n) - i
            more = [F.transform(F.slice(s, i + 1, tf), lambda t: t["place"]).alias("places")] if places else []
            return F.struct(term(i).alias("term"), tf.cast("long").alias("tf"), *more)

        terms = F.transform(F.array(first), lambda at: F.transform(at, lambda i, j: counted(at, i, j)))[0]
        return F.struct(n.alias("length"), terms.alias("terms"))

    cut = tokens(text)
    if places:
        cut = F.transform(cut, lambda t, i: F.struct(t.alias("term"), i.alias("place")))
    return F.transform(F.array(F.sort_array(cut)), runs)[0]
