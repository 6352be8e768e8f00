"""Vectors to and from their text forms ``[1,2,3]`` and ``{1:1.1, 2:2.2}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import to_column

# An integer key, a decimal value, and the whole text of a sparse vector.
_KEY = r"[+-]?\d+"
_VALUE = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
SPARSE_ENTRY = rf"({_KEY})\s*:\s*({_VALUE})"
SPARSE_TEXT = rf"^\s*\{{\s*(?:{_KEY}\s*:\s*{_VALUE}\s*(?:,\s*{_KEY}\s*:\s*{_VALUE}\s*)*,?\s*)?\}}\s*$"


def vector_from_text(text: Column | str) -> Column:
    """``'[1,2,3]'`` to ``array<float>``; NULL when any part is not a number."""
    t = F.trim(to_column(text))
    inner = F.regexp_extract(t, r"^\[(.*)\]$", 1)
    parts = F.transform(F.split(inner, ","), lambda p: F.trim(p).try_cast("float"))
    return F.when(t.rlike(r"^\[.+\]$") & ~F.exists(parts, lambda x: x.isNull()), parts)


def vector_from_bytes(raw: Column | str) -> Column:
    """UTF-8 JSON bytes to ``array<float>``; NULL when the JSON is not a list of numbers."""
    parsed = F.from_json(to_column(raw).cast("string"), "array<float>")
    return F.when(~F.exists(parsed, lambda x: x.isNull()), parsed)


def vector_to_text(vector: Column | str) -> Column:
    parts = F.transform(to_column(vector), lambda x: x.cast("string"))
    return F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]"))


def sparse_from_text(text: Column | str) -> Column:
    """``'{1:1.1, 2:2.2}'`` to ``map<int,float>``; the last of equal keys wins, bad text is NULL."""
    t = to_column(text)
    keys = F.transform(F.regexp_extract_all(t, F.lit(SPARSE_ENTRY), 1), lambda k: k.try_cast("int"))
    values = F.transform(F.regexp_extract_all(t, F.lit(SPARSE_ENTRY), 2), lambda v: v.cast("float"))
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    unique = F.array_distinct(keys)
    last_of_key = F.map_from_arrays(
        unique,
        F.transform(unique, lambda k: F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"]),
    )
    well_formed = t.rlike(SPARSE_TEXT) & ~F.exists(keys, lambda k: k.isNull())
    return F.when(
        well_formed,
        F.when(F.size(unique) == F.size(keys), F.map_from_arrays(keys, values)).otherwise(last_of_key),
    )


def sparse_to_text(vector: Column | str) -> Column:
    entries = F.transform(
        F.map_entries(to_column(vector)),
        lambda e: F.concat_ws(": ", e["key"].cast("string"), e["value"].cast("string")),
    )
    return F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))


def is_valid_vector(vector: Column | str, dim: int | None = None) -> Column:
    """TRUE for a vector without NULL elements and, if ``dim`` is given, of that length."""
    v = to_column(vector)
    ok = ~F.exists(v, lambda x: x.isNull())
    return ok & (F.size(v) == dim) if dim is not None else ok


def split_valid(df: DataFrame, column: str, dim: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows whose vector is usable (NULL counts as usable), and the rejected rest."""
    usable = F.coalesce(F.col(column).isNull() | is_valid_vector(column, dim), F.lit(False))
    return df.filter(usable), df.filter(~usable)


def decode_vectors(
    df: DataFrame, source: str, target: str, dim: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Decode a text or bytes column; returns decoded rows and rows that failed.

    A NULL source decodes to a NULL vector and is not a failure.
    """
    decode = vector_from_bytes if dict(df.dtypes)[source] == "binary" else vector_from_text
    decoded = df.withColumn(target, decode(source))
    fits = F.col(target).isNotNull()
    if dim is not None:
        fits = fits & (F.size(target) == dim)
    good = F.col(source).isNull() | fits
    return decoded.filter(good), decoded.filter(~good).drop(target)
