"""Row filters: predicates, point reads, partition limits, row counts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .projection import Output, expression, project

Condition = Column | str | Sequence[Column | str]
# A longer list would make the plan's text, not the result, unwieldy.
IN_LIST_LIMIT = 1000


def all_of(condition: Condition | None) -> Column | None:
    """One predicate from a Column, SQL text, or a list of them (ANDed)."""
    if condition is None:
        return None
    items = [condition] if isinstance(condition, (Column, str)) else list(condition)
    return reduce(and_, [expression(c) for c in items]) if items else None


def apply_filter(df: DataFrame, condition: Condition | None) -> DataFrame:
    predicate = all_of(condition)
    return df if predicate is None else df.filter(predicate)


def partition_test(name: str) -> Column:
    """TRUE for rows labelled with a partition; ``part/subpart`` names a second-level one."""
    part, _, subpart = name.partition("/")
    test = F.col("part") == part
    return test & (F.col("subpart") == subpart) if subpart else test


def in_partitions(df: DataFrame, partitions: Sequence[str] | None) -> DataFrame:
    """Limit to named partitions."""
    if partitions is None:
        return df
    return df.filter(reduce(or_, [partition_test(p) for p in partitions], F.lit(False)))


def id_list(ids: str | int | Iterable) -> list:
    if isinstance(ids, (str, int)):
        return [ids]
    if isinstance(ids, list):
        return ids
    raise TypeError("ids must be a list, a string or an integer")


def single_key(key: str | Sequence[str]) -> str:
    """The one key column; ids cannot address a composite key."""
    keys = [key] if isinstance(key, str) else list(key)
    if len(keys) != 1:
        raise TypeError("ids need a table with exactly one key column")
    return keys[0]


def id_test(df: DataFrame, key: str, ids: list) -> Column:
    """TRUE for a row whose key is among ``ids``; an id that is no value of the key's type is absent."""
    dtype = df.schema[key].dataType
    return F.col(key).isin([F.lit(i).try_cast(dtype) for i in ids]) if ids else F.lit(False)


def id_rows(df: DataFrame, key: str, ids: list) -> DataFrame:
    """The ids as rows, cast as ``id_test`` does."""
    rows = df.sparkSession.createDataFrame([(str(i),) for i in ids], "id string")
    return rows.select(F.col("id").try_cast(df.schema[key].dataType).alias(key))


def with_ids(df: DataFrame, key: str, ids, keep: bool = True) -> DataFrame:
    """Rows whose key is (or, with ``keep=False``, is not) among ``ids``.

    A short list becomes an IN predicate that reaches the scan; a long one, or a
    DataFrame of ids, a semi or anti join whose strategy Spark picks by size.
    """
    if not isinstance(ids, DataFrame):
        ids = id_list(ids)
        if len(ids) <= IN_LIST_LIMIT:
            hit = id_test(df, key, ids)
            return df.filter(hit if keep else ~F.coalesce(hit, F.lit(False)))
        ids = id_rows(df, key, ids)
    return df.join(ids.select(key), key, "left_semi" if keep else "left_anti")


def get(
    df: DataFrame,
    key: str | Sequence[str],
    ids=None,
    where: Condition | None = None,
    names: Sequence[str] | None = None,
    partitions: Sequence[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Point read by key values, AND-ed with ``where``; absent ids are simply absent."""
    out = apply_filter(in_partitions(df, partitions), where)
    if ids is not None:
        out = with_ids(out, single_key(key), ids)
    out = project(out, names)
    return out if limit is None else out.limit(limit)


def query(
    df: DataFrame,
    where: Condition | None = None,
    names: Sequence[str] | None = None,
    columns: Output | Sequence[Output] | None = None,
    extra: Sequence[Output] | None = None,
    partitions: Sequence[str] | None = None,
) -> DataFrame:
    """Filtered read."""
    return project(apply_filter(in_partitions(df, partitions), where), names, columns, extra)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


# --- predicates on JSON, arrays and vectors ---------------------------------------


def json_field(column: Column | str, path: str, cast: str | None = None) -> Column:
    """Value at a JSON path (``$.page``), as text or cast; a failed cast is NULL."""
    value = F.get_json_object(column, path)
    return value.try_cast(cast) if cast else value


def contains_all(column: Column | str, wanted: Sequence) -> Column:
    """TRUE when the array holds every wanted value."""
    c = F.col(column) if isinstance(column, str) else column
    return reduce(and_, [F.array_contains(c, w) for w in wanted], c.isNotNull())


def vector_equals(column: Column | str, vector: Sequence[float]) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c == F.array(*[F.lit(float(v)).cast("float") for v in vector])
