"""Nearest rows to many query vectors at once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.kernels import batch_matrix, cost_matrix, exact_cost
from ..functions.vectors import Metric, metric as find_metric, rounded

QUERY_ID = "query_id"
BROADCAST_BYTES = 64 << 20
QUERY_ROWS_PER_PRODUCT = 256
PAIRS_PER_CHECK = 100_000
ROWS_PER_BATCH = 4096
MERGE_GROUPS = 64


def _best_of(rows: pa.Table, k: int) -> pa.Table:
    """The k lowest costs of each query row, ties by key."""
    rows = rows.sort_by([("q", "ascending"), ("cost", "ascending"), ("key", "ascending")])
    q = rows["q"].to_numpy()
    starts = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.array([], dtype=int)
    lengths = np.diff(np.append(starts, len(q)))
    rank = np.arange(len(q)) - np.repeat(starts, lengths)
    return rows.filter(pa.array(rank < k))


def _candidates(
    metric: str, x: np.ndarray, ok: np.ndarray, q: np.ndarray, q_ok: np.ndarray, worst: np.ndarray, k: int, slack: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (query row, batch row, exact cost) that can still enter a top k.

    The matrix product only preselects, within its error bound; costs are then
    recomputed pair by pair.
    """
    costs, error = cost_matrix(metric, x, q)
    costs[~q_ok] = np.inf
    costs[:, ~ok] = np.inf
    costs[np.isnan(costs)] = np.inf
    limit = worst
    if costs.shape[1] > k:
        limit = np.minimum(worst, np.partition(costs, k - 1, axis=1)[:, k - 1])
    qi, xi = np.nonzero(costs <= (limit + slack + error)[:, None])
    exact = np.empty(len(qi))
    for at in range(0, len(qi), PAIRS_PER_CHECK):
        cut = slice(at, at + PAIRS_PER_CHECK)
        exact[cut] = exact_cost(metric, x[xi[cut]], q[qi[cut]])
    exact[np.isnan(exact) | ~ok[xi] | ~q_ok[qi]] = np.inf
    return qi, xi, exact


def _numbers(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows as a matrix and which of them can be scored; zeros stand in for the others."""
    x, ok = batch_matrix(column, dim)
    ok = ok & ~np.isnan(x).any(axis=1)
    x[~ok] = 0.0
    return x, ok


class _Best:
    """The best k so far of every query of a block."""

    def __init__(self, ids: pa.Array, vectors: pa.Array, dim: int, metric: str, k: int, digits: int | None):
        self.ids, (self.q, self.q_ok) = ids, _numbers(vectors, dim)
        self.metric, self.k, self.digits = metric, k, digits
        self.slack = 0.0 if digits is None else 10.0**-digits
        self.worst = np.full(len(ids), np.inf)
        self.best: pa.Table | None = None

    def add(self, keys: pa.Array, vectors: pa.Array) -> None:
        """Take in one batch of corpus rows."""
        x, ok = _numbers(vectors, self.q.shape[1])
        found = [] if self.best is None else [self.best]
        for at in range(0, len(self.ids), QUERY_ROWS_PER_PRODUCT):
            part = slice(at, at + QUERY_ROWS_PER_PRODUCT)
            qi, xi, cost = _candidates(self.metric, x, ok, self.q[part], self.q_ok[part], self.worst[part], self.k, self.slack)
            if self.digits is not None:
                cost = np.round(cost, self.digits)
            near = {"q": pa.array(qi + at), "cost": pa.array(cost), "key": keys.take(pa.array(xi))}
            found.append(_best_of(pa.table(near), self.k))
        self.best = _best_of(pa.concat_tables(found), self.k)
        rows_of = self.best["q"].to_numpy()
        full = np.bincount(rows_of, minlength=len(self.ids)) >= self.k
        highest = np.full(len(self.ids), -np.inf)
        np.maximum.at(highest, rows_of, self.best["cost"].to_numpy())
        self.worst = np.where(full, highest, np.inf)

    def table(self, sign: float, names: list[str]) -> pa.Table | None:
        if self.best is None or not self.best.num_rows:
            return None
        cost = self.best["cost"].to_numpy()
        score = pa.array(sign * cost, mask=np.isinf(cost))
        keys = self.best["key"]
        return pa.table([self.ids.take(self.best["q"].combine_chunks()), keys, score], names=names)


def _beside_broadcast(block, dim: int, metric: str, k: int, digits: int | None, sign: float, names: list[str]):
    """A mapInArrow function: the best k of this task's rows for every broadcast query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(*block.value, dim, metric, k, digits)
        for batch in batches:
            best.add(batch.column(0), batch.column(1))
        found = best.table(sign, names)
        if found is not None:
            yield from found.combine_chunks().to_batches()

    return run


def beside_group(dim: int, metric: str, k: int, digits: int | None, sign: float, out: StructType):
    """A cogrouped function: the best k of a group of corpus rows for a block of queries."""

    def run(queries: pa.Table, points: pa.Table) -> pa.Table:
        names = out.names
        if queries.num_rows:
            best = _Best(queries["id"].combine_chunks(), queries["v"].combine_chunks(), dim, metric, k, digits)
            for batch in points.to_batches(ROWS_PER_BATCH):
                best.add(batch.column("key"), batch.column("v"))
            found = best.table(sign, names)
            if found is not None:
                return found
        return pa.table([queries["id"].slice(0, 0), points["key"].slice(0, 0), pa.array([], pa.float64())], names=names)

    return run


def _grid(q: DataFrame, points: DataFrame, dim: int, n: int, block_bytes: int, task: tuple, out: StructType) -> DataFrame:
    """Queries beyond a broadcast: blocks of them meet groups of the corpus, each pair in one task of bounded memory."""
    metric, k, digits, sign = task
    per_block = max(1, block_bytes // (8 * dim))
    blocks, groups = -(-n // per_block), max(1, -(-points.count() // per_block))

    def numbers(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = q.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn("g", numbers(groups))
    right = points.withColumn("g", F.pmod(F.xxhash64("key"), F.lit(groups))).withColumn("b", numbers(blocks))
    by = [F.col("g").cast("long"), F.col("b").cast("long")]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(beside_group(dim, metric, k, digits, sign, out), out)


def knn_join(
    queries: DataFrame,
    corpus: DataFrame,
    *,
    query_key: str,
    query_vector: str,
    key: str,
    vector: str,
    metric: str | Metric = "l2",
    k: int = 10,
    digits: int | None = None,
    block_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The ``k`` nearest corpus rows of every query: (query_id, key, score, rank).

    Queries are scored by their own length; one that is NULL or has a hole has NULL
    scores, as have corpus rows of another length. Queries of one length that fit
    ``block_bytes`` (counted first) are broadcast and the corpus is read in place.
    More of them are dealt into blocks that meet groups of the corpus in a
    cogrouped shuffle, without passing the driver. A task emits at most ``k`` rows
    per query; these are merged in two stages, so no group of the second holds more
    than ``k`` rows for each of ``MERGE_GROUPS``.
    """
    m = find_metric(metric)
    spark = corpus.sparkSession
    q_rows = queries.select(F.col(f"`{query_key}`").alias("id"), F.col(f"`{query_vector}`").alias("v"))
    length = F.coalesce(F.when(F.size("v") > 0, F.size("v")), F.lit(0))
    lengths = {r["d"]: r["n"] for r in q_rows.groupBy(length.alias("d")).agg(F.count("*").alias("n")).collect()}
    out = StructType([StructField(QUERY_ID, q_rows.schema["id"].dataType), corpus.schema[key], StructField("score", DoubleType())])
    task = (m.name, k, digits, 1.0 if m.ascending else -1.0)
    points = corpus.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("v"))
    found = []
    for dim, n in lengths.items():
        part = q_rows.filter(length == dim)
        width = max(dim, 1)
        if 8 * width * n <= block_bytes:
            rows = part.toArrow()
            block = spark.sparkContext.broadcast((rows["id"].combine_chunks(), rows["v"].combine_chunks()))
            found.append(points.mapInArrow(_beside_broadcast(block, width, *task, out.names), out))
        else:
            found.append(_grid(part, points, width, n, block_bytes, task, out))
    return merge_best(reduce(DataFrame.unionByName, found, spark.createDataFrame([], out)), key, m, k, digits)


def merge_best(found: DataFrame, key: str, m: Metric, k: int, digits: int | None) -> DataFrame:
    """The ``k`` best of (query_id, key, score) rows per query, with their rank.

    Merged in two stages, so that no group of the second holds more than ``k`` rows for
    each of ``MERGE_GROUPS``.
    """
    # numpy and Spark round half-way cases differently; settle on Spark's rule
    merged = found.withColumn("score", rounded(F.col("score"), digits))
    order = [m.order(F.col("score")), F.col(f"`{key}`").asc()]
    first = Window.partitionBy(QUERY_ID, "__group").orderBy(*order)
    some = merged.withColumn("__group", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))).withColumn("rank", F.row_number().over(first))
    some = some.filter(F.col("rank") <= k).drop("__group", "rank")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy(QUERY_ID).orderBy(*order))).filter(F.col("rank") <= k)
