"""Nearest rows to many query vectors through the cells of an index."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.vectors import metric as find_metric
from ..operators.knn_join import BROADCAST_BYTES, QUERY_ID, beside_group, knn_join, merge_best
from ..session import shared_dir
from ..sources.table import SOURCE

if TYPE_CHECKING:
    from .vectors import VectorIndex

PRODUCT_CELLS = 4_000_000


def _nearest_cells_of(block, start: int, dim: int, metric: str, nprobe: int):
    """UDF: the nearest centres of one broadcast block, nearest first, as (cost, cell)."""
    from .vectors import usable_matrix

    @F.arrow_udf("array<struct<cost: double, cell: int>>")
    def nearest(batch: pa.Array) -> pa.Array:
        c = block.value
        x, ok = usable_matrix(batch, dim, metric)
        squares, few = (c * c).sum(axis=1)[None, :], min(nprobe, len(c))
        cells, costs = np.zeros((len(x), few), dtype=np.int32), np.zeros((len(x), few))
        for at in range(0, len(x), step := max(1, PRODUCT_CELLS // len(c))):
            part = squares - 2.0 * (x[at : at + step] @ c.T)
            order = np.argsort(part, axis=1, kind="stable")[:, :few]
            cells[at : at + step], costs[at : at + step] = order + start, np.take_along_axis(part, order, axis=1)
        pairs = pa.StructArray.from_arrays([pa.array(costs.ravel()), pa.array(cells.ravel())], names=["cost", "cell"])
        lists = pa.FixedSizeListArray.from_arrays(pairs, few).cast(pa.list_(pairs.type)) if few else pa.array([[]] * len(x), pa.list_(pairs.type))
        return pa.compute.if_else(pa.array(ok), lists, pa.scalar(None, lists.type))

    return nearest


def nearest_cells(spark: SparkSession, vector: Column, centres: np.ndarray, metric: str, nprobe: int) -> Column:
    """``array<int>``: the ``nprobe`` cells nearest a vector, nearest first; null where it has no place."""
    from .vectors import centre_blocks

    found = [_nearest_cells_of(block, start, centres.shape[1], metric, nprobe)(vector) for start, block in centre_blocks(spark, centres)]
    best = F.slice(F.array_sort(F.flatten(F.array(*found))), 1, nprobe) if len(found) > 1 else found[0]
    return F.transform(best, lambda c: c["cell"])


def cell_join(
    index: VectorIndex,
    queries: DataFrame,
    query_key: str,
    query_vector: str,
    k: int = 10,
    nprobe: int = 8,
    *,
    digits: int | None = None,
    block_bytes: int = BROADCAST_BYTES,
    sources: Sequence[str] | None = None,
    fresh: DataFrame | None = None,
) -> DataFrame:
    """The ``k`` nearest of each query's ``nprobe`` cells: (query_id, key, score, rank).

    Both sides are dealt by cell. Queries go to their cells; the rows of a cell that is
    probed are shuffled once and cut into pieces of ``block_bytes``, so a cell that
    holds a third of all rows is many tasks. Only a cell that more queries probe than
    ``block_bytes`` hold meets them in blocks, for which its rows are repeated. A task
    emits at most ``k`` rows per query.

    At ``nprobe=nlist`` the result is that of ``knn_join``: rows without a cell have
    no score and fill up what is missing to ``k``, lowest keys first. Queries that have no place
    among the cells (NULL, of another length, with a hole, or zero under cosine) are
    joined with all rows. ``sources`` and ``fresh`` are those of ``VectorIndex.search``.
    """
    from .vectors import CELL, NO_CELL

    spark, m, key = index.spark, find_metric(index.metric), index.key
    rows = index.rows(sources)
    points = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{index.vector}`").alias("v"), CELL)
    plain = rows.select(key, index.vector)
    everything = plain if fresh is None else plain.unionByName(fresh.select(key, index.vector))
    exact = {"query_key": "id", "query_vector": "v", "key": key, "vector": index.vector, "metric": m, "k": k, "digits": digits}
    asked = queries.select(F.col(f"`{query_key}`").alias("id"), F.col(f"`{query_vector}`").alias("v"))
    if not index.nlist:
        return knn_join(asked, everything, **exact)
    dealt = shared_dir(spark)
    asked.withColumn("cells", nearest_cells(spark, F.col("v"), index._centre_matrix(), index.metric, min(nprobe, index.nlist))).write.parquet(dealt)
    asked = spark.read.parquet(dealt)
    placed = asked.filter("cells is not null")
    out = StructType([StructField(QUERY_ID, asked.schema["id"].dataType), StructField(key, rows.schema[key].dataType), StructField("score", DoubleType())])
    found = [knn_join(asked.filter("cells is null").select("id", "v"), everything, **exact).drop("rank")]

    # one row per cell: how many pieces of rows and blocks of queries it has
    per_group = max(1, block_bytes // (8 * index.dim))
    probes = placed.select(F.explode("cells").alias(CELL)).groupBy(CELL).agg(F.count("*").alias("queries"))
    plan = [(r[CELL], -(-r["rows"] // per_group), -(-r["queries"] // per_group)) for r in index.bounds().join(probes, CELL).collect()]
    if plan:
        groups = F.broadcast(spark.createDataFrame(plan, f"{CELL} int, pieces long, blocks long"))
        by = [F.col(c) for c in (CELL, "piece", "block")]

        def every(count: str) -> Column:
            return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

        left = placed.select("id", "v", F.explode("cells").alias(CELL)).join(groups, CELL)
        left = left.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).withColumn("piece", every("pieces")).drop("pieces", "blocks")
        right = index.of_cells(points, [c for c, _, _ in plan]).join(groups, CELL)
        right = right.withColumn("piece", F.pmod(F.xxhash64("key"), F.col("pieces"))).withColumn("block", every("blocks")).drop("pieces", "blocks")
        best = beside_group(index.dim, m.name, k, digits, 1.0 if m.ascending else -1.0, out)
        found.append(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(best, out))
    if fresh is not None:
        found.append(knn_join(placed.select("id", "v"), fresh.drop(SOURCE), **exact).drop("rank"))
    if nprobe >= index.nlist:
        last = [r["key"] for r in points.filter(F.col(CELL) == NO_CELL).orderBy("key").limit(k).select("key").collect()]
        if last:
            keys = F.array(*[F.lit(x) for x in last]).cast(f"array<{rows.schema[key].dataType.simpleString()}>")
            found.append(placed.select(F.col("id").alias(QUERY_ID), F.explode(keys).alias(key), F.lit(None).cast("double").alias("score")))
    return merge_best(reduce(DataFrame.unionByName, found), key, m, k, digits)
