"""IVF index of one vector column, optionally with product-quantized codes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from copy import copy
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.kernels import batch_matrix, nearest_rows, unit_rows
from ..functions.vectors import float32, metric as find_metric, rounded, squared_norm
from ..operators.filters import IN_LIST_LIMIT, Condition, apply_filter, in_partitions
from ..operators.knn import SCORE, knn
from ..commits import Commits
from ..sources.partitioning import PART, SUBPART
from ..sources.table import SOURCE

METRICS = ("l2", "cosine")
# Columns that indexed rows carry beside the table's.
CELL, CODES = "__cell", "__codes"
# The distance of a row to its cell's centroid, in the space the centroids were trained in.
FAR = "__far"
# The partition that a centroid was trained on, where partitions have their own.
GROUP = "__group"
# Rows whose vector has no nearest centroid: NULL, of another length, with a hole or
# NaN, or zero under cosine.
NO_CELL = -1
BLOCK_BYTES = 64 << 20
BROADCAST_ROWS = 10_000
# KMeans sees this many rows per centroid (or code) unless told otherwise.
TRAIN_ROWS_PER_CENTRE = 256
# Largest sample of one partition (as doubles) that its own centroids are trained on, in one task.
OWN_TRAIN_BYTES = 256 << 20
LLOYD_ROUNDS = 10
# Share of the distances by which bounds are widened against rounding.
SLACK = 1e-9


def _normalised(vector: Column) -> Column:
    """The vector scaled to length one; the one-element array binds its norm, computed once."""
    norm = F.array(F.sqrt(squared_norm(vector)))
    return F.transform(norm, lambda n: F.transform(vector, lambda x: x.cast("double") / n))[0]


def _group_of(local: Sequence[str]) -> Column:
    """The name of a row's partition; never null."""
    return F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in local]))


def _trainable(df: DataFrame, vector: str, metric: str, local: Sequence[str] = ()) -> DataFrame:
    """``v``, the vectors without holes and NaN, for cosine also without zero vectors, and the partition's name."""
    v = F.col(f"`{vector}`")
    usable = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x))
    if metric == "cosine":
        usable = usable & F.exists(v, lambda x: x != F.lit(0.0))
    return df.filter(usable).select(v.alias("v"), *([_group_of(local).alias(GROUP)] if local else []))


def _centres(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """Centroids by KMeans; no more than there are different vectors."""
    k = min(k, rows.select(F.xxhash64("v")).distinct().limit(k).count())
    if k == 1:
        n = len(rows.first()["v"])
        return np.array([rows.agg(*[F.avg(F.col("v")[i]).alias(f"m{i}") for i in range(n)]).first()])
    points = rows.select(array_to_vector(F.col("v")).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=10, initSteps=2).fit(points)
    return np.array(model.clusterCenters())


def lloyd(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """At most ``k`` centroids of a bounded sample, whatever the order of its rows.

    The first ones are drawn with a chance that grows with the squared distance to
    those there are; then rows and centroids are fitted to each other in turn.
    """
    distinct = np.unique(x, axis=0)
    if len(distinct) <= k:
        return distinct
    x = x[np.lexsort(x.T)]
    rng = np.random.default_rng(seed)
    centres = [x[rng.integers(len(x))]]
    gaps = ((x - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k and gaps.sum() > 0:
        centres.append(x[rng.choice(len(x), p=gaps / gaps.sum())])
        gaps = np.minimum(gaps, ((x - centres[-1]) ** 2).sum(axis=1))
    out = np.array(centres)
    for _ in range(LLOYD_ROUNDS):
        best = nearest_rows(x, out)[0]
        n = np.bincount(best, minlength=len(out))[:, None]
        sums = np.column_stack([np.bincount(best, weights=x[:, d], minlength=len(out)) for d in range(x.shape[1])])
        out = np.where(n > 0, sums / np.maximum(n, 1), out)
    return out


def _own_centres(rows: DataFrame, k: int, seed: int) -> tuple[np.ndarray, list[str]]:
    """Centroids of each partition (column ``GROUP``) and their partitions; one task trains one partition on its bounded sample."""

    def train(table: pa.Table) -> pa.Table:
        column = table["v"].combine_chunks()
        x = column.values.to_numpy(zero_copy_only=False).reshape(len(column), -1)
        found = lloyd(x, k, seed)
        return pa.table({GROUP: pa.array([table[GROUP][0].as_py()] * len(found)), "centroid": pa.array(found.tolist(), pa.list_(pa.float64()))})

    found = rows.groupBy(GROUP).applyInArrow(train, f"{GROUP} string, centroid array<double>").collect()
    ordered = sorted((r[GROUP], r["centroid"]) for r in found)
    return np.array([c for _, c in ordered]), [g for g, _ in ordered]


def _nearest_own_of(block, start: int, dim: int, metric: str):
    """UDF like ``_nearest_of``, among the centres of the row's partition; among all for a null partition."""

    @F.arrow_udf("struct<cost: double, cell: int, far: double>")
    def nearest(batch: pa.Array, own: pa.Array) -> pa.Array:
        centres, names = block.value
        x, ok = usable_matrix(batch, dim, metric)
        codes = own.fill_null("").dictionary_encode()
        label = codes.indices.to_numpy()
        costs, best, seen = np.zeros(len(x)), np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=bool)
        for i, name in enumerate(codes.dictionary.to_pylist()):
            mine, rows = np.flatnonzero(names == name) if name else np.arange(len(centres)), np.flatnonzero(label == i)
            if len(mine):
                at, costs[rows] = nearest_rows(x[rows], centres[mine])
                best[rows], seen[rows] = mine[at], True
        gaps = x - centres[best]
        fields = [pa.array(costs), pa.array((best + start).astype(np.int32)), pa.array(np.sqrt((gaps * gaps).sum(axis=1)))]
        return pa.StructArray.from_arrays(fields, names=["cost", "cell", "far"], mask=pa.array(~(ok & seen)))

    return nearest


def _nearest_of(block, start: int, dim: int, metric: str):
    """UDF: struct(cost, cell, far) of the nearest centre in one broadcast block."""

    @F.arrow_udf("struct<cost: double, cell: int, far: double>")
    def nearest(batch: pa.Array) -> pa.Array:
        c = block.value
        x, ok = usable_matrix(batch, dim, metric)
        best, costs = nearest_rows(x, c)
        gaps = x - c[best]
        fields = [pa.array(costs), pa.array((best + start).astype(np.int32)), pa.array(np.sqrt((gaps * gaps).sum(axis=1)))]
        return pa.StructArray.from_arrays(fields, names=["cost", "cell", "far"], mask=pa.array(~ok))

    return nearest


def usable_matrix(batch: pa.Array, dim: int, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """The vectors in the space of the centroids, and which of them have a place there."""
    x, ok = batch_matrix(batch, dim)
    ok = ok & ~np.isnan(x).any(axis=1)
    if metric == "cosine":
        ok = ok & (x != 0).any(axis=1)
        x = unit_rows(x)
    return x, ok


def centre_blocks(spark: SparkSession, centres: np.ndarray) -> list[tuple[int, Broadcast]]:
    """The centres in blocks of bounded size, each with the number of its first."""
    per_block = max(1, BLOCK_BYTES // (8 * centres.shape[1]))
    return [(at, spark.sparkContext.broadcast(centres[at : at + per_block])) for at in range(0, len(centres), per_block)]


def _nearest(spark: SparkSession, vector: Column, centres: np.ndarray, metric: str, groups: Sequence[str] | None = None, own: Column | None = None) -> Column:
    """struct(cost, cell, far) of the nearest centre; given ``groups``, of those of the row's partition ``own`` if it has any."""
    dim = centres.shape[1]
    if groups is None:
        candidates = [_nearest_of(block, start, dim, metric)(vector) for start, block in centre_blocks(spark, centres)]
    else:
        names, per_block = np.array(groups, dtype=object), max(1, BLOCK_BYTES // (8 * dim))
        known = F.when(own.isin(sorted(set(groups))), own)
        starts = range(0, len(centres), per_block)
        blocks = [spark.sparkContext.broadcast((centres[at : at + per_block], names[at : at + per_block])) for at in starts]
        candidates = [_nearest_own_of(block, at, dim, metric)(vector, known) for at, block in zip(starts, blocks)]
    return F.array_min(F.array(*candidates)) if len(candidates) > 1 else candidates[0]


def segment_bounds(dim: int, segments: int) -> list[tuple[int, int]]:
    if not 1 <= segments <= dim:
        raise ValueError(f"{segments} segments do not fit {dim} numbers")
    cuts = [dim * i // segments for i in range(segments + 1)]
    return list(zip(cuts, cuts[1:]))


def _encode(spark: SparkSession, vector: Column, codebooks: list[np.ndarray], dim: int, metric: str) -> Column:
    """Per segment the number of the nearest code, as ``array<smallint>``."""
    bounds = segment_bounds(dim, len(codebooks))
    books = spark.sparkContext.broadcast(codebooks)

    @F.arrow_udf("array<smallint>")
    def encode(batch: pa.Array) -> pa.Array:
        x, ok = batch_matrix(batch, dim)
        if metric == "cosine":
            x = unit_rows(x)
        codes = np.empty((len(x), len(bounds)), dtype=np.int16)
        for s, (lo, hi) in enumerate(bounds):
            codes[:, s] = nearest_rows(x[:, lo:hi], books.value[s])[0]
        lists = pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), len(bounds)).cast(pa.list_(pa.int16()))
        return pa.compute.if_else(pa.array(ok), lists, pa.scalar(None, lists.type))

    return encode(vector)


class VectorIndex:
    """The table's rows stored by cell; a search reads only the cells nearest the query.

    Centroids and codebooks are trained once; every row is then assigned. Cells that
    hold far more rows than others are written as several files by several tasks.
    Without a usable vector an index is untrained: its rows have no cell and every
    search reads them all; a refresh trains it.

    An index of a versioned table (rows with the column ``SOURCE``) knows which of the
    table's folders it covers. Folders are never changed, so a refresh assigns the
    rows of new ones only, and rows of folders that are gone are passed over.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._commits = Commits(spark, self.path)
        self.version = self._commits.version()
        if self.version < 0:
            raise ValueError(f"no vector index at {path}")
        self.state = self._commits.read(self.version)
        self.key, self.vector, self.metric = self.state["key"], self.state["vector"], self.state["metric"]
        self.nlist, self.dim, self.local = self.state["nlist"], self.state["dim"], self.state["local"]
        self.held: list[str] | None = None
        self.fresh: DataFrame | None = None

    def at(self, df: DataFrame, sources: Sequence[str]) -> VectorIndex:
        """The index for a table as it is now: ``df`` holds its rows with ``SOURCE``, from the folders ``sources``."""
        if self.state["sources"] is None:
            raise ValueError("the index was not built from a versioned table")
        out = copy(self)
        missing = [s for s in sources if s not in set(self.covered(sources))]
        out.held, out.fresh = list(sources), df.filter(F.col(SOURCE).isin(missing)) if missing else None
        return out

    # --- building -----------------------------------------------------------------

    @classmethod
    def build(
        cls,
        df: DataFrame,
        path: str,
        key: str,
        vector: str,
        nlist: int = 128,
        metric: str = "l2",
        *,
        local: Sequence[str] = (),
        own_centroids: bool = False,
        pq_segments: int | None = None,
        pq_codes: int = 256,
        train_rows: int | None = None,
        seed: int = 42,
        dim: int | None = None,
        sources: Sequence[str] | None = None,
        centroids: Sequence[Sequence[float]] | None = None,
        codebooks: Sequence[Sequence[Sequence[float]]] | None = None,
    ) -> VectorIndex:
        """Train centroids (and codebooks), assign every row, write a new version.

        ``local`` names partition columns: cells are then kept per partition. With
        ``own_centroids`` each partition also trains ``nlist`` centroids of its own, on
        a sample of its usable rows (``train_rows`` and ``OWN_TRAIN_BYTES`` at most),
        all partitions in one job; rows of a partition that had none to train on go to
        the nearest centroid of any. Else all partitions share centroids: KMeans
        sees a sample of ``train_rows`` usable rows, by default
        ``TRAIN_ROWS_PER_CENTRE`` for each centroid (or code, if these are more);
        every row is indexed. The vectors' length is ``dim``, else the one
        declared in the column's metadata, else the most frequent one; rows of
        another length have no cell. Given ``centroids`` (and ``codebooks``, one
        list of codes per segment) are used as they are.
        """
        name = find_metric(metric).name
        if name not in METRICS:
            raise ValueError(f"an IVF index serves {', '.join(METRICS)}, not {name}")
        if not 1 <= pq_codes <= 1 << 15:
            raise ValueError("pq_codes must lie between 1 and 32768")
        if own_centroids and (not local or centroids is not None):
            raise ValueError("own centroids need local partition columns and no given centroids")
        taken = {CELL, CODES, FAR, GROUP} & set(df.columns)
        if taken:
            raise ValueError(f"reserved column names: {', '.join(sorted(taken))}")
        options = {"nlist": nlist, "own_centroids": own_centroids, "pq_segments": pq_segments, "pq_codes": pq_codes, "train_rows": train_rows, "seed": seed}
        dim = dim or df.schema[vector].metadata.get("dim") or (len(centroids[0]) if centroids else None)
        centres, books, groups = None, None, None
        if centroids is not None:
            centres = np.array([[float32(x) for x in c] for c in centroids])
            books = [np.array(b, dtype=np.float64) for b in codebooks] if codebooks is not None else None
            if name == "cosine":
                centres = unit_rows(centres)
        else:
            dim, centres, books, groups = cls._train(df, path, vector, name, dim, local, **options)
        state = {
            "key": key,
            "vector": vector,
            "metric": name,
            "local": list(local),
            "nlist": 0 if centres is None else len(centres),
            "dim": dim,
            "segments": len(books) if books is not None else 0,
            "columns": [c for c in df.columns if c not in (SOURCE, *local)],
            "schema": df.schema.jsonValue(),
            "options": options,
            "parts": [],
            "sources": None,
        }
        return cls._append(df, path, state, centres, books, sources, groups)

    @classmethod
    def _train(cls, df, path, vector, metric, dim, local, nlist, own_centroids, pq_segments, pq_codes, train_rows, seed):
        """(length, centroids, codebooks, partitions of the centroids); no centroids where no row can be trained on."""
        spark, commits = df.sparkSession, Commits(df.sparkSession, path)
        usable = _trainable(df, vector, metric, local if own_centroids else ())
        lengths = {r["d"]: r["n"] for r in usable.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()}
        lengths.pop(0, None)
        if dim is None and lengths:
            dim = max(lengths, key=lambda d: (lengths[d], d))
        rows = lengths.get(dim, 0)
        if not rows:
            return dim, None, None, None
        usable = usable.filter(F.size("v") == dim)
        train_rows = train_rows or TRAIN_ROWS_PER_CENTRE * max(nlist, pq_codes if pq_segments else 0)
        if own_centroids:
            most = max(1, min(train_rows, OWN_TRAIN_BYTES // (8 * dim)))
            sizes = usable.groupBy(GROUP).agg(F.count("*").alias("n")).collect()  # one row per partition
            usable = usable.sampleBy(GROUP, {r[GROUP]: min(1.0, most / r["n"]) for r in sizes}, seed)
        elif rows > train_rows:
            usable = usable.sample(min(1.0, train_rows / rows), seed=seed)
        training = f"training-{uuid.uuid4().hex}"
        v, named = F.col("v"), [GROUP] if own_centroids else []
        usable.select((_normalised(v) if metric == "cosine" else v.cast("array<double>")).alias("v"), *named).write.parquet(f"{commits.root}/{training}")
        sample = spark.read.schema(", ".join(["v array<double>", *[f"{c} string" for c in named]])).parquet(f"{commits.root}/{training}")
        books, groups = None, None
        if own_centroids:
            centres, groups = _own_centres(sample, nlist, seed)
        else:
            centres = _centres(sample, nlist, seed)
        if pq_segments:

            def train(cut: tuple[int, int]) -> np.ndarray:
                return _centres(sample.select(F.slice("v", cut[0] + 1, cut[1] - cut[0]).alias("v")), pq_codes, seed)

            bounds = segment_bounds(dim, pq_segments)
            with ThreadPoolExecutor(min(8, len(bounds))) as pool:
                books = list(pool.map(train, bounds))
        commits.delete(training)
        return dim, centres if len(centres) else None, books, groups

    @classmethod
    def _append(cls, df, path, state, centres, books, sources, groups=None) -> VectorIndex:
        """Assign the rows of ``df`` and commit ``state`` with them as one more part."""
        spark, commits = df.sparkSession, Commits(df.sparkSession, path)
        part = uuid.uuid4().hex
        folder = f"{commits.root}/{part}"
        metric, local, dim = state["metric"], state["local"], state["dim"]
        vector = F.col(f"`{state['vector']}`")
        no_place = F.lit(None).cast("struct<cost: double, cell: int, far: double>")
        place = no_place if centres is None else _nearest(spark, vector, centres, metric, groups, _group_of(local) if groups else None)
        rows = df.withColumn("__place", place).withColumns({CELL: F.coalesce("__place.cell", F.lit(NO_CELL)), FAR: F.col("__place.far")}).drop("__place")
        if books is not None:
            rows = rows.withColumn(CODES, _encode(spark, vector, books, dim, metric))
        rows.hint("rebalance", *local, CELL).write.partitionBy(*local, CELL).parquet(f"{folder}/rows")
        labels = T.StructType([T.StructField(c, T.StringType()) for c in local])
        stored = spark.read.schema(T.StructType([T.StructField(FAR, T.DoubleType()), *labels, T.StructField(CELL, T.IntegerType())])).parquet(f"{folder}/rows")
        stored.groupBy(CELL, *local).agg(F.count("*").alias("rows"), F.min(FAR).alias("least"), F.max(FAR).alias("most")).coalesce(1).write.parquet(f"{folder}/bounds")
        if not state["parts"]:
            cls._write_trained(spark, folder, centres, books, groups)
        covered = None if sources is None else sorted(set(sources))
        commits.write(commits.version() + 1, {**state, "parts": [*state["parts"], part], "sources": covered})
        return cls(spark, path)

    @staticmethod
    def _write_trained(spark: SparkSession, folder: str, centres, books, groups) -> None:
        tables = [(s, c, row.tolist()) for s, book in enumerate(books or []) for c, row in enumerate(book)]
        spark.createDataFrame(tables, "segment int, code int, centre array<double>").write.parquet(f"{folder}/codebooks")
        rows = [] if centres is None else [(i, c.tolist(), groups[i] if groups else None) for i, c in enumerate(centres)]
        spark.createDataFrame(rows, f"{CELL} int, centroid array<double>, {GROUP} string").write.parquet(f"{folder}/centroids")

    def rebuild(self, df: DataFrame, **options) -> VectorIndex:
        """Train again on the current table."""
        options = {**self.state["options"], "metric": self.metric, "local": self.local, "dim": self.dim, **options}
        return self.build(df, self.path, self.key, self.vector, **options)

    def refresh(self, df: DataFrame, sources: Sequence[str] | None = None) -> VectorIndex:
        """Assign the current table to the centroids already trained.

        With the table's ``sources`` only rows of folders not covered yet are
        assigned; else all rows are. An untrained index is built.
        """
        if not self.nlist:
            return self.rebuild(df, sources=sources)
        centres, books, groups = self._centre_matrix(), self._books(), self._groups()
        if sources is None or self.state["sources"] is None:
            state = {**self.state, "parts": [], "schema": df.schema.jsonValue()}
            return self._append(df, self.path, state, centres, books, sources, groups)
        fresh = [s for s in sources if s not in self.state["sources"]]
        return self._append(df.filter(F.col(SOURCE).isin(fresh)), self.path, self.state, centres, books, sources, groups)

    # --- reading ------------------------------------------------------------------

    def _read(self, part: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{self.state['parts'][0]}/{part}")

    def rows(self, sources: Sequence[str] | None = None) -> DataFrame:
        """The table's columns plus ``CELL`` (and ``CODES``); only rows of folders the table has (or of ``sources``)."""
        fields = [f for f in T.StructType.fromJson(self.state["schema"]) if f.name not in self.local]
        fields += [T.StructField(FAR, T.DoubleType())]
        fields += [T.StructField(CODES, T.ArrayType(T.ShortType()))] if self.state["segments"] else []
        fields += [T.StructField(c, T.StringType()) for c in self.local] + [T.StructField(CELL, T.IntegerType())]
        rows = [self.spark.read.schema(T.StructType(fields)).parquet(f"{self.path}/{p}/rows") for p in self.state["parts"]]
        out = reduce(DataFrame.unionByName, rows)
        if self.state["sources"] is None:
            return out
        held = self.state["sources"] if sources is None else self.covered(sources)
        return out.filter(F.col(SOURCE).isin(held))

    def covered(self, sources: Sequence[str]) -> list[str]:
        """The folders among ``sources`` whose rows are indexed."""
        known = set(self.state["sources"] or ())
        return [s for s in sources if s in known]

    def centroids(self) -> DataFrame:
        return self._read("centroids", f"{CELL} int, centroid array<double>")

    def bounds(self, partitions: Sequence[str] | None = None) -> DataFrame:
        """Per cell: rows, and the least and most distance of one to the centroid (rows that the table has no more included).

        With ``partitions``, of the rows there, where the index is kept by partition.
        """
        fields = [T.StructField(c, T.StringType()) for c in self.local]
        schema = T.StructType(fields).add(CELL, T.IntegerType()).add("rows", T.LongType()).add("least", T.DoubleType()).add("most", T.DoubleType())
        parts = reduce(DataFrame.unionByName, [self.spark.read.schema(schema).parquet(f"{self.path}/{p}/bounds") for p in self.state["parts"]])
        levels = {PART} | ({SUBPART} if any("/" in p for p in partitions or ()) else set())
        chosen = in_partitions(parts, partitions if levels <= set(self.local) else None)
        return chosen.groupBy(CELL).agg(F.sum("rows").alias("rows"), F.min("least").alias("least"), F.max("most").alias("most"))

    def codebooks(self) -> DataFrame:
        return self._read("codebooks", "segment int, code int, centre array<double>")

    def _centre_matrix(self) -> np.ndarray:
        return np.array([r["centroid"] for r in self.centroids().orderBy(CELL).collect()])

    def groups(self) -> DataFrame:
        """Per cell the partition it was trained on, as JSON; null where partitions share centroids."""
        return self._read("centroids", f"{CELL} int, {GROUP} string")

    def _groups(self) -> list[str] | None:
        """The partition of each centroid; None where all partitions share them."""
        return [r[GROUP] for r in self.groups().orderBy(CELL).collect()] if self.state["options"].get("own_centroids") else None

    def _books(self) -> list[np.ndarray] | None:
        if not self.state["segments"]:
            return None
        codes = self.codebooks().orderBy("segment", "code").collect()
        return [
            np.array([r["centre"] for r in codes if r["segment"] == s]) for s in range(self.state["segments"])
        ]

    def _trained_form(self, query: Sequence[float]) -> np.ndarray:
        q = np.array([float32(v) for v in query])
        norm = float(np.sqrt((q * q).sum()))
        return q / norm if self.metric == "cosine" and norm > 0 else q

    def _centre_distance(self, query: Sequence[float]) -> Column:
        gap = F.zip_with("centroid", F.lit(self._trained_form(query)), lambda x, y: x - y)
        return F.sqrt(F.aggregate(gap, F.lit(0.0), lambda acc, d: acc + d * d))

    def near_cells(self, query: Sequence[float], nprobe: int) -> list[int]:
        far = self._centre_distance(query)
        return [r[CELL] for r in self.centroids().orderBy(far, CELL).limit(nprobe).select(CELL).collect()]

    def of_cells(self, rows: DataFrame, cells: Sequence[int] | None) -> DataFrame:
        """Rows of these cells, of all if None."""
        if cells is None or len(cells) <= IN_LIST_LIMIT:
            return rows if cells is None else rows.filter(F.col(CELL).isin(list(cells)))
        # a list of cell numbers: at most ``nlist`` of them
        return rows.join(F.broadcast(self.spark.createDataFrame([(int(c),) for c in cells], f"{CELL} int")), CELL, "left_semi")

    def probe(self, query: Sequence[float], nprobe: int, sources: Sequence[str] | None = None) -> DataFrame:
        """Rows of the ``nprobe`` cells nearest the query; all rows from ``nlist`` on.

        Of an index that stands for a table (``at``) also the rows it does not cover.
        """
        rows = self.of_cells(self.rows(self.held if sources is None else sources), None if nprobe >= self.nlist else self.near_cells(query, nprobe))
        return rows if self.fresh is None else rows.unionByName(self.fresh, allowMissingColumns=True)

    # --- which cells to read ----------------------------------------------------------

    def _reach(self, query: Sequence[float], partitions: Sequence[str] | None = None) -> list[tuple[float, float, int]]:
        """(least possible distance of a row, distance of the centroid, cell), nearest possible row first.

        By the triangle inequality a row as far as r from its centroid, which is d from
        the query, lies between |d - r| and d + r. One entry per cell that has rows (of the
        partitions, where the index is kept by partition).
        """
        known = self.centroids().select(CELL, self._centre_distance(query).alias("d")).join(self.bounds(partitions), CELL)
        least = F.greatest(F.lit(0.0), F.col("d") - F.col("most"), F.col("least") - F.col("d"))
        return sorted((r["reach"], r["d"], r[CELL]) for r in known.select(CELL, "d", least.alias("reach")).collect())

    def _in_space(self, score: float, digits: int | None) -> float:
        """The distance between a query and a row of this score where centroids live, rounded up."""
        score += 0.0 if digits is None else 10.0**-digits
        return float(np.sqrt(2 * max(score, 0.0))) if self.metric == "cosine" else score

    def cells_for(
        self,
        query: Sequence[float],
        k: int,
        nprobe: int = 8,
        *,
        exact: bool = False,
        allowed: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        threshold: float | None = None,
        digits: int | None = None,
        sources: Sequence[str] | None = None,
        partitions: Sequence[str] | None = None,
    ) -> list[int] | None:
        """Cells to read for the ``k`` best of the ``allowed`` rows; None where all rows are needed.

        Begins with ``nprobe`` cells and takes twice as many each round. Without
        ``exact`` the cells with the nearest centroids are taken until they hold ``k``
        allowed rows. With it, cells are taken by the least distance a row of theirs can
        have, until that passes the ``k``-th best found (or ``threshold``): what is left
        cannot change the result. A round reads its own cells only and returns at most
        ``k`` scores. ``partitions`` leaves out cells without rows there; ``allowed``
        must filter by it.
        """
        placed = len(query) == self.dim and not any(x != x for x in query) and (self.metric != "cosine" or any(query))
        if not self.nlist or not placed:
            return None
        cells = self._reach(query, partitions)
        if not exact:
            cells.sort(key=lambda c: (c[1], c[2]))
        wide = max((d for _, d, _ in cells), default=0.0)
        limit = float("inf") if threshold is None else self._in_space(threshold, digits)
        taken: list[int] = []
        best: list[float] = []
        found, step = 0, max(1, nprobe)
        while len(taken) < len(cells):
            some = [c for reach, _, c in cells[len(taken) : len(taken) + step] if not exact or reach <= limit + SLACK * (wide + limit if limit < float("inf") else 1.0)]
            if not some:
                return taken
            rows = allowed(self.of_cells(self.rows(sources), some))
            taken, step = taken + some, 2 * step
            if exact:
                near = knn(rows, query, self.vector, self.metric, k, key=self.key, names=[self.key], with_score=True, digits=digits).select(SCORE).collect()
                best = sorted(best + [r[SCORE] for r in near if r[SCORE] is not None])[:k]
                if len(best) == k:
                    limit = min(limit, self._in_space(best[-1], digits))
            else:
                found += rows.limit(k - found).count()
                if found >= k:
                    return taken
        return taken if exact and (len(best) == k or threshold is not None) else None

    def _approximate(self, query: Sequence[float]) -> Column:
        """Squared distance from the query to the coded form of a row, by table lookup."""
        q = self._trained_form(query)
        total = F.lit(0.0)
        for s, (book, (lo, hi)) in enumerate(zip(self._books(), segment_bounds(self.dim, self.state["segments"]))):
            table = F.lit(((book - q[lo:hi]) ** 2).sum(axis=1))
            total = total + F.get(table, F.get(F.col(CODES), s).cast("int"))
        return total

    def search(
        self,
        query: Sequence[float],
        k: int = 10,
        nprobe: int = 8,
        *,
        exact: bool = False,
        refine: int | None = None,
        where: Condition | None = None,
        partitions: Sequence[str] | None = None,
        names: Sequence[str] | None = None,
        threshold: float | None = None,
        post_filter: bool = False,
        expand: int | None = None,
        sources: Sequence[str] | None = None,
        fresh: DataFrame | None = None,
        digits: int | None = None,
        **options,
    ) -> DataFrame:
        """Top ``k`` of the probed cells by exact distance; takes the options of ``knn``.

        Reads the ``nprobe`` nearest cells; under a filter or a partition limit, more of
        them until ``k`` rows pass (a few small jobs find out). With ``exact`` it reads
        the cells that may hold one of the true ``k`` best, and no others. With
        ``refine``, the codes first pick the best ``k * refine`` rows and only those
        are ranked exactly. ``sources`` are the folders the table has now and ``fresh``
        its rows in folders the index does not cover: they are ranked exactly beside
        the cells.
        """
        narrow = post_filter and expand is not None
        limited = partitions is not None or (where is not None and not narrow)
        if exact or (limited and nprobe < self.nlist):

            def allowed(rows: DataFrame) -> DataFrame:
                return apply_filter(in_partitions(rows, partitions), None if narrow else where)

            ask = k * expand if narrow else k
            cells = self.cells_for(query, ask, nprobe, exact=exact, allowed=allowed, threshold=threshold, digits=digits, sources=sources, partitions=partitions)
            rows = self.of_cells(self.rows(sources), cells)
        else:
            rows = self.probe(query, nprobe, sources)
        rows = in_partitions(rows, partitions)
        options |= {"threshold": threshold}
        new = None if fresh is None else in_partitions(fresh, partitions)
        if narrow:
            options |= {"where": where, "post_filter": True, "expand": expand}
        else:
            rows = apply_filter(rows, where)
            new = None if new is None else apply_filter(new, where)
        if refine is not None:
            if not self.state["segments"]:
                raise ValueError("this index holds no codes")
            picked = (
                rows.select(self.key, rounded(self._approximate(query), digits).alias("__near"))
                .orderBy(F.col("__near").asc_nulls_last(), self.key)
                .limit(k * refine)
                .select(self.key)
            )
            small = k * refine <= BROADCAST_ROWS
            rows = rows.join(F.broadcast(picked) if small else picked, self.key, "left_semi")
        rows = rows.drop(CELL, FAR, CODES, SOURCE)
        if new is not None:
            rows = rows.unionByName(new.select(*rows.columns))
        return knn(rows, query, self.vector, self.metric, k, key=self.key, names=names or self.state["columns"], digits=digits, **options)

    def search_many(self, queries: DataFrame, query_key: str, query_vector: str, k: int = 10, nprobe: int = 8, **options) -> DataFrame:
        """The ``k`` nearest rows of every query: (query_id, key, score, rank); see ``cell_join``."""
        from .cell_join import cell_join

        return cell_join(self, queries, query_key, query_vector, k, nprobe, **options)
