"""Inverted lists of a sparse vector column (``map<index, weight>``)."""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..commits import Commits
from ..functions.vectors import float32, metric as find_metric
from ..operators.filters import IN_LIST_LIMIT, Condition, apply_filter, in_partitions
from ..operators.knn import knn

METRICS = ("ip", "l2", "cosine")
BUCKET = "__bucket"
ROWS_PER_BUCKET = 4_000_000
LEAST_BUCKETS = 8
# Sums in another order differ by less than this share.
SLACK = 1e-6


class SparseIndex:
    """The entries of all rows by index number, each row's norm, and each list's extreme weights.

    A search reads the lists of the query's numbers only: entries are stored in folders
    by a hash of the number and sorted by it. The rows they name are scored from their
    entries; rows that share no number with the query have a score that follows from
    their norm alone, which is stored in its own narrow table, sorted. The best are then
    scored from the vectors themselves, so the result is that of a scan.

    The index describes the rows it was built from; ``build`` again adds a version. Rows
    with a weight that is no finite number have no entries and rank as rows without a
    score.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        commits = Commits(spark, self.path)
        self.version = commits.version()
        if self.version < 0:
            raise ValueError(f"no sparse index at {path}")
        self.state = commits.read(self.version)
        self.key, self.vector, self.buckets = self.state["key"], self.state["vector"], self.state["buckets"]

    @classmethod
    def build(cls, df: DataFrame, path: str, key: str, vector: str, buckets: int | None = None) -> SparseIndex:
        spark, commits = df.sparkSession, Commits(df.sparkSession, path)
        kind = df.schema[vector].dataType
        if not isinstance(kind, T.MapType):
            raise ValueError(f"column {vector!r} holds no sparse vectors")
        name = uuid.uuid4().hex
        folder = f"{commits.root}/{name}"
        entries = F.map_entries(F.col(f"`{vector}`"))
        odd = F.exists(entries, lambda e: F.coalesce(F.isnan(e["value"].cast("double")) | (F.abs(e["value"].cast("double")) == math.inf), F.lit(True)))
        # vectors may be dear to make: they are made once, and counted, dealt and measured as stored
        df.select(F.col(f"`{key}`").alias("key"), F.when(~odd, entries).alias("entries")).write.parquet(f"{folder}/rows")
        entry = f"struct<key: {kind.keyType.simpleString()}, value: {kind.valueType.simpleString()}>"
        rows = spark.read.schema(f"key {df.schema[key].dataType.simpleString()}, entries array<{entry}>").parquet(f"{folder}/rows")
        if buckets is None:
            buckets = max(LEAST_BUCKETS, (rows.agg(F.sum(F.size("entries"))).first()[0] or 0) // ROWS_PER_BUCKET)
        weights = rows.select("key", F.explode("entries").alias("e")).select(F.col("e.key").alias("place"), "key", F.col("e.value").cast("double").alias("weight"))
        by_place = weights.withColumn(BUCKET, F.pmod(F.xxhash64("place"), F.lit(buckets)).cast("int"))
        by_place.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, "place").write.partitionBy(BUCKET).parquet(f"{folder}/entries")
        squared = F.aggregate("entries", F.lit(0.0), lambda acc, e: acc + e["value"].cast("double") * e["value"].cast("double"))
        rows.select("key", squared.alias("squared")).repartitionByRange("squared").sortWithinPartitions("squared", "key").write.parquet(f"{folder}/norms")
        commits.delete(f"{name}/rows")
        state = {"key": key, "vector": vector, "buckets": buckets, "folder": name, "key_type": df.schema[key].dataType.simpleString()}
        state["place_type"] = kind.keyType.simpleString()
        lists = cls._stored(spark, commits.root, state, "entries").groupBy(BUCKET, "place")
        lists = lists.agg(F.count("*").alias("rows"), F.max("weight").alias("most"), F.min("weight").alias("least"))
        lists.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, "place").write.partitionBy(BUCKET).parquet(f"{folder}/lists")
        commits.write(commits.version() + 1, state)
        return cls(spark, path)

    @staticmethod
    def _stored(spark: SparkSession, root: str, state: Mapping, part: str) -> DataFrame:
        schemas = {
            "entries": f"place {state['place_type']}, key {state['key_type']}, weight double, {BUCKET} int",
            "lists": f"place {state['place_type']}, rows long, most double, least double, {BUCKET} int",
            "norms": f"key {state['key_type']}, squared double",
        }
        return spark.read.schema(schemas[part]).parquet(f"{root}/{state['folder']}/{part}")

    def _of(self, part: str, places: Sequence[int]) -> DataFrame:
        """Entries or lists of these numbers: only their folders and row groups are read."""
        asked = self.spark.createDataFrame([(p,) for p in places], f"place {self.state['place_type']}")
        stored = self._stored(self.spark, self.path, self.state, part)
        bucket = F.pmod(F.xxhash64("place"), F.lit(self.buckets)).cast("int")
        if len(places) > IN_LIST_LIMIT:
            return stored.join(asked.withColumn(BUCKET, bucket), [BUCKET, "place"], "left_semi")
        buckets = [r[0] for r in asked.select(bucket).distinct().collect()]
        return stored.filter(F.col(BUCKET).isin(buckets) & F.col("place").isin(list(places)))

    def norms(self) -> DataFrame:
        return self._stored(self.spark, self.path, self.state, "norms")

    def lists(self, query: Mapping[int, float]) -> list[tuple[int, int, float, float]]:
        """(number, rows, least and most that an entry can add to the product) of the query's lists, shortest first."""
        found = self._of("lists", list(query)).collect()
        adds = [(r["place"], r["rows"], sorted((query[r["place"]] * r["least"], query[r["place"]] * r["most"]))) for r in found]
        return sorted(((p, n, low, high) for p, n, (low, high) in adds), key=lambda x: (x[1], x[0]))

    def _products(self, query: Mapping[int, float], places: Sequence[int], allowed: DataFrame | None) -> DataFrame:
        """(key, ip) summed over these lists."""
        if not places:
            return self.norms().select("key", F.lit(0.0).alias("ip")).limit(0)
        weight = F.lit(None).cast("double")
        if len(places) <= IN_LIST_LIMIT:
            weight = F.element_at(F.create_map(*[F.lit(x) for p in places for x in (p, float(query[p]))]), F.col("place"))
            rows = self._of("entries", places).withColumn("q", weight)
        else:
            asked = self.spark.createDataFrame([(p, float(query[p])) for p in places], f"place {self.state['place_type']}, q double")
            rows = self._of("entries", places).join(asked, "place")
        rows = rows if allowed is None else rows.join(allowed, "key", "left_semi")
        return rows.groupBy("key").agg(F.sum(F.col("weight") * F.col("q")).alias("ip"))

    def essential(self, query: Mapping[int, float], k: int, allowed: DataFrame | None = None) -> tuple[list[int], list[int]]:
        """(lists that a row of the best ``k`` by inner product must be in, the others).

        The shortest lists give a lower bound of the ``k``-th best product, as long as no
        entry lowers one. Lists that together add less than that cannot bring a row in
        by themselves; their entries are read for rows found elsewhere.
        """
        known = self.lists(query)
        places = [p for p, _, _, _ in known]
        if any(low < 0 for _, _, low, _ in known) or len(known) < 2:
            return places, []
        rows = 0
        for some, (_, n, _, _) in enumerate(known, 1):
            rows += n
            if rows >= 4 * k:
                break
        if some == len(known):
            return places, []
        best = [r["ip"] for r in self._products(query, places[:some], allowed).orderBy(F.desc("ip")).limit(k).select("ip").collect()]
        if len(best) < k:
            return places, []
        total, others = 0.0, []
        for p, _, _, high in sorted(known, key=lambda x: x[3]):
            total += high
            if total * (1 + SLACK) >= best[-1]:
                break
            others.append(p)
        return [p for p in places if p not in set(others)], others

    def candidates(self, query: Mapping[int, float], metric: str, k: int, allowed: DataFrame | None = None) -> DataFrame:
        """Keys among which the ``k`` best are, few more than these."""
        query = {int(p): float32(w) for p, w in query.items()}
        if metric == "ip":
            main, others = self.essential(query, k, allowed)
            found = self._products(query, main, allowed)
            if others:
                more = self._products(query, others, found.select("key"))
                found = found.join(more.withColumnRenamed("ip", "more"), "key", "left").select("key", (F.col("ip") + F.coalesce("more", F.lit(0.0))).alias("ip"))
            cost, rest_order, bare = -F.col("ip"), [F.col("squared").isNull()], 0.0
        else:
            found = self._products(query, [p for p, _, _, _ in self.lists(query)], allowed).join(self.norms(), "key")
            size = float(sum(w * w for w in query.values()))
            if metric == "l2":
                cost, rest_order, bare = F.col("squared") + F.lit(size) - 2 * F.col("ip"), [F.round("squared", 9).asc_nulls_last()], None
            else:
                cost = -F.col("ip") / F.sqrt(F.col("squared") * F.lit(size)) if size else F.lit(0.0)
                cost, rest_order, bare = F.when(F.col("squared") > 0, cost), [(F.coalesce("squared", F.lit(0.0)) == 0)], 0.0
        scored = found.select("key", cost.alias("cost"))
        ends = [r["cost"] for r in scored.orderBy(F.col("cost").asc_nulls_last()).limit(k).select("cost").collect()]
        full = len(ends) == k and ends[-1] is not None
        slack = SLACK * (1 + abs(ends[-1])) if full else 0.0
        near = scored.filter(F.col("cost") <= F.lit(ends[-1] + slack)) if full else scored
        # rows that share no number with the query
        if full and bare is not None and ends[-1] + slack < bare:
            return near.select("key")
        rest = self.norms()
        if full and bare is None:
            rest = rest.filter(F.col("squared") <= F.lit(ends[-1] + slack - size))
        rest = rest if allowed is None else rest.join(allowed, "key", "left_semi")
        rest = rest.join(scored, "key", "left_anti").orderBy(*rest_order, "key").limit(k)
        return near.select("key").unionByName(rest.select("key"))

    def search(
        self,
        df: DataFrame,
        query: Mapping[int, float],
        metric: str = "ip",
        k: int = 10,
        *,
        where: Condition | None = None,
        partitions: Sequence[str] | None = None,
        **options,
    ) -> DataFrame:
        """Top ``k`` rows of ``df``, whose rows the index describes; takes the options of ``knn``."""
        name = find_metric(metric).name
        if name not in METRICS:
            raise ValueError(f"sparse lists serve {', '.join(METRICS)}, not {name}")
        if not isinstance(query, Mapping):
            raise ValueError("a sparse query is a dict of numbers")
        allowed = None
        if where is not None or partitions is not None:
            allowed = apply_filter(in_partitions(df, partitions), where).select(F.col(f"`{self.key}`").alias("key"))
        best = self.candidates(query, name, k, allowed).withColumnRenamed("key", self.key)
        keys = [r[0] for r in best.limit(IN_LIST_LIMIT + 1).collect()]
        rows: DataFrame = df.join(best, self.key, "left_semi") if len(keys) > IN_LIST_LIMIT else df.filter(self._among(keys))
        return knn(rows, query, self.vector, name, k, key=self.key, **options)

    def _among(self, keys: list) -> Column:
        """A test that reaches the scan of the table."""
        return F.col(f"`{self.key}`").isin(keys) if keys else F.lit(False)
