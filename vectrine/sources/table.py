"""Tables as versioned Parquet folders.

A write adds a folder ``data/snap=<id>/part=<name>/...`` and then commits the
list of folders that now make up the table. Nothing is overwritten: append costs
the new rows only, and update, upsert and delete rewrite only the folders that
hold a changed row.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.filters import IN_LIST_LIMIT, Condition, all_of, id_list, id_rows, id_test, in_partitions, partition_test, single_key
from ..commits import CommitConflict, Commits
from .partitioning import PART, KeyPartition, Partition, from_dict
from .pruning import Facts, facts_of, levels_of
from .schema import auto_id_column, conform, key_columns

# Names of columns that rows carry inside the library only.
SNAP, BUCKET, SOURCE = "__snap", "__part", "__source"
# A table without partitions is stored by a hash of its key, so that a change rewrites
# a bucket and not everything.
KEY_BUCKETS = 16
BROADCAST_FILES = 200_000


class DuplicateKey(ValueError):
    """A row's key is already taken."""


def with_dense_ids(spark: SparkSession, path: str, column: str, start: int, dtype: T.DataType) -> DataFrame:
    """The Parquet rows at ``path`` with consecutive ids from ``start``.

    A row's place is its file's offset plus its number within the file, so every
    attempt of a task gives a row the same id. Only the list of files, one row
    each, passes through a single task.
    """
    rows = spark.read.parquet(path).select("*", "_metadata.file_path", "_metadata.row_index")
    files = rows.groupBy("file_path").agg(F.count("*").alias("n"))
    before = Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("file_path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.col("offset") + F.col("row_index") + F.lit(start)
    few = len(rows.inputFiles()) <= BROADCAST_FILES
    return (
        rows.join(F.broadcast(offsets) if few else offsets, "file_path")
        .withColumn(column, place.cast(dtype))
        .drop("file_path", "row_index", "offset")
    )


def last_per_key(rows: DataFrame, key: Sequence[str], order_by: Column | str) -> DataFrame:
    """One row per key, the last by ``order_by``.

    Aggregates before the shuffle, so a key repeated a million times sends one
    row per task.
    """
    ordered = rows.withColumn("__order", F.expr(order_by) if isinstance(order_by, str) else order_by)
    kept = ordered.groupBy(*key).agg(F.max_by(F.struct(*rows.columns), "__order").alias("row"))
    return kept.select("row.*")


def literal(value, dtype: T.DataType) -> Column:
    """A Column for a value given in an update."""
    if isinstance(value, Column):
        return value.cast(dtype)
    if isinstance(value, Mapping) and isinstance(dtype, T.StringType):
        return F.lit(json.dumps(value))
    if isinstance(value, Mapping):
        return F.create_map(*[F.lit(x) for kv in value.items() for x in kv]).cast(dtype)
    if isinstance(value, (list, tuple)):
        return F.array(*[F.lit(v) for v in value]).cast(dtype)
    return F.lit(value).cast(dtype)


class Table:
    """One table at a folder every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._commits = Commits(spark, self.root)
        self.version = -1
        self.refresh()

    @classmethod
    def create(
        cls, spark: SparkSession, root: str, schema: T.StructType, partition: Partition | None = None, key_buckets: int = KEY_BUCKETS
    ) -> Table:
        """An empty table, version 0. Without partitions, rows are stored in ``key_buckets`` buckets of their key."""
        hidden = {SNAP, BUCKET, SOURCE} & set(schema.fieldNames())
        if hidden:
            raise ValueError(f"reserved column names: {', '.join(sorted(hidden))}")
        keys = key_columns(schema)
        buckets = KeyPartition(keys, [f"b{i:04d}" for i in range(key_buckets)]) if keys and partition is None and key_buckets > 1 else None
        Commits(spark, root).write(
            0,
            {
                "schema": schema.jsonValue(),
                "partition": partition.to_dict() if partition else None,
                "buckets": buckets.to_dict() if buckets else None,
                "folders": [],
                "retired": [],
            },
        )
        return cls(spark, root)

    @classmethod
    def exists(cls, spark: SparkSession, root: str) -> bool:
        return Commits(spark, root).version() >= 0

    def refresh(self) -> Table:
        """Move to the newest committed version."""
        version = self._commits.version()
        if version < 0:
            raise ValueError(f"no table at {self.root}")
        if version != self.version:
            self._state = self._commits.read(version)
            self.version = version
        return self

    # --- reading ------------------------------------------------------------------

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self._state["schema"])

    @property
    def key(self) -> list[str]:
        return key_columns(self.schema)

    @property
    def partition(self) -> Partition | None:
        return from_dict(self._state["partition"]) if self._state["partition"] else None

    @property
    def _labels(self) -> list[str]:
        return self.partition.levels() if self.partition else []

    @property
    def _rules(self) -> list[tuple[str, Partition]]:
        """The levels of folders, from the outermost on, each with its rule."""
        if self.partition is not None:
            return list(zip(self._labels, [self.partition, self.partition.sub]))
        buckets = self._state.get("buckets")
        return [(BUCKET, from_dict(buckets))] if buckets else []

    @property
    def _layout(self) -> dict[str, Column]:
        """The columns that name a row's folder."""
        return {name: rule.label() for name, rule in self._rules}

    def _touched(self, folders: Sequence[str], where: Condition | None = None, ids: Sequence | None = None) -> tuple[list[str], Column]:
        """(folders, test on their levels) that leave out only rows which fail the predicate or have another key."""
        facts = facts_of(self.spark.createDataFrame([], self.schema), self._own(where))
        if ids is not None and len(ids) <= IN_LIST_LIMIT:
            key = single_key(self.key)
            facts.setdefault(key, Facts()).among([F.lit(i).try_cast(self.schema[key].dataType) for i in ids])
        kept, test = list(folders), F.lit(True)
        for i, (level, names) in enumerate(levels_of(self.spark, self._rules, self.schema, facts).items() if facts else ()):
            if level == self._rules[0][0]:
                ends = {f"/{level}={n}" for n in names}
                kept = [f for f in kept if f"/{unquote(f).partition('/')[2]}" in ends]
            test = test & (F.col(level).isin(sorted(names)) if names else F.lit(False))
        return kept, test

    def _own(self, where: Condition | None) -> Column | None:
        """The condition, if it reads the table's own columns only; a limit to named partitions prunes by itself."""
        condition = all_of(where)
        if condition is None:
            return None
        try:
            self.spark.createDataFrame([], self.schema).filter(condition)
        except AnalysisException:
            return None
        return condition

    @property
    def sources(self) -> list[str]:
        """Names of the folders that make up the table; the rows in one never change."""
        return [unquote(f) for f in self._state["folders"]]

    def _source(self) -> Column:
        """The name of a row's folder."""
        parts = [F.lit(f"{SNAP}="), F.col(SNAP)]
        for level in list(self._layout)[:1]:
            parts += [F.lit(f"/{level}="), F.col(level)]
        return F.concat(*parts)

    def _scan(self, folders: Sequence[str]) -> DataFrame:
        """Rows of these folders with the columns that name them."""
        labels = [T.StructField(name, T.StringType()) for name in [SNAP, *self._layout]]
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in self.schema] + labels)
        if not folders:
            return self.spark.createDataFrame([], schema)
        data = f"{self.root}/data"
        paths = [f"{data}/{folder}" for folder in folders]
        return self.spark.read.schema(schema).option("basePath", data).parquet(*paths)

    def df(
        self, partitions: Sequence[str] | None = None, labels: bool = False, source: bool = False, *, where: Condition | None = None, ids: Sequence | None = None
    ) -> DataFrame:
        """The table's rows; ``labels`` keeps the partition columns, ``source`` names each row's folder.

        With ``where`` or ``ids`` (a list of keys) folders that cannot hold such a row
        are left out; the rows themselves are not filtered.
        """
        folders, test = self._state["folders"], None
        if self._rules and (where is not None or ids is not None):
            folders, test = self._touched(folders, where, ids)
        rows = in_partitions(self._scan(folders), partitions)
        rows = rows if test is None else rows.filter(test)
        extra = [F.col(c) for c in (self._labels if labels else [])] + ([self._source().alias(SOURCE)] if source else [])
        return rows.select(*[F.col(f"`{c}`") for c in self.schema.fieldNames()], *extra)

    # --- writing ------------------------------------------------------------------

    def _write(self, rows: DataFrame) -> list[str]:
        """Write rows under a new snapshot id; returns the folders that hold them."""
        snap = f"{SNAP}={uuid.uuid4().hex}"
        path = f"{self.root}/data/{snap}"
        layout = self._layout
        if not layout:
            rows.write.parquet(path)
            return [snap]
        misfit = F.raise_error(F.lit("a row fits no partition")).cast("string")
        labelled = rows.withColumns({name: F.coalesce(label, misfit) for name, label in layout.items()})
        # brings a partition's rows together, and splits a partition too big for one task
        labelled.hint("rebalance", *layout).write.partitionBy(*layout).parquet(path)
        return [f"{snap}/{name}" for name in self._commits.folders(path)]

    def _commit(self, build: Callable[[dict], dict | None], again: bool = False) -> None:
        """Apply ``build`` to the newest state.

        With ``again`` it is repeated after a conflict, on the state that won, until
        it is committed; every conflict means that another writer got on.
        """
        while True:
            self.refresh()
            changed = build(dict(self._state))
            if changed is None:
                return
            try:
                self._commits.write(self.version + 1, changed)
                break
            except CommitConflict:
                if not again:
                    raise
        self.refresh()

    def _replace(self, old: Sequence[str], new: Sequence[str]) -> None:
        """Swap folders; fails if another writer got there first."""
        expected = self.version

        def build(state: dict) -> dict:
            if self.version != expected:
                raise CommitConflict(f"{self.root} changed since version {expected}")
            gone = set(old)
            return {**state, "folders": [f for f in state["folders"] if f not in gone] + list(new)}

        self._commit(build)

    def _folders_of(self, rows: DataFrame) -> list[str]:
        """Folders holding any of these rows (at most one entry per folder comes back)."""
        names = {r[0] for r in rows.select(self._source().alias(SOURCE)).distinct().collect()}
        return [f for f in self._state["folders"] if unquote(f) in names]

    def _no_duplicates(self, rows: DataFrame) -> None:
        twice = rows.groupBy(*self.key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
        found = twice.limit(1).collect()
        if found:
            raise DuplicateKey(f"key {[found[0][c] for c in self.key]} occurs more than once")

    def _belongs(self, rows: DataFrame, partition: str | None) -> DataFrame:
        """Fail on a row outside the named partition."""
        if not partition:
            return rows
        if self.partition is None:
            raise ValueError("the table has no partitions")
        inside = partition_test(partition)
        labelled = self.partition.assign(rows)
        first = rows.columns[0]
        problem = F.raise_error(F.lit(f"a row does not belong to partition {partition}"))
        checked = F.when(F.coalesce(inside, F.lit(False)), F.col(first)).otherwise(
            problem.cast(rows.schema[first].dataType)
        )
        return labelled.withColumn(first, checked).select(*rows.columns)

    def insert(self, rows: DataFrame, partition: str | None = None, check_keys: bool = True) -> Table:
        """Append rows. Keys must be new; no rows is a no-op.

        The rows are written before they are checked, so an expensive input is
        computed once. Concurrent inserts retry until each is committed.
        """
        auto, staged = auto_id_column(self.schema), None
        if auto is not None and auto not in rows.columns:
            staged = f"staged/{uuid.uuid4().hex}"
            path = f"{self.root}/{staged}"
            conform(rows, self.schema, skip=[auto]).write.parquet(path)
            start = self._reserve(auto, self.spark.read.parquet(path).count())
            rows = with_dense_ids(self.spark, path, auto, start, self.schema[auto].dataType)
        folders = self._write(self._belongs(conform(rows, self.schema), partition))
        if staged:
            self._commits.delete(staged)
        written = self._scan(folders)
        if not folders or written.isEmpty():
            return self
        # ids just reserved are nobody else's
        check_keys = check_keys and bool(self.key) and not (staged and self.key == [auto])
        if check_keys:
            self._no_duplicates(written)
        bounds = self._key_bounds(folders)
        highest = written.agg(F.max(auto)).first()[0] if auto and not staged else None

        def build(state: dict) -> dict:
            near = self._overlapping(state, bounds) if check_keys else []
            if near:
                taken = self._scan(near).select(*self.key).join(self._scan(folders).select(*self.key), self.key, "left_semi")
                clash = taken.limit(1).collect()
                if clash:
                    raise DuplicateKey(f"key {list(clash[0])} exists already")
            if highest is not None:
                state["next_id"] = max(state.get("next_id", 1), int(highest) + 1)
            return {**state, "folders": state["folders"] + folders, "bounds": {**state.get("bounds", {}), **bounds}}

        self._commit(build, again=True)
        return self

    def _key_bounds(self, folders: Sequence[str]) -> dict[str, list]:
        """Per folder the least and the largest key, for one key column of whole numbers or text; a row per folder comes back."""
        kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType)
        if len(self.key) != 1 or not isinstance(self.schema[self.key[0]].dataType, kinds) or not folders:
            return {}
        key = F.col(f"`{self.key[0]}`")
        ends = self._scan(folders).groupBy(self._source().alias(SOURCE)).agg(F.min(key).alias("a"), F.max(key).alias("b")).collect()
        found = {r[SOURCE]: [r["a"], r["b"]] for r in ends}
        return {f: found[unquote(f)] for f in folders if unquote(f) in found}

    def _overlapping(self, state: dict, bounds: Mapping[str, list]) -> list[str]:
        """The table's folders that may hold a key of the new ones.

        A key lies in one bucket or partition if the layout is by the key; bounds are
        compared as Python compares them, which for text is the order of code points,
        as Spark's is of UTF-8 bytes.
        """
        rule = self._rules[0][1] if len(self._rules) == 1 else None
        apart = rule is not None and getattr(rule, "columns", None) == self.key

        def level(folder: str) -> str:
            return unquote(folder).partition("/")[2] if apart else ""

        old, out = state.get("bounds", {}), []
        for f in state["folders"]:
            if f not in old or not bounds or any(level(f) == level(g) and old[f][0] <= b and a <= old[f][1] for g, (a, b) in bounds.items()):
                out.append(f)
        return out

    def _reserve(self, auto: str, count: int) -> int:
        """The first of ``count`` ids that no other insert gets; ids once reserved are not given again."""
        start = 0

        def build(state: dict) -> dict:
            nonlocal start
            start = state.get("next_id")
            if start is None:
                start = (self.df().agg(F.max(auto)).first()[0] or 0) + 1
            return {**state, "next_id": start + count}

        self._commit(build, again=True)
        return start

    def upsert(self, rows: DataFrame, partition: str | None = None, order_by: Column | str | None = None) -> Table:
        """Replace whole rows by key, add those that are new.

        ``order_by`` says which of several rows of one key is the last, which wins;
        without it a key may occur once. Columns the batch lacks become NULL.
        """
        if not self.key:
            raise ValueError("upsert needs a primary key")
        self.refresh()
        if order_by is not None:
            extra = isinstance(order_by, str) and order_by in rows.columns and order_by not in self.schema.fieldNames()
            rows = last_per_key(rows, self.key, order_by)
            rows = rows.drop(order_by) if extra else rows
        added = self._write(self._belongs(conform(rows, self.schema), partition))
        if not added:
            return self
        if order_by is None:
            self._no_duplicates(self._scan(added))
        keys = self._scan(added).select(*self.key)
        touched = self._folders_of(self._scan(self._state["folders"]).join(keys, self.key, "left_semi"))
        kept = self._rewrite(touched, lambda old: old.join(keys, self.key, "left_anti"))
        self._replace(touched, added + kept)
        return self

    def _rewrite(self, folders: Sequence[str], change: Callable[[DataFrame], DataFrame]) -> list[str]:
        if not folders:
            return []
        changed = change(self._scan(folders))
        return self._write(changed.select(*self.schema.fieldNames()))

    def update(self, values: Mapping, where: Condition | None = None, partition: str | None = None) -> Table:
        """Set columns on the rows where the condition is TRUE; no condition means all rows."""
        self.refresh()
        fields = {n: self.schema[n] for n in values}
        hit = self._condition(where, partition)
        rows = self._scan(self._touched(self._state["folders"], where)[0])
        touched = self._folders_of(rows.filter(hit))
        new = {n: F.when(hit, literal(v, fields[n].dataType)).otherwise(F.col(n)) for n, v in values.items()}
        folders = self._rewrite(touched, lambda old: conform(old.withColumns(new).select(*self.schema.fieldNames()), self.schema))
        if set(values) & set(self.key):
            untouched = [f for f in self._state["folders"] if f not in touched]
            self._no_duplicates(self._scan(untouched + folders))
        self._replace(touched, folders)
        return self

    def _condition(self, where: Condition | None, partition: str | None) -> Column:
        """TRUE or FALSE per row, never NULL."""
        parts = [c for c in (all_of(where), partition_test(partition) if partition else None) if c is not None]
        hit = F.lit(True)
        for p in parts:
            hit = hit & p
        return F.coalesce(hit, F.lit(False))

    def delete(self, ids=None, where: Condition | None = None, partition: str | None = None) -> Table:
        """Delete the rows that meet every given condition; without any, all rows."""
        self.refresh()
        everything = self._state["folders"]
        if ids is None and where is None and (not partition or "/" not in partition):
            gone = [f for f in everything if not partition or unquote(f).endswith(f"/{PART}={partition}")]
            self._replace(gone, [])
            return self
        hit = self._condition(where, partition)
        listed = id_list(ids) if ids is not None and not isinstance(ids, DataFrame) else None
        rows = self._scan(self._touched(everything, where, listed)[0])
        key = single_key(self.key) if ids is not None else None
        if ids is not None and not isinstance(ids, DataFrame):
            ids = id_list(ids)
            if len(ids) <= IN_LIST_LIMIT:
                hit, ids = F.coalesce(hit & id_test(rows, key, ids), F.lit(False)), None
            else:
                ids = id_rows(rows, key, ids)
        if ids is None:
            touched = self._folders_of(rows.filter(hit))
            kept = self._rewrite(touched, lambda old: old.filter(~hit))
        else:
            doomed = rows.filter(hit).join(ids.select(key), key, "left_semi")
            touched = self._folders_of(doomed)
            kept = self._rewrite(touched, lambda old: old.join(doomed.select(key), key, "left_anti"))
        self._replace(touched, kept)
        return self

    # --- schema changes -----------------------------------------------------------

    def add_columns(self, fields: Sequence[T.StructField]) -> Table:
        """New columns, NULL on existing rows. Files stay as they are.

        Only re-adding a name that was dropped before rewrites the rows, so that
        the old values cannot reappear.
        """

        def build(state: dict) -> dict:
            schema = T.StructType.fromJson(state["schema"])
            for f in fields:
                if f.name in schema.fieldNames():
                    raise ValueError(f"column {f.name!r} exists already")
                if f.name in (SNAP, BUCKET, SOURCE):
                    raise ValueError(f"reserved column name {f.name!r}")
                if not f.nullable and state["folders"]:
                    raise ValueError(f"column {f.name!r} must be nullable")
            changed = {**state, "schema": T.StructType([*schema, *fields]).jsonValue()}
            if set(state["retired"]) & {f.name for f in fields}:
                changed |= {"folders": self._rewrite(state["folders"], lambda old: old), "retired": []}
            return changed

        self._commit(build, again=True)
        return self

    def drop_columns(self, names: Sequence[str]) -> Table:
        """Remove columns from the schema; their stored values are no longer read."""

        def build(state: dict) -> dict:
            schema = T.StructType.fromJson(state["schema"])
            missing = set(names) - set(schema.fieldNames())
            if missing:
                raise ValueError(f"no columns {', '.join(sorted(missing))}")
            left = T.StructType([f for f in schema if f.name not in names])
            return {**state, "schema": left.jsonValue(), "retired": sorted({*state["retired"], *names})}

        self._commit(build, again=True)
        return self
