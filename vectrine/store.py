"""A folder of named tables with their indexes: the calls of a retrieval client.

Reads return lazy DataFrames; writes take DataFrames, or a dict or list of dicts
for a handful of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.sqlfuncs import run_sql
from .functions.vectors import Query
from .indexes.postings import TextIndex
from .indexes.vectors import VectorIndex
from .operators import filters
from .operators.bm25 import bm25_search, match_against
from .operators.hybrid import hybrid_search, search_hybrid
from .operators.knn import knn, search
from .operators.knn_join import knn_join
from .commits import Commits
from .sources.partitioning import Partition
from .sources.schema import MAX_LENGTH, DataType, quick_schema
from .sources.table import SOURCE, Table

Rows = DataFrame | Mapping | Sequence[Mapping]


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def _index_path(self, table: str, name: str) -> str:
        return f"{self.root}/indexes/{table}/{name}"

    # --- tables -------------------------------------------------------------------

    def create_table(
        self, name: str, schema: T.StructType, partitions: Partition | None = None, index_params: Sequence[Mapping] = ()
    ) -> Table:
        """Create an empty table with its indexes; an existing one is kept as it is.

        Each of ``index_params`` holds ``name`` and ``column``, for a text index
        ``kind="text"``, and the options of ``create_vector_index`` or
        ``create_text_index``.
        """
        if self.has_collection(name):
            return self.table(name)
        table = Table.create(self.spark, self._path(name), schema, partitions)
        for params in index_params:
            given = dict(params)
            make = {"vector": self.create_vector_index, "text": self.create_text_index}[given.pop("kind", "vector")]
            make(name, given.pop("name"), given.pop("column"), **given)
        return table

    def create_collection(
        self,
        name: str,
        dimension: int | None = None,
        primary_field_name: str = "id",
        id_type: DataType | str = DataType.INT64,
        vector_field_name: str = "vector",
        auto_id: bool = False,
        max_length: int = MAX_LENGTH,
        schema: T.StructType | None = None,
        partitions: Partition | None = None,
        metric_type: str = "l2",
        index_params: Sequence[Mapping] = (),
    ) -> Table:
        """A table from ``schema``, or a quick one of a key and a vector with its usual metric."""
        if schema is None:
            schema = quick_schema(dimension, primary_field_name, id_type, vector_field_name, auto_id, max_length, metric_type)
        return self.create_table(name, schema, partitions, index_params)

    def table(self, name: str) -> Table:
        return Table(self.spark, self._path(name))

    load_collection = table

    def has_collection(self, name: str) -> bool:
        return Table.exists(self.spark, self._path(name))

    def drop_collection(self, name: str) -> None:
        """Delete a table and its indexes, if it exists."""
        Commits(self.spark, f"{self.root}/indexes/{name}").delete_all()
        Commits(self.spark, self._path(name)).delete_all()

    def rename_collection(self, old: str, new: str) -> None:
        """Move a table; its indexes go along."""
        Commits(self.spark, self._path(old)).move_to(self._path(new))
        indexes = Commits(self.spark, f"{self.root}/indexes/{old}")
        for index in indexes.folders(indexes.root):
            Commits(self.spark, self._index_path(old, index)).move_to(self._index_path(new, index))

    def get_collection_stats(self, name: str) -> DataFrame:
        """One row: ``row_count``."""
        return filters.row_count(self.table(name).df())

    def _rows(self, table: Table, data: Rows) -> DataFrame | None:
        if isinstance(data, DataFrame):
            return data
        records = [data] if isinstance(data, Mapping) else list(data)
        if not records:
            return None
        names = list(dict.fromkeys(n for r in records for n in r))
        unknown = set(names) - set(table.schema.fieldNames())
        if unknown:
            raise ValueError(f"unknown columns: {', '.join(sorted(unknown))}")
        schema = T.StructType([T.StructField(n, table.schema[n].dataType) for n in names])
        return self.spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)

    def insert(self, name: str, data: Rows, partition: str | None = None, check_keys: bool = True) -> None:
        table = self.table(name)
        rows = self._rows(table, data)
        if rows is not None:
            table.insert(rows, partition, check_keys)

    def upsert(self, name: str, data: Rows, partition: str | None = None, order_by: Column | str | None = None) -> None:
        """Replace or add rows by key; of the dicts of a list with one key the last wins."""
        table = self.table(name)
        if not isinstance(data, DataFrame) and order_by is None:
            records = [data] if isinstance(data, Mapping) else list(data)
            last = {tuple(r.get(c) for c in table.key): r for r in records}
            data = list(last.values())
        rows = self._rows(table, data)
        if rows is not None:
            table.upsert(rows, partition, order_by)

    def update(self, name: str, values: Mapping, where=None, partition: str | None = None) -> None:
        self.table(name).update(values, where, partition)

    def delete(self, name: str, ids=None, where=None, partition: str | None = None) -> None:
        self.table(name).delete(ids, where, partition)

    def add_columns(self, name: str, fields: Sequence[T.StructField]) -> None:
        self.table(name).add_columns(fields)

    def drop_columns(self, name: str, columns: Sequence[str]) -> None:
        self.table(name).drop_columns(columns)

    # --- reads --------------------------------------------------------------------

    def _open(
        self, name: str, names: Sequence[str] | None, where: filters.Condition | None = None, ids: list | None = None
    ) -> tuple[Table, DataFrame, Sequence[str]]:
        """The table and its rows, without partitions that the predicate or the keys rule out."""
        table = self.table(name)
        return table, table.df(labels=True, where=where, ids=ids), names or table.schema.fieldNames()

    def get(self, name: str, ids=None, where=None, names=None, partitions=None, limit: int | None = None) -> DataFrame:
        listed = filters.id_list(ids) if ids is not None and not isinstance(ids, DataFrame) else None
        table, rows, names = self._open(name, names, where, listed)
        return filters.get(rows, table.key, ids, where, names, partitions, limit)

    def query(self, name: str, where=None, names=None, columns=None, extra=None, partitions=None) -> DataFrame:
        _, rows, names = self._open(name, names, where)
        return filters.query(rows, where, names, columns, extra, partitions)

    def ann_search(
        self,
        name: str,
        query: Query,
        column: str,
        metric: str | None = None,
        k: int = 10,
        *,
        names=None,
        index: str | None = None,
        nprobe: int = 8,
        refine: int | None = None,
        **options,
    ) -> DataFrame:
        """Nearest rows by ``metric`` (else the column's, else l2): exact, or through a vector index.

        Through an index, rows written after it was built are ranked too and rows
        gone since are not found.
        """
        table, rows, names = self._open(name, names, None if options.get("post_filter") else options.get("where"))
        usual = table.schema[column].metadata.get("metric", "l2") if column in table.schema.fieldNames() else "l2"
        if index is None:
            return knn(rows, query, column, metric or usual, k, key=table.key, names=names, **options)
        found = self._index_of(name, index, column, metric)
        fresh = self._not_covered(table.df(labels=True, source=True), table, found)
        return found.search(query, k, nprobe, refine=refine, names=names, sources=table.sources, fresh=fresh, **options)

    def _index_of(self, name: str, index: str, column: str, metric: str | None) -> VectorIndex:
        found = self.vector_index(name, index)
        if column != found.vector or (metric or found.metric) != found.metric:
            raise ValueError(f"index {index!r} serves {found.metric} on {found.vector!r}")
        return found

    @staticmethod
    def _not_covered(rows: DataFrame, table: Table, index: VectorIndex) -> DataFrame | None:
        """The table's rows in folders the index does not know."""
        missing = set(table.sources) - set(index.covered(table.sources))
        return rows.filter(F.col(SOURCE).isin(sorted(missing))) if missing else None

    def ann_search_many(
        self, name: str, queries: DataFrame, query_key: str, query_vector: str, column: str, metric: str | None = None, k: int = 10,
        *, index: str | None = None, nprobe: int = 8, digits: int | None = None,
    ) -> DataFrame:
        """Nearest rows of every query, (query_id, key, score, rank): exact, or through the cells of a vector index."""
        table = self.table(name)
        rows, key = table.df(source=True), filters.single_key(table.key)
        if index is None:
            usual = table.schema[column].metadata.get("metric", "l2")
            return knn_join(queries, rows, query_key=query_key, query_vector=query_vector, key=key, vector=column, metric=metric or usual, k=k, digits=digits)
        found = self._index_of(name, index, column, metric)
        fresh = self._not_covered(rows, table, found)
        return found.search_many(queries, query_key, query_vector, k, nprobe, digits=digits, sources=table.sources, fresh=fresh)

    def post_ann_search(self, name: str, query: Query, column: str, metric: str | None = None, k: int = 10, **options) -> DataFrame:
        """``ann_search`` without a threshold or an index."""
        if {"threshold", "index"} & set(options):
            raise TypeError("post_ann_search takes no threshold and no index")
        return self.ann_search(name, query, column, metric, k, **options)

    def search(self, name: str, query: Query, column: str = "vector", *, names=None, **options) -> DataFrame:
        table, rows, names = self._open(name, names)
        return search(rows, query, column, key=table.key, names=names, **options)

    def bm25_search(
        self, name: str, text: str, column: str, k: int = 10, *, names=None, index: str | None = None, **options
    ) -> DataFrame:
        table, rows, names = self._open(name, names)
        if index is not None:
            found = self.text_index(name, index)
            if found.columns != [column]:
                raise ValueError(f"index {index!r} reads {found.columns}, not {column!r}")
            return found.search(table.df(labels=True, source=True), text, k, names=names, sources=table.sources, **options)
        return bm25_search(rows, text, column, k, key=table.key, names=names, **options)

    def match_against(
        self, name: str, text: str, columns: Sequence[str], k: int = 10, *, names=None, index: str | None = None, **options
    ) -> DataFrame:
        table, rows, names = self._open(name, names)
        if index is not None:
            rows = table.df(labels=True, source=True)
            options |= {"index": self.text_index(name, index), "sources": table.sources}
        return match_against(rows, text, columns, k, key=table.key, names=names, **options)

    def hybrid_search(
        self, name: str, body: Mapping, *, text_indexes: Mapping[str, str] | None = None, vector_index: str | None = None, **options
    ) -> DataFrame:
        """``text_indexes`` names the index of each scored field, ``vector_index`` that of the vector.

        Rows that an index does not cover yet are ranked beside it and rows gone since
        are passed over, so the result is that of the table; nothing is written.
        """
        table = self.table(name)
        rows = table.df(source=True)
        if text_indexes:
            options["text_indexes"] = {field: self.text_index(name, index).at(rows, table.sources) for field, index in text_indexes.items()}
        if vector_index is not None:
            options["vector_index"] = self.vector_index(name, vector_index).at(rows, table.sources)
        return hybrid_search(table.df(), body, key=filters.single_key(table.key), **options)

    def search_hybrid(
        self, name: str, query: Query, column: str, text: str, text_column: str, *, names=None, text_index: str | None = None, **options
    ) -> DataFrame:
        table, rows, names = self._open(name, names)
        if text_index is not None:
            options["text_index"] = self.text_index(name, text_index).at(table.df(source=True), table.sources)
        return search_hybrid(rows, query, column, text, text_column, key=table.key, names=names, **options)

    def sql(self, text: str, tables: Sequence[str], args: Mapping | None = None) -> DataFrame:
        """SQL text over the named tables, with the distance functions available."""
        return run_sql(self.spark, text, {t: self.table(t).df() for t in tables}, args)

    # --- indexes ------------------------------------------------------------------

    def create_vector_index(self, name: str, index: str, column: str, **options) -> VectorIndex:
        """An IVF index; on a partitioned table its cells are kept per partition."""
        table = self.table(name)
        local = table.partition.levels() if table.partition else []
        key = filters.single_key(table.key)
        path = self._index_path(name, index)
        return VectorIndex.build(table.df(labels=True, source=True), path, key, column, local=local, sources=table.sources, **options)

    def create_text_index(self, name: str, index: str, column: str | Sequence[str], **options) -> TextIndex:
        table = self.table(name)
        return TextIndex.build(
            table.df(labels=True, source=True), self._index_path(name, index), filters.single_key(table.key), column, **options
        )

    def vector_index(self, name: str, index: str) -> VectorIndex:
        return VectorIndex(self.spark, self._index_path(name, index))

    def text_index(self, name: str, index: str) -> TextIndex:
        return TextIndex(self.spark, self._index_path(name, index))

    def rebuild_index(self, name: str, index: str, full: bool = True) -> TextIndex | VectorIndex:
        """Bring an index up to date: anew, or (``full=False``) from what changed."""
        path = self._index_path(name, index)
        commits = Commits(self.spark, path)
        is_text = "columns" in (state := commits.read(commits.version())) and "buckets" in state
        found = TextIndex(self.spark, path) if is_text else VectorIndex(self.spark, path)
        table = self.table(name)
        rows = table.df(labels=True, source=True)
        if full:
            return found.rebuild(rows) if is_text else found.rebuild(rows, sources=table.sources)
        behind = set(table.sources) ^ set(found.state["sources"] or ())
        return found.refresh(rows, table.sources) if behind else found

    def drop_index(self, name: str, index: str) -> None:
        Commits(self.spark, self._index_path(name, index)).delete_all()
