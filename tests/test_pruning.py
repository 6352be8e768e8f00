"""Predicates and keys choose the partitions and folders that are read."""

import datetime

import pytest
from pyspark.sql import functions as F

from vectrine.sources import DataType, DuplicateKey, HashPartition, KeyPartition, ListPartition, MAXVALUE, RangePartition, field, table_schema
from vectrine.sources.partitioning import DEFAULT

FIELDS = [
    field("id", DataType.INT64, primary=True),
    field("v", DataType.INT32, nullable=True),
    field("name", DataType.STRING, nullable=True),
    field("day", DataType.DATE, nullable=True) if hasattr(DataType, "DATE") else field("day", DataType.STRING, nullable=True),
]
BY_ID = RangePartition([("p0", 100), ("p1", 200), ("p2", 300), ("p3", MAXVALUE)], expr="id")
BY_V = ListPartition([("odd", [1, 3, 5]), ("even", [2, 4, 6]), ("rest", DEFAULT)], columns=["v"])


def rows(spark, n=400):
    return spark.range(n).selectExpr("id", "cast(id % 8 AS int) AS v", "concat('n', id % 10) AS name", "date_add(date'2024-01-01', cast(id % 50 AS int)) AS day")


@pytest.fixture
def filled(store, spark):
    def make(partition):
        schema = table_schema(FIELDS)
        store.create_collection("t", schema=schema, partitions=partition)
        data = rows(spark).select("id", "v", "name", F.col("day").cast(schema["day"].dataType).alias("day"))
        store.insert("t", data)
        return data

    return make


def folders(df):
    """Folders that the rows of a read can come from."""
    return {f.rsplit("/part-", 1)[0] for f in df.inputFiles()} if df.inputFiles() else set()


def check(store, data, where, most):
    got = store.query("t", where)
    want = data.filter(where)
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect())
    assert len(folders(got)) <= most


@pytest.mark.parametrize(
    ("where", "most"),
    [
        ("id < 100", 1),
        ("id <= 100", 2),
        ("100 > id", 1),
        ("id >= 150 AND id < 250 AND v = 2", 2),
        ("id > 299.5", 2),
        ("id = 17", 1),
        ("id IN (3, 250)", 2),
        ("id = 3 OR id = 399", 2),
        ("id BETWEEN 210 AND 220", 1),
        (["id >= 300", "name = 'n3'"], 1),
        ("id < 0", 1),
        ("id = NULL", 4),
        ("v = 3", 4),
        ("id + 1 = 5", 4),
        ("NOT (id < 100)", 4),
    ],
)
def test_range_partitions(store, filled, where, most):
    data = filled(BY_ID)
    if isinstance(where, list):
        got = store.query("t", where)
        assert got.count() == data.filter(" AND ".join(where)).count() and len(folders(got)) <= most
    else:
        check(store, data, where, most)


@pytest.mark.parametrize(("where", "most"), [("v = 3", 1), ("v IN (2, 3)", 2), ("v > 4 AND v < 6", 2), ("v IS NULL", 3), ("v = 7", 1), ("v = 2 AND id < 50", 1), ("id = 3", 3)])
def test_list_partitions(store, filled, where, most):
    check(store, filled(BY_V), where, most)


def test_hash_key_and_nested_partitions(store, filled):
    data = filled(HashPartition("id", count=5))
    check(store, data, "id = 77", 1)
    check(store, data, "id IN (1, 2)", 2)
    check(store, data, "id > 77", 5)
    store.drop_collection("t")
    data = filled(KeyPartition(["id", "v"], count=6))
    check(store, data, "id = 77", 6)
    check(store, data, "id = 77 AND v = 5", 1)
    store.drop_collection("t")
    data = filled(RangePartition([("a", 200), ("b", MAXVALUE)], expr="id").by(HashPartition("v", count=3)))
    got = store.query("t", "id < 100 AND v = 2")
    assert got.count() == data.filter("id < 100 AND v = 2").count()
    assert "subpart" in got._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]


def test_range_of_several_columns(store, filled):
    data = filled(RangePartition([("a", (2, 100)), ("b", (4, 50)), ("c", (MAXVALUE, MAXVALUE))], columns=["v", "id"]))
    for where, most in (("v < 2", 1), ("v = 2", 3), ("v >= 5", 1), ("v = 4 AND id = 20", 1), ("v = 2 AND id = 98", 1)):
        check(store, data, where, most)


def test_dates_as_bounds(store, filled):
    data = filled(RangePartition([("jan", datetime.date(2024, 2, 1)), ("feb", MAXVALUE)], expr="day"))
    check(store, data, "day < '2024-01-15'", 1)
    check(store, data, "day >= '2024-02-01'", 1)
    check(store, data, "day > '2024-01-20'", 2)


@pytest.mark.parametrize("ids", [77, [5, 6, 7], [100_000], ["12", "x"], []])
def test_point_reads_open_the_buckets_of_their_keys(store, filled, ids):
    filled(None)
    listed = ids if isinstance(ids, list) else [ids]
    got = store.get("t", ids)
    assert {r["id"] for r in got.collect()} == {int(i) for i in listed if str(i).isdigit() and int(i) < 400}
    assert len(folders(got)) <= len(listed)
    assert store.get("t", ids, where="v = 5").count() <= len(listed)
    if listed:
        store.delete("t", ids=ids)
        assert store.get("t", ids).count() == 0


def test_pruned_writes(store, filled):
    data = filled(BY_ID)
    store.update("t", {"name": "new"}, where="id >= 150 AND id < 160")
    store.delete("t", where="id > 390")
    got = {r["id"]: r["name"] for r in store.query("t").collect()}
    assert len(got) == 391 and {i for i, n in got.items() if n == "new"} == set(range(150, 160))
    assert data.count() == 400


def test_searches_prune_too(store, filled, spark):
    filled(BY_ID)
    plan = store.bm25_search("t", "n3", "name", where="id < 50", names=["id"])
    assert {r["id"] for r in plan.collect()} <= set(range(0, 50))


def test_appending_new_keys_reads_no_old_folder(store, filled, spark, monkeypatch):
    filled(None)
    table = store.table("t")
    seen = []
    scan = type(table)._overlapping
    monkeypatch.setattr(type(table), "_overlapping", lambda self, state, bounds: seen.append(scan(self, state, bounds)) or seen[-1])
    schema = table.schema
    later = rows(spark, 900).filter("id >= 400").select("id", "v", "name", F.col("day").cast(schema["day"].dataType).alias("day"))
    store.insert("t", later)
    assert seen == [[]] and store.query("t").count() == 900
    with pytest.raises(DuplicateKey):
        store.insert("t", later.filter("id = 455"))
    assert 0 < len(seen[-1]) <= 2
    store.delete("t", where="id = 455")
    store.insert("t", later.filter("id = 455"))
    assert store.query("t").count() == 900


def test_hybrid_reads_write_nothing(store, spark):
    fields = [field("id", DataType.INT64, primary=True), field("e", DataType.FLOAT_VECTOR, dim=2, nullable=True), field("c", DataType.STRING, nullable=True)]
    indexes = [{"name": "near", "column": "e", "nlist": 2}, {"name": "words", "column": "c", "kind": "text"}]
    store.create_collection("t", schema=table_schema(fields), index_params=indexes)
    some = spark.range(60).selectExpr("id", "array(cast(id as float), 1f) AS e", "concat('word', id % 7, ' x') AS c")
    store.insert("t", some.filter("id < 30"))
    store.rebuild_index("t", "near")
    store.rebuild_index("t", "words")
    store.insert("t", some.filter("id >= 30"))
    store.delete("t", where="id % 5 = 0")
    versions = [store.vector_index("t", "near").version, store.text_index("t", "words").version]
    body = {"query": {"bool": {"must": [{"match": {"c": "word3"}}]}}, "knn": {"field": "e", "query_vector": [41.0, 1.0]}, "size": 8}
    plain = store.hybrid_search("t", body)
    through = store.hybrid_search("t", body, text_indexes={"c": "words"}, vector_index="near", nprobe=2)
    assert [(r["id"], r["hybrid_score"]) for r in through.collect()] == [(r["id"], r["hybrid_score"]) for r in plain.collect()]
    args = ([41.0, 1.0], "e", "word3", "c")
    assert store.search_hybrid("t", *args, names=["id"], text_index="words").collect() == store.search_hybrid("t", *args, names=["id"]).collect()
    assert versions == [store.vector_index("t", "near").version, store.text_index("t", "words").version]
