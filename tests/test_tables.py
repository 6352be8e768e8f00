"""Writing, reading and changing tables: the golden fixtures F1-F10, F15-F17."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectrine.sources import DataType, DuplicateKey, MAXVALUE, RangePartition, HashPartition, Table, field, table_schema

SPLIT_AT_100 = RangePartition([("p0", 100), ("p1", MAXVALUE)], expr="id")
FIRST = [0.748479, 0.276979, 0.555195]


def vector_schema(dim=3, *more):
    return table_schema(
        [
            field("id", DataType.INT64, primary=True),
            field("embedding", DataType.FLOAT_VECTOR, dim=dim, nullable=True),
            field("meta", DataType.JSON, nullable=True),
            *more,
        ]
    )


def ids(df):
    return {r["id"] for r in df.collect()}


@pytest.fixture
def ann(store):
    store.create_table("ann", vector_schema(), SPLIT_AT_100)
    store.insert("ann", [{"id": i, "embedding": FIRST} for i in range(10)])
    store.insert("ann", [{"id": i, "embedding": [0.0, 0.0, 0.0]} for i in (10, 11, 12, 111, 112)])
    return store


def test_nearest_rows_and_partitions(ann):
    zero = [0.0, 0.0, 0.0]
    found = ann.ann_search("ann", zero, "embedding", k=5, with_score=True).collect()
    assert [r["id"] for r in found] == [10, 11, 12, 111, 112]
    assert {r["score"] for r in found} == {0.0}
    in_p0 = [r["id"] for r in ann.ann_search("ann", zero, "embedding", k=5, partitions=["p0"]).collect()]
    assert in_p0[:3] == [10, 11, 12] and set(in_p0[3:]) <= set(range(10))
    assert ids(ann.ann_search("ann", zero, "embedding", k=5, partitions=["p1"])) == {111, 112}


def test_distance_threshold_is_inclusive(ann):
    assert ids(ann.ann_search("ann", [0.0] * 3, "embedding", k=10, threshold=0.0)) == {10, 11, 12, 111, 112}
    near = ann.ann_search("ann", FIRST, "embedding", k=15, threshold=0.5, with_score=True).collect()
    assert len(near) == 10 and all(r["score"] <= 0.5 for r in near)


def test_output_columns_win_over_names(ann):
    out = ann.ann_search("ann", FIRST, "embedding", k=3, names=["meta"], columns=["id", (F.col("id") + 1000).alias("x")])
    assert out.columns == ["id", "x"] and all(r["x"] == r["id"] + 1000 for r in out.collect())
    extra = ann.ann_search("ann", FIRST, "embedding", k=3, names=["id"], columns=[], extra=["id + 1 as y"], with_score=True)
    assert extra.columns == ["id", "y", "score"]


def test_partition_read_prunes_folders(ann):
    rows = ann.query("ann", partitions=["p1"])
    assert ids(rows) == {111, 112}
    plan = rows._jdf.queryExecution().explainString(rows._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    filters = next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    assert "part" in filters and "p1" in filters


def test_string_keys_delete_then_get(store):
    schema = table_schema(
        [
            field("id", DataType.VARCHAR, primary=True, max_length=64),
            field("embedding", DataType.FLOAT_VECTOR, dim=3),
            field("meta", DataType.JSON),
            field("msg", T.BinaryType(), nullable=True),
        ]
    )
    store.create_table("t", schema)
    rows = [("abc", 1), ("bcd", 2), ("cde", 3), ("def", 4)]
    store.insert(
        "t",
        [{"id": i, "embedding": [0.1, 0.2, 0.3], "meta": json.dumps({"page": p}), "msg": b"x"} for i, p in rows],
    )
    store.delete("t", ids=["bcd", "def"])
    late = F.get_json_object("meta", "$.page").cast("int") > 1
    assert ids(store.get("t", ["abc", "bcd", "cde", "def"], where=[late])) == {"cde"}
    with pytest.raises(TypeError):
        store.get("t", {"abc"})


def test_array_columns(store):
    schema = table_schema(
        [
            field("id", DataType.INT32, primary=True, auto_id=True),
            field("name", DataType.STRING, nullable=True),
            field("arr_c", T.ArrayType(T.StringType()), nullable=True),
            field("arr_nested_c", T.ArrayType(T.ArrayType(T.IntegerType())), nullable=True),
        ]
    )
    store.create_table("t", schema)
    store.insert(
        "t",
        [
            {"name": "Alice", "arr_c": ["tag1", "tag2"], "arr_nested_c": [[1, 2], [3]]},
            {"name": "Bob", "arr_c": ["tag2", "tag3"], "arr_nested_c": [[4]]},
            {"name": "Charlie", "arr_c": ["tag1"], "arr_nested_c": []},
        ],
    )
    hit = {r["name"]: r for r in store.query("t", F.array_contains("arr_c", "tag1")).collect()}
    assert set(hit) == {"Alice", "Charlie"}
    assert hit["Alice"]["arr_c"] == ["tag1", "tag2"] and hit["Alice"]["arr_nested_c"] == [[1, 2], [3]]
    assert sorted(r["id"] for r in store.query("t").collect()) == [1, 2, 3]


def test_auto_ids_are_dense_over_many_files(store, spark):
    schema = table_schema(
        [field("id", DataType.INT64, primary=True, auto_id=True), field("v", DataType.INT64)]
    )
    store.create_table("t", schema)
    store.insert("t", spark.range(1000).repartition(7).selectExpr("id as v"))
    store.insert("t", spark.range(10).selectExpr("id as v"))
    assert sorted(r["id"] for r in store.query("t").collect()) == list(range(1, 1011))


def test_add_and_drop_columns(store):
    store.create_table("t", table_schema([field("id", DataType.INT32, primary=True)]))
    more = [field("name", DataType.STRING, nullable=True), field("age", DataType.INT32, nullable=True)]
    store.add_columns("t", more)
    store.insert("t", {"id": 1, "name": "Alice", "age": 20})
    assert store.get("t", 1).first().asDict() == {"id": 1, "name": "Alice", "age": 20}
    store.drop_columns("t", ["age"])
    assert store.query("t").columns == ["id", "name"]
    store.add_columns("t", [field("age", DataType.INT32, nullable=True)])
    assert store.get("t", 1).first()["age"] is None


def test_update_by_id_and_vector(store):
    store.create_table("t", vector_schema(), SPLIT_AT_100)
    store.insert(
        "t",
        [
            {"id": 112, "embedding": [1.0, 2.0, 3.0], "meta": '{"doc": "hhh1"}'},
            {"id": 190, "embedding": [0.13, 0.123, 1.213], "meta": '{"doc": "hhh2"}'},
        ],
    )
    from vectrine.operators import vector_equals

    store.update("t", {"meta": {"doc": "HHH"}}, where=["id = 112", vector_equals("embedding", [1, 2, 3])])
    got = {r["id"]: json.loads(r["meta"])["doc"] for r in store.query("t").collect()}
    assert got == {112: "HHH", 190: "hhh2"}


def test_update_leaves_null_conditions_alone_and_moves_partitions(store):
    store.create_table("t", vector_schema(), SPLIT_AT_100)
    store.insert("t", [{"id": 1, "meta": None}, {"id": 2, "meta": "a"}, {"id": 200, "meta": "b"}])
    store.update("t", {"id": F.col("id") + 500}, where="meta = 'a'")
    assert ids(store.query("t", partitions=["p0"])) == {1}
    assert ids(store.query("t", partitions=["p1"])) == {200, 502}
    with pytest.raises(DuplicateKey):
        store.update("t", {"id": 7})


def test_upsert_replaces_whole_rows(store):
    schema = table_schema(
        [
            field("id", DataType.INT32, primary=True),
            field("name", DataType.STRING, nullable=True),
            field("metadata", DataType.JSON, nullable=True),
        ]
    )
    store.create_table("t", schema)
    store.insert("t", {"id": 1, "name": "test", "metadata": '{"version": 1}'})
    store.upsert("t", {"id": 1, "name": "updated", "metadata": '{"version": 2}'})
    assert store.query("t").collect()[0].asDict() == {"id": 1, "name": "updated", "metadata": '{"version": 2}'}
    store.upsert("t", [{"id": 1, "name": "first"}, {"id": 1, "name": "last"}, {"id": 2, "name": "new"}])
    got = {r["id"]: (r["name"], r["metadata"]) for r in store.query("t").collect()}
    assert got == {1: ("last", None), 2: ("new", None)}
    store.upsert("t", [{"id": 2, "name": "new"}])
    assert store.query("t").count() == 2


def test_delete_forms(store):
    schema = vector_schema(3, field("tag", DataType.INT64))
    store.create_table("t", schema, SPLIT_AT_100)
    store.insert("t", [{"id": i, "tag": t} for i, t in ((12, 32), (90, 1), (112, 19), (190, 22))])
    store.delete("t", ids=[12, 112], partition="p0")
    assert ids(store.query("t")) == {90, 112, 190}
    store.delete("t", where="tag % 2 = 0")
    assert ids(store.query("t")) == {90, 112}
    store.delete("t", ids=[90, 112], where=["tag = 19"])
    assert ids(store.query("t")) == {90}
    store.delete("t", partition="p1")
    assert ids(store.query("t")) == {90}
    store.delete("t")
    assert store.get_collection_stats("t").first()["row_count"] == 0


def test_delete_by_a_long_id_list(store, spark):
    store.create_table("t", table_schema([field("id", DataType.INT64, primary=True)]))
    store.insert("t", spark.range(5000))
    store.delete("t", ids=list(range(0, 5000, 2)))
    assert store.query("t").count() == 2500
    store.delete("t", ids=spark.range(2500))
    assert store.query("t").count() == 1250


def test_query_and_get(store):
    store.create_table("t", vector_schema(), SPLIT_AT_100)
    store.insert("t", [{"id": 12, "meta": "{}"}, {"id": 90, "meta": "{}"}])
    store.insert("t", [{"id": 112}, {"id": 190}], partition="p1")
    assert ids(store.query("t")) == {12, 90, 112, 190}
    assert ids(store.query("t", "id < 100")) == {12, 90}
    assert ids(store.get("t", [80, 12, 112])) == {12, 112}
    assert ids(store.get("t", [80, 12, 112], partitions=["p1"])) == {112}
    assert ids(store.query("t", "id < 80", partitions=["p0"])) == {12}
    assert store.get("t", limit=2).count() == 2


def test_insert_checks(store, spark):
    store.create_table("t", vector_schema(3, field("s", DataType.VARCHAR, max_length=2, nullable=True)), SPLIT_AT_100)
    store.insert("t", [])
    store.insert("t", {"id": 1})
    for bad in (
        [{"id": 1}],
        [{"id": 2}, {"id": 2}],
    ):
        with pytest.raises(DuplicateKey):
            store.insert("t", bad)
    for problem in (
        {"id": 3, "embedding": [1.0]},
        {"id": 3, "embedding": [1.0, None, 2.0]},
        {"id": 3, "s": "abc"},
        {"id": None},
    ):
        with pytest.raises(Exception, match="column"):
            store.insert("t", problem)
    with pytest.raises(Exception, match="does not belong"):
        store.insert("t", {"id": 3}, partition="p1")
    with pytest.raises(ValueError, match="unknown"):
        store.insert("t", {"id": 3, "nope": 1})
    assert ids(store.query("t")) == {1}


def test_row_outside_every_partition_is_rejected(store):
    store.create_table("t", vector_schema(), RangePartition([("p0", 100)], expr="id"))
    with pytest.raises(Exception, match="no partition"):
        store.insert("t", {"id": 100})
    assert store.query("t").count() == 0


def test_wide_and_quick_schemas(store):
    store.create_collection("q", dimension=3)
    store.create_collection("s", dimension=3, id_type="str", max_length=16)
    wide = table_schema(
        [
            field("id", DataType.INT64, primary=True),
            field("title", DataType.VARCHAR, max_length=512),
            field("title_vector", DataType.FLOAT_VECTOR, dim=768),
            field("claps", DataType.INT64),
        ]
    )
    store.create_collection("w", schema=wide, partitions=HashPartition("id", count=3))
    for name in "qsw":
        assert store.get_collection_stats(name).first()["row_count"] == 0
    assert store.has_collection("w") and not store.has_collection("x")
    store.rename_collection("w", "x")
    assert store.has_collection("x") and not store.has_collection("w")
    store.drop_collection("x")
    assert not store.has_collection("x")
    with pytest.raises(ValueError):
        store.create_collection("z")
    with pytest.raises(ValueError):
        store.create_collection("z", dimension=3, id_type="float")


@pytest.mark.parametrize(
    "wrong",
    [
        dict(dtype=DataType.FLOAT_VECTOR),
        dict(dtype=DataType.VARCHAR),
        dict(dtype=DataType.ARRAY),
        dict(dtype=DataType.ARRAY, element_type=DataType.VARCHAR),
        dict(dtype=DataType.STRING, primary=True),
        dict(dtype=DataType.JSON, primary=True),
        dict(dtype=DataType.DOUBLE, primary=True),
        dict(dtype=DataType.FLOAT_VECTOR, dim=3, primary=True),
    ],
)
def test_field_checks(wrong):
    with pytest.raises(ValueError):
        field("f", **wrong)


def test_parallel_inserts_all_arrive(store):
    store.create_table("t", vector_schema())
    batches = [[{"id": 10 * b + i, "embedding": FIRST} for i in range(10)] for b in range(10)]
    with ThreadPoolExecutor(10) as pool:
        list(pool.map(lambda rows: store.insert("t", rows), batches))
    assert ids(store.query("t")) == set(range(100))


def test_reader_keeps_its_version_and_untouched_folders_stay(store, spark, folder):
    t = Table.create(spark, f"{folder}/t", vector_schema(), SPLIT_AT_100)
    t.insert(spark.createDataFrame([(1,), (2,), (200,)], "id long"))
    before = t.df()
    p1 = [f for f in t._state["folders"] if f.endswith("p1")]
    t.delete(ids=[1])
    assert ids(before) == {1, 2, 200} and ids(t.df()) == {2, 200}
    assert p1 == [f for f in t._state["folders"] if f.endswith("p1")]


def test_upsert_with_a_hot_key(store, spark):
    store.create_table("t", table_schema([field("id", DataType.INT64, primary=True), field("v", DataType.INT64)]))
    rows = spark.range(30000).selectExpr("if(id % 3 = 0, 0, id) as id", "id as v", "id as seq")
    store.upsert("t", rows, order_by="seq")
    assert store.get("t", 0).first()["v"] == 29997
    assert store.query("t").count() == 20001


def test_sql_over_tables(ann):
    out = ann.sql(
        "select id, l2_distance(embedding, cast(array(0, 0, 0) as array<float>)) d from ann where id >= :low order by d, id",
        ["ann"],
        {"low": 9},
    )
    assert [r["id"] for r in out.collect()] == [10, 11, 12, 111, 112, 9]


def test_sql_leaves_the_callers_views(ann, spark):
    spark.range(3).createOrReplaceTempView("ann")
    out = ann.sql("select count(*) n from ann", ["ann"])
    assert out.first()["n"] == 15 and spark.table("ann").count() == 3
    spark.catalog.dropTempView("ann")
    ann.sql("select 1 from ann", ["ann"])
    assert not spark.catalog.listTables(pattern="ann")


def test_indexes_of_a_store(ann):
    ann.create_vector_index("ann", "near", "embedding", nlist=2, metric="l2")
    exact = ann.ann_search("ann", [0.0] * 3, "embedding", k=7, with_score=True).collect()
    assert ann.ann_search("ann", [0.0] * 3, "embedding", k=7, with_score=True, index="near", nprobe=2).collect() == exact
    only = ann.ann_search("ann", [0.0] * 3, "embedding", k=7, index="near", nprobe=2, partitions=["p1"])
    assert ids(only) == {111, 112}
    post = ann.ann_search("ann", FIRST, "embedding", k=5, index="near", nprobe=2, where="id > 3", post_filter=True, expand=1)
    assert ids(post) == {4}
    for wrong in (dict(metric="cosine"), dict(column="meta")):
        with pytest.raises(ValueError):
            ann.ann_search("ann", [0.0] * 3, **{"column": "embedding", **wrong}, index="near")
    with pytest.raises(TypeError):
        ann.post_ann_search("ann", [0.0] * 3, "embedding", threshold=1.0)
    ann.insert("ann", {"id": 500, "embedding": [0.0, 0.0, 0.1], "meta": "deep sea"})
    ann.create_text_index("ann", "words", "meta", buckets=2)
    assert ids(ann.bm25_search("ann", "sea", "meta", index="words")) == {500}
    ann.upsert("ann", {"id": 500, "meta": "high mountain"})
    for full in (False, True):
        ann.rebuild_index("ann", "words", full)
        ann.rebuild_index("ann", "near", full)
        assert ids(ann.bm25_search("ann", "sea mountain", "meta", index="words")) == {500}
        assert ann.bm25_search("ann", "sea", "meta", index="words").count() == 0
        assert ann.vector_index("ann", "near").rows().count() == 16
    ann.drop_index("ann", "near")
    with pytest.raises(ValueError):
        ann.vector_index("ann", "near")


# --- writes that meet each other, and names that need escaping ---------------------------


def plain(store, name="t", partitions=None):
    fields = [field("id", DataType.INT64, primary=True), field("v", DataType.INT64, nullable=True)]
    store.create_table(name, table_schema(fields), partitions)
    return Table(store.spark, f"{store.root}/tables/{name}")


def test_a_column_added_through_an_older_handle_keeps_the_rows(store):
    one = plain(store)
    store.insert("t", [{"id": i} for i in range(3)])
    one.add_columns([field("note", DataType.STRING, nullable=True)])
    store.insert("t", [{"id": i, "note": "n"} for i in range(3, 6)])
    assert {r["id"]: r["note"] for r in store.query("t").collect()} == {0: None, 1: None, 2: None, 3: "n", 4: "n", 5: "n"}


def test_schema_changes_of_two_handles_both_hold(store):
    one, two = plain(store), plain(store)
    one.add_columns([field("a", DataType.STRING, nullable=True)])
    two.drop_columns(["v"])
    assert store.query("t").columns == ["id", "a"]
    with pytest.raises(ValueError):
        one.add_columns([field("a", DataType.STRING, nullable=True)])


def test_readding_a_dropped_column_meets_an_insert(store, monkeypatch):
    table = plain(store)
    store.insert("t", [{"id": 1, "v": 7}])
    table.drop_columns(["v"])
    rewrite, turns = Table._rewrite, []

    def rewrite_and_be_overtaken(self, folders, change):
        written = rewrite(self, folders, change)
        if not turns:
            turns.append(1)
            store.insert("t", [{"id": 2}])
        return written

    monkeypatch.setattr(Table, "_rewrite", rewrite_and_be_overtaken)
    table.add_columns([field("v", DataType.INT64, nullable=True)])
    assert {r["id"]: r["v"] for r in store.query("t").collect()} == {1: None, 2: None}


def test_partition_names_that_need_escaping(store):
    rule = RangePartition([("p:0", 100), ("a b%=c", MAXVALUE)], expr="id")
    plain(store, partitions=rule)
    store.insert("t", [{"id": i, "v": 0} for i in (1, 2, 3, 150, 160)])
    store.update("t", {"v": 5}, where="id in (2, 150)")
    store.upsert("t", [{"id": 3, "v": 9}, {"id": 160, "v": 9}])
    assert {r["id"]: r["v"] for r in store.query("t").collect()} == {1: 0, 2: 5, 3: 9, 150: 5, 160: 9}
    store.delete("t", where="id = 1")
    store.delete("t", partition="a b%=c")
    assert {r["id"]: r["v"] for r in store.query("t").collect()} == {2: 5, 3: 9}


def test_parallel_inserts_with_auto_ids_all_arrive(store):
    store.create_table("t", table_schema([field("id", DataType.INT64, primary=True, auto_id=True), field("v", DataType.INT64)]))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda b: store.insert("t", [{"v": 10 * b + i} for i in range(5)]), range(4)))
    rows = store.query("t").collect()
    assert sorted(r["v"] for r in rows) == sorted(10 * b + i for b in range(4) for i in range(5))
    assert len({r["id"] for r in rows}) == 20


def test_deleted_ids_are_not_given_again(store):
    store.create_table("t", table_schema([field("id", DataType.INT64, primary=True, auto_id=True), field("v", DataType.INT64)]))
    store.insert("t", [{"v": 1}, {"v": 2}])
    store.delete("t", ids=[2])
    store.insert("t", [{"v": 3}])
    assert ids(store.query("t")) == {1, 3}
    store.insert("t", [{"id": 50, "v": 4}])
    store.insert("t", [{"v": 5}])
    assert ids(store.query("t")) == {1, 3, 50, 51}


def test_one_deleted_row_rewrites_one_bucket(store, spark):
    table = plain(store)
    store.insert("t", spark.range(2000).selectExpr("id", "id as v"))
    before = set(table.refresh().sources)
    store.delete("t", ids=[77])
    after = set(table.refresh().sources)
    assert len(before) == 16 and len(before - after) == 1 and len(after - before) == 1
    assert store.query("t").count() == 1999


def test_upsert_needs_an_order_for_repeated_keys(store, spark):
    plain(store)
    rows = spark.createDataFrame([(1, 1), (1, 2)], "id long, v long")
    with pytest.raises(DuplicateKey):
        store.upsert("t", rows)
    store.upsert("t", rows, order_by="v")
    assert store.get("t", 1).first()["v"] == 2


@pytest.mark.parametrize("count", [1000, 1001])
def test_ids_of_any_type(store, spark, count):
    plain(store)
    store.insert("t", spark.range(3000).selectExpr("id", "id as v"))
    wanted = [str(i) for i in range(count - 1)] + ["no number"]
    assert store.get("t", wanted).count() == count - 1
    store.delete("t", ids=wanted)
    assert store.query("t").count() == 3000 - (count - 1)


def test_reserved_names(store):
    for name in ("__snap", "__part", "__source"):
        with pytest.raises(ValueError):
            store.create_table(f"t{name}", table_schema([field(name, DataType.INT64, primary=True)]))


def test_staged_rows_are_removed(store):
    store.create_table("t", table_schema([field("id", DataType.INT64, primary=True, auto_id=True), field("v", DataType.INT64)]))
    store.insert("t", [{"v": 1}])
    assert Table(store.spark, f"{store.root}/tables/t")._commits.folders(f"{store.root}/tables/t/staged") == []


# --- indexes that live with their table ---------------------------------------------------

INDEXES = [
    {"name": "near", "column": "embedding", "nlist": 2},
    {"name": "words", "column": "meta", "kind": "text", "buckets": 2},
]


@pytest.fixture
def indexed(store):
    store.create_collection("t", schema=vector_schema(), index_params=INDEXES)
    return store


def nearest(store, **options):
    rows = store.ann_search("t", [0.0, 0.0, 0.0], "embedding", k=3, index="near", nprobe=2, with_score=True, **options).collect()
    return [(r["id"], r["score"]) for r in rows]


def test_indexes_before_the_rows(indexed):
    assert nearest(indexed) == [] and indexed.bm25_search("t", "sea", "meta", index="words").count() == 0
    indexed.insert("t", [{"id": i, "embedding": [float(i), 0.0, 0.0], "meta": f"sea number {i}"} for i in range(1, 6)])
    assert nearest(indexed) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    assert ids(indexed.bm25_search("t", "sea", "meta", index="words")) == {1, 2, 3, 4, 5}
    for full in (False, True):
        indexed.rebuild_index("t", "near", full)
        indexed.rebuild_index("t", "words", full)
        assert nearest(indexed) == [(1, 1.0), (2, 2.0), (3, 3.0)]
        assert indexed.vector_index("t", "near").rows().count() == 5


def test_search_sees_the_table_as_it_is(indexed):
    indexed.insert("t", [{"id": i, "embedding": [float(i), 0.0, 0.0], "meta": "deep sea" if i < 4 else "sea"} for i in range(6)])
    indexed.rebuild_index("t", "near")
    indexed.rebuild_index("t", "words")
    indexed.delete("t", ids=[0, 1])
    indexed.upsert("t", [{"id": 4, "embedding": [0.5, 0.0, 0.0], "meta": "mountain"}])
    assert nearest(indexed) == [(4, 0.5), (2, 2.0), (3, 3.0)]
    found = indexed.bm25_search("t", "deep sea", "meta", 2, index="words", with_score=True).collect()
    plain_ = indexed.bm25_search("t", "deep sea", "meta", 2, with_score=True).collect()
    assert found == plain_ and [r["id"] for r in found] == [2, 3]
    indexed.rebuild_index("t", "near", full=False)
    indexed.rebuild_index("t", "words", full=False)
    assert nearest(indexed) == [(4, 0.5), (2, 2.0), (3, 3.0)]
    assert indexed.bm25_search("t", "deep sea", "meta", 2, index="words", with_score=True).collect() == plain_


def test_a_refresh_assigns_only_new_folders(indexed):
    indexed.insert("t", [{"id": i, "embedding": [float(i), 0.0, 0.0]} for i in range(5)])
    first = indexed.rebuild_index("t", "near")
    indexed.insert("t", [{"id": 9, "embedding": [9.0, 0.0, 0.0]}])
    second = indexed.rebuild_index("t", "near", full=False)
    assert second.state["parts"][:-1] == first.state["parts"] and second.rows().count() == 6
    assert indexed.rebuild_index("t", "near", full=False).version == second.version


def test_dropped_tables_take_their_indexes_along(indexed):
    indexed.insert("t", [{"id": 1, "embedding": [1.0, 0.0, 0.0], "meta": "old"}])
    indexed.rebuild_index("t", "near")
    indexed.insert("t", {"id": 2, "embedding": [5.0, 0.0, 0.0]})
    indexed.rename_collection("t", "u")
    assert ids(indexed.ann_search("u", [0.0] * 3, "embedding", k=1, index="near", nprobe=2)) == {1}
    indexed.rename_collection("u", "t")
    indexed.drop_collection("t")
    indexed.create_collection("t", schema=vector_schema())
    with pytest.raises(ValueError):
        indexed.vector_index("t", "near")


def test_usual_metric_of_a_quick_collection(store):
    store.create_collection("q", dimension=2, metric_type="cosine")
    store.insert("q", [{"id": 1, "vector": [10.0, 0.0]}, {"id": 2, "vector": [1.0, 0.5]}])
    assert store.ann_search("q", [1.0, 0.0], "vector", k=1).first()["id"] == 1
    assert store.ann_search("q", [1.0, 0.0], "vector", "l2", k=1).first()["id"] == 2


def test_text_partition_labels_stay_text(store):
    rule = RangePartition([("00", 100), ("01", MAXVALUE)], expr="id")
    store.create_table("t", vector_schema(), rule)
    store.insert("t", [{"id": 1, "embedding": [1.0, 0.0, 0.0]}, {"id": 200, "embedding": [2.0, 0.0, 0.0]}])
    store.create_vector_index("t", "near", "embedding", nlist=1)
    assert ids(store.ann_search("t", [0.0] * 3, "embedding", index="near", partitions=["00"])) == {1}


def test_hybrid_search_through_the_indexes_of_a_store(indexed):
    indexed.insert("t", [{"id": i, "embedding": [float(i), 0.0, 0.0], "meta": f"deep sea {i}"} for i in range(6)])
    body = {"query": {"match": {"meta": "sea 3"}}, "knn": {"field": "embedding", "query_vector": [0, 0, 0]}, "size": 4}
    indexed.rebuild_index("t", "near")
    indexed.insert("t", [{"id": 7, "embedding": [0.1, 0.0, 0.0], "meta": "sea 3"}])
    exact = indexed.hybrid_search("t", body).collect()
    assert indexed.hybrid_search("t", body, text_indexes={"meta": "words"}, vector_index="near", nprobe=2).collect() == exact
    linear = indexed.search_hybrid("t", [0.0] * 3, "embedding", "sea 3", "meta", k=4, names=["id"]).collect()
    assert indexed.search_hybrid("t", [0.0] * 3, "embedding", "sea 3", "meta", k=4, names=["id"], text_index="words").collect() == linear
