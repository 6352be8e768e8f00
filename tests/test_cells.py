"""Searches that choose the cells they read: exact by bounds, widened by filters, many queries by cell."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectrine.indexes import VectorIndex
from vectrine.indexes import vectors
from vectrine.indexes.vectors import CELL, FAR, GROUP, NO_CELL, lloyd
from vectrine.operators.knn import knn
from vectrine.operators.knn_join import knn_join
from vectrine.sources import DataType, field, table_schema

SCHEMA = "id long, v array<float>, tag long"
TOP = dict(names=["id"], with_score=True, digits=6)


@pytest.fixture(scope="module")
def clustered(spark):
    """Twenty clusters far apart, of 5 to 100 points, and rows without a place."""
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 10, (20, 8))
    rows = []
    for c, centre in enumerate(centres):
        for _ in range(5 * (c + 1)):
            rows.append((len(rows), rng.normal(centre, 0.5).astype(np.float32).tolist(), c))
    rows += [(5000, None, 1), (5001, [1.0], 1), (5002, [float("nan")] * 8, 2), (5003, [0.0] * 8, 3), (5004, [None] * 8, 3)]
    return spark.createDataFrame(rows, SCHEMA).persist()


@pytest.fixture(scope="module", params=["l2", "cosine"])
def index(spark, clustered, request, tmp_path_factory):
    return VectorIndex.build(clustered, str(tmp_path_factory.mktemp("cells")), "id", "v", nlist=20, metric=request.param)


def query_of(clustered, i):
    return list(clustered.filter(F.col("id") == i).first()["v"])


def files_read(df):
    """Files that the executed scans of a query opened."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    nodes = [plan]
    while nodes:
        node = nodes.pop()
        metrics = node.metrics()
        total += metrics.apply("numFiles").value() if metrics.contains("numFiles") else 0
        nodes += [node.executedPlan()] if "AdaptiveSparkPlan" in node.nodeName() else []
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


@pytest.mark.parametrize("where", [None, "tag % 3 = 1", "tag = 0", "tag > 100"])
def test_exact_search_equals_the_scan_and_reads_fewer_cells(clustered, index, where):
    for i, k in ((0, 3), (400, 12), (900, 40)):
        q = query_of(clustered, i)
        want = knn(clustered, q, "v", index.metric, k, key="id", where=where, **TOP).collect()
        found = index.search(q, k, 1, exact=True, where=where, **TOP)
        assert found.collect() == want
    cells = index.cells_for(query_of(clustered, 900), 3, 1, exact=True)
    assert cells and len(cells) <= 5
    near = index.search(query_of(clustered, 900), 3, 1, exact=True, **TOP)
    assert files_read(near) < files_read(index.rows())


def test_exact_search_of_queries_without_a_place(clustered, index):
    for q in ([1.0], [0.0] * 8, [float("nan")] * 8):
        want = knn(clustered, q, "v", index.metric, 7, key="id", **TOP).collect()
        assert index.search(q, 7, 2, exact=True, **TOP).collect() == want
    # more rows than have a place: those without come last
    want = knn(clustered, [1.0] * 8, "v", index.metric, 2000, key="id", **TOP).collect()
    assert index.search([1.0] * 8, 2000, 2, exact=True, **TOP).collect() == want


def test_threshold_bounds_the_cells(clustered, index):
    q = query_of(clustered, 700)
    limit = 2.0 if index.metric == "l2" else 0.01
    want = knn(clustered, q, "v", index.metric, 500, key="id", threshold=limit, **TOP).collect()
    assert 0 < len(want) < 500
    assert index.search(q, 500, 1, exact=True, threshold=limit, **TOP).collect() == want
    assert len(index.cells_for(q, 500, 1, exact=True, threshold=limit)) < index.nlist


def test_a_filter_widens_the_probe(clustered, index):
    q = query_of(clustered, 0)
    for where in ("tag = 13", "tag IN (3, 17) AND id % 2 = 0", ["tag = 5", "id > 0"]):
        allowed = clustered.filter(where if isinstance(where, str) else " AND ".join(where))
        n = allowed.filter("v is not null").count()
        found = index.search(q, 10, 1, where=where, **TOP).collect()
        assert len(found) == min(10, n) and {r["id"] for r in found} <= {r["id"] for r in allowed.collect()}
    # nearest cells first: what the filter lets pass there is kept
    near = index.search(q, 3, 1, where="tag = 0", **TOP).collect()
    assert near == knn(clustered, q, "v", index.metric, 3, key="id", where="tag = 0", **TOP).collect()
    assert len(index.search(q, 10, 1, where="tag = 99", **TOP).collect()) == 0


def test_bounds_hold_for_every_row(index):
    bounds = {r[CELL]: r for r in index.bounds().collect()}
    rows = index.rows().select(CELL, FAR).collect()
    assert sum(b["rows"] for b in bounds.values()) == len(rows)
    for r in rows:
        if r[CELL] != NO_CELL:
            assert bounds[r[CELL]]["least"] <= r[FAR] <= bounds[r[CELL]]["most"]


@pytest.mark.parametrize("block_bytes", [64 << 20, 8 * 8 * 7])
def test_many_queries_by_cell_equal_the_scan(spark, clustered, index, block_bytes):
    odd = spark.createDataFrame([(9000, None, 0), (9001, [1.0], 0), (9002, [0.0] * 8, 0), (9003, [float("nan")] * 8, 0)], SCHEMA)
    queries = clustered.filter("id % 7 = 0").unionByName(odd)
    exact = knn_join(queries, clustered, query_key="id", query_vector="v", key="id", vector="v", metric=index.metric, k=9, digits=6)
    # the corpus key and the query key have one name; the result calls the latter query_id
    got = index.search_many(queries, "id", "v", 9, index.nlist, digits=6, block_bytes=block_bytes)
    assert got.columns == exact.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, exact.collect()), key=repr)


def test_more_neighbours_than_rows_with_a_place(clustered, index):
    queries = clustered.filter("id in (1, 200, 5000)")
    exact = knn_join(queries, clustered, query_key="id", query_vector="v", key="id", vector="v", metric=index.metric, k=1100, digits=6)
    got = index.search_many(queries, "id", "v", 1100, index.nlist, digits=6)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, exact.collect()), key=repr)


def test_recall_of_few_cells(clustered, index):
    queries = clustered.filter("id % 5 = 0 AND id < 5000")
    exact = {(r["query_id"], r["id"]) for r in knn_join(queries, clustered, query_key="id", query_vector="v", key="id", vector="v", metric=index.metric, k=5).collect()}
    got = {(r["query_id"], r["id"]) for r in index.search_many(queries, "id", "v", 5, 3).collect()}
    assert len(got & exact) >= 0.9 * len(exact)


def test_untrained_index_and_no_queries(spark, folder, clustered):
    empty = clustered.filter("v is null")
    index = VectorIndex.build(empty, folder, "id", "v", nlist=4)
    assert [tuple(r) for r in index.search_many(clustered.filter("id = 1"), "id", "v", 3).collect()] == [(1, 5000, None, 1)]
    assert [r["id"] for r in index.search([1.0] * 8, 3, exact=True, names=["id"]).collect()] == [5000]
    assert index.search_many(clustered.filter("id < 0"), "id", "v", 3).collect() == []


def test_store_searches_by_cell_with_rows_not_indexed_yet(store, clustered):
    fields = [field("id", DataType.INT64, primary=True), field("v", DataType.FLOAT_VECTOR, dim=8, nullable=True), field("tag", DataType.INT64, nullable=True)]
    store.create_collection("points", schema=table_schema(fields), index_params=[{"name": "near", "column": "v", "nlist": 8}])
    rows = clustered.filter("id < 5000")
    store.insert("points", rows.filter("id % 2 = 0"))
    store.rebuild_index("points", "near")
    store.insert("points", rows.filter("id % 2 = 1"))
    store.delete("points", where="tag = 4")
    queries = rows.filter("id % 50 = 0")
    want = sorted(map(tuple, store.ann_search_many("points", queries, "id", "v", "v", k=4, digits=6).collect()))
    assert want == sorted(map(tuple, store.ann_search_many("points", queries, "id", "v", "v", k=4, digits=6, index="near", nprobe=8).collect()))
    q = query_of(clustered, 300)
    exact = store.ann_search("points", q, "v", k=6, where="tag % 2 = 1", names=["id"])
    assert store.ann_search("points", q, "v", k=6, where="tag % 2 = 1", names=["id"], index="near", nprobe=1, exact=True).collect() == exact.collect()
    with pytest.raises(ValueError):
        store.ann_search_many("points", queries, "id", "v", "v", "cosine", index="near")


def test_training_reads_a_bounded_sample(spark, folder, monkeypatch):
    from vectrine.indexes import vectors

    monkeypatch.setattr(vectors, "TRAIN_ROWS_PER_CENTRE", 20)
    seen = []
    monkeypatch.setattr(vectors, "_centres", lambda rows, k, seed: seen.append(rows.count()) or np.zeros((1, 2)))
    rows = spark.range(2000).selectExpr("id", "array(cast(id as float), cast(1 as float)) AS v")
    VectorIndex.build(rows, folder, "id", "v", nlist=5)
    assert 50 <= seen[0] <= 150


@pytest.fixture(scope="module")
def apart(spark, clustered):
    """Partition a holds the first ten clusters, b the others, c rows without a usable vector."""
    part = F.when(F.col("id") >= 5000, "c").when(F.col("tag") < 10, "a").otherwise("b")
    return clustered.withColumn("part", part).persist()


@pytest.fixture(scope="module", params=["l2", "cosine"])
def own(apart, request, tmp_path_factory):
    return VectorIndex.build(apart, str(tmp_path_factory.mktemp("own")), "id", "v", nlist=10, metric=request.param, local=["part"], own_centroids=True)


def test_every_partition_has_its_own_centroids(own):
    trained = own.groups().select(CELL, F.get_json_object(GROUP, "$.part").alias("own"))
    zero = {"c"} if own.metric == "l2" else set()  # the row of zeros has a place
    assert {r["own"] for r in trained.collect()} == {"a", "b"} | zero
    assert trained.groupBy("own").count().filter("count > 10").isEmpty()
    placed = own.rows().join(trained, CELL)
    assert placed.count() == own.rows().filter(F.col(CELL) != NO_CELL).count() and placed.filter("own != part").isEmpty()


@pytest.mark.parametrize("partitions", [None, ["a"], ["b"], ["a", "b"], ["c"]])
def test_own_centroids_find_the_exact_rows(own, apart, partitions):
    q = query_of(apart, 40)
    rows = apart if partitions is None else apart.filter(F.col("part").isin(partitions))
    want = knn(rows, q, "v", own.metric, 12, key="id", **TOP).collect()
    for options in ({"nprobe": own.nlist}, {"nprobe": 1, "exact": True}):
        assert own.search(q, 12, partitions=partitions, **options, **TOP).collect() == want


def test_own_centroids_recall_per_partition(own, apart):
    """A probe of two of a partition's ten cells finds nine tenths of its true ten nearest rows."""
    for part, first, last in (("a", 0, 275), ("b", 275, 1050)):
        hits = total = 0
        for i in range(first, last, (last - first) // 6):
            q = query_of(apart, i)
            want = {r["id"] for r in knn(apart.filter(F.col("part") == part), q, "v", own.metric, 5, key="id", **TOP).collect()}
            got = {r["id"] for r in own.search(q, 5, nprobe=2, partitions=[part], **TOP).collect()}
            hits, total = hits + len(want & got), total + len(want)
        assert hits >= 0.9 * total


def test_a_partition_is_trained_on_a_bounded_sample(apart, tmp_path, monkeypatch):
    monkeypatch.setattr(vectors, "OWN_TRAIN_BYTES", 8 * 8 * 40)
    seen = []
    real = vectors._own_centres
    monkeypatch.setattr(vectors, "_own_centres", lambda rows, k, seed: seen.extend(rows.groupBy(GROUP).count().collect()) or real(rows, k, seed))
    index = VectorIndex.build(apart, str(tmp_path), "id", "v", nlist=4, local=["part"], own_centroids=True)
    assert seen and all(r["count"] <= 80 for r in seen)
    assert index.rows().count() == apart.count()


def test_rows_of_a_new_partition_go_to_any_cell(own, apart):
    moved = apart.withColumn("part", F.when(F.col("tag") == 3, "new").otherwise(F.col("part")))
    index = own.refresh(moved)
    assert index.rows().filter(f"part = 'new' and {CELL} = {NO_CELL} and id < 5000").isEmpty()
    q = query_of(apart, 40)
    want = knn(moved.filter("part = 'new'"), q, "v", own.metric, 7, key="id", **TOP).collect()
    assert index.search(q, 7, nprobe=1, exact=True, partitions=["new"], **TOP).collect() == want
    own.refresh(apart)


def test_own_centroids_need_partitions(clustered, tmp_path):
    with pytest.raises(ValueError, match="local"):
        VectorIndex.build(clustered, str(tmp_path), "id", "v", own_centroids=True)


def test_centroids_do_not_depend_on_the_order_of_rows():
    rng = np.random.default_rng(9)
    x = rng.normal(0, 1, (300, 5))
    assert np.array_equal(lloyd(x, 7, 1), lloyd(x[rng.permutation(300)], 7, 1))
    assert len(lloyd(np.ones((50, 3)), 7, 1)) == 1
