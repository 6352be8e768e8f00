"""Sparse search through inverted lists beside the scan of all maps."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectrine.indexes.sparse import SparseIndex
from vectrine.operators.knn import knn

TOP = dict(names=["id"], with_score=True, digits=6)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    odds = 1.0 / np.arange(1, 101)
    out = []
    for i in range(800):
        n = int(rng.integers(0, 12))
        places = rng.choice(100, n, replace=False, p=odds / odds.sum())
        out.append((i, {int(p): float(np.float32(rng.integers(1, 9) / 4)) for p in places}, i % 4))
    out += [(900, None, 0), (901, {}, 1), (902, {3: float("nan")}, 2), (903, {1: -5.0, 2: -1.0}, 3), (904, {200: 7.0}, 0)]
    return spark.createDataFrame(out, "id long, v map<int, float>, tag int").persist()


@pytest.fixture(scope="module")
def index(rows, tmp_path_factory):
    return SparseIndex.build(rows, str(tmp_path_factory.mktemp("lists")), "id", "v", 4)


@pytest.fixture(scope="module")
def positive(rows, tmp_path_factory):
    return SparseIndex.build(rows.filter("id < 900"), str(tmp_path_factory.mktemp("lists")), "id", "v", 4)


QUERIES = [{0: 1.0}, {0: 0.5, 50: 2.0, 99: 3.0}, {1: -1.0, 3: 2.0}, {999: 1.0}, {}, {i: 0.25 for i in range(100)}, {200: 7.0}]


@pytest.mark.parametrize("metric", ["ip", "l2", "cosine"])
@pytest.mark.parametrize("q", QUERIES, ids=str)
def test_lists_give_the_rows_of_the_scan(rows, index, metric, q):
    for k, where in ((7, None), (1000, None), (5, "tag = 2")):
        want = knn(rows, q, "v", metric, k, key="id", where=where, **TOP).collect()
        assert index.search(rows, q, metric, k, where=where, **TOP).collect() == want


def test_long_lists_are_read_for_rows_of_the_others_only(rows, positive):
    q = {0: 0.01, 1: 0.01, 60: 5.0, 61: 5.0, 62: 5.0, 63: 5.0}
    main, others = positive.essential(q, 3)
    assert set(others) == {0, 1} and set(main) == {60, 61, 62, 63}
    some = rows.filter("id < 900")
    assert positive.search(some, q, "ip", 3, **TOP).collect() == knn(some, q, "v", "ip", 3, key="id", **TOP).collect()


def test_only_the_lists_asked_for_are_read(positive):
    plan = positive._of("entries", [60, 61])._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "__bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert positive._of("entries", [60]).select(F.countDistinct("place")).first()[0] == 1


def test_vectors_are_made_once(spark, folder):
    made = spark.sparkContext.accumulator(0)

    @F.udf("map<int, float>")
    def make(i):
        made.add(1)
        return {i % 7: 1.5, 9: 0.5} if i % 10 else None

    made_here = spark.range(50).select("id", make("id").alias("v"))
    index = SparseIndex.build(made_here, folder, "id", "v")
    assert made.value == 50
    assert index.norms().count() == 50 and index._of("lists", [9]).first()["rows"] == 45
    assert index.search(made_here, {9: 1.0, 3: 2.0}, "l2", 5, **TOP).collect() == knn(made_here, {9: 1.0, 3: 2.0}, "v", "l2", 5, key="id", **TOP).collect()


def test_wrong_use_is_refused(rows, index, folder):
    with pytest.raises(ValueError):
        SparseIndex.build(rows, folder, "id", "tag")
    with pytest.raises(ValueError):
        index.search(rows, [1.0], "ip")
    with pytest.raises(ValueError):
        index.search(rows, {1: 1.0}, "hamming")
    with pytest.raises(ValueError):
        SparseIndex(rows.sparkSession, folder)
