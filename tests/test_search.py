"""Vector, text and hybrid search on small fixtures, and properties on the driver tables."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectrine.functions import (
    decode_vectors,
    l2_distance,
    metric,
    sparse_from_text,
    sparse_to_text,
    split_valid,
    tokens,
    vector_from_text,
    vector_to_text,
)
from vectrine.indexes import TextIndex, VectorIndex, postings_of
from vectrine.indexes.vectors import CELL, CODES
from vectrine.operators import (
    bm25_search,
    hybrid_search,
    knn,
    knn_join,
    match_against,
    scoring_clauses,
    search,
    search_hybrid,
    where,
)
from vectrine.operators.bm25 import with_bm25

SENTENCES = [
    (1, "i love the sea"),
    (2, "the sea is deep and blue"),
    (3, "tea or coffee"),
    (4, "you like reading books"),
    (5, "i like coding"),
    (6, "they like walking in the green park"),
]


@pytest.fixture(scope="module")
def sentences(spark):
    return spark.createDataFrame(SENTENCES, "id int, doc string").cache()


@pytest.fixture(scope="module")
def points(table):
    return table("embeddings").cache()


def brute(points, query, k, cost):
    rows = [(round(cost(np.array(r["embedding"], dtype=float), query), 6), r["vec_id"]) for r in points.collect()]
    return sorted(rows)[:k]


# --- codecs ----------------------------------------------------------------------------


def test_vector_texts(spark):
    rows = [("[1,2,3]",), ("[1.5, -2e3,.5]",), ("[1,x]",), ("1,2",), ("[]",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    got = [r["v"] for r in df.select(vector_from_text("t").alias("v")).collect()]
    assert got == [[1.0, 2.0, 3.0], [1.5, -2000.0, 0.5], None, None, None, None]
    good, bad = decode_vectors(df, "t", "v", dim=3)
    assert good.count() == 3 and {r["t"] for r in bad.collect()} == {"[1,x]", "1,2", "[]"}
    raw = spark.createDataFrame([(bytearray(b"[1, 2.5]"),), (bytearray(b"nope"),)], "t binary")
    good, bad = decode_vectors(raw, "t", "v")
    assert [r["v"] for r in good.collect()] == [[1.0, 2.5]] and bad.count() == 1


def test_vector_text_round_trip(spark, points):
    back = points.select("vec_id", "embedding", vector_from_text(vector_to_text("embedding")).alias("v"))
    assert back.filter(F.col("v") != F.col("embedding")).count() == 0


def test_sparse_texts(spark):
    rows = [("{1:1.1, 2:2.2}",), ("{ 7 : -3 , }",), ("{}",), ("{1:2, 1:5}",), ("{a:1}",), ("{1:2 3:4}",), ("{1:2,,}",)]
    df = spark.createDataFrame(rows, "t string").select(sparse_from_text("t").alias("v"))
    got = [r["v"] for r in df.collect()]
    assert {k: round(v, 5) for k, v in got[0].items()} == {1: 1.1, 2: 2.2}
    assert got[1:] == [{7: -3.0}, {}, {1: 5.0}, None, None, None]
    text = spark.createDataFrame([({1: 1.5},)], "v map<int,float>").select(sparse_to_text("v")).first()[0]
    assert text == "{1: 1.5}"


def test_split_valid(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],), ([1.0, None],), (None,)], "v array<float>")
    good, bad = split_valid(df, "v", 2)
    assert good.count() == 2 and bad.count() == 2


# --- distances and kNN ---------------------------------------------------------------


def test_metric_names():
    assert metric("COSINE").name == "cosine"
    with pytest.raises(ValueError):
        metric("dot")
    with pytest.raises(TypeError):
        metric(3)


def test_cosine_fixture(spark):
    rows = [(i, [1.2, 0.5, 0.7]) for i in range(10)] + [(i, [0.34, 0.3, 1.64]) for i in (10, 11, 12, 111, 112)]
    df = spark.createDataFrame(rows, "id long, embedding array<float>")
    out = search(df, [0, 0, 1], "embedding", key="id", search_params={"metric_type": "cosine"}, limit=5)
    assert [r["id"] for r in out.collect()] == [10, 11, 12, 111, 112]
    with pytest.raises(ValueError):
        search(df, "abc", "embedding", key="id")


def test_undefined_distances_come_last(spark):
    rows = [(1, [0.0, 0.0]), (2, None), (3, [1.0, 1.0]), (4, [1.0]), (5, [1.0, None])]
    df = spark.createDataFrame(rows, "id int, v array<float>")
    got = knn(df, [1.0, 1.0], "v", "cosine", 5, key="id", names=["id"], with_score=True, digits=6).collect()
    assert [(r["id"], r["score"]) for r in got] == [(3, 0.0), (1, None), (2, None), (4, None), (5, None)]


@pytest.mark.parametrize("dim", [2, 255, 256, 768])
@pytest.mark.parametrize("name", ["l2", "cosine", "ip"])
def test_one_rule_for_every_length(spark, dim, name):
    rng = np.random.default_rng(dim)
    rows = [(i, rng.normal(size=dim).astype("float32").tolist()) for i in range(20)]
    odd = [(20, None), (21, [1.0]), (22, [float("nan")] + [1.0] * (dim - 1)), (23, [None] + [1.0] * (dim - 1))]
    df = spark.createDataFrame(rows + odd, "id int, v array<float>")
    q = rows[7][1]
    got = knn(df, q, "v", name, 24, key="id", names=["id"], with_score=True, digits=6).collect()
    x, y = np.array([v for _, v in rows], dtype=np.float64), np.array(q, dtype=np.float64)
    want = {"l2": np.linalg.norm(x - y, axis=1), "ip": x @ y, "cosine": 1 - x @ y / np.linalg.norm(x, axis=1) / np.linalg.norm(y)}[name]
    order = np.argsort(-want if name == "ip" else want)
    assert [r["id"] for r in got] == [*order.tolist(), 20, 21, 22, 23]
    assert [r["score"] for r in got[:20]] == pytest.approx(want[order].tolist(), abs=2e-6)
    assert all(r["score"] is None for r in got[20:])
    joined = knn_join(df.filter("id = 7"), df, query_key="id", query_vector="v", key="id", vector="v", metric=name, k=24, digits=6)
    assert [tuple(r) for r in joined.orderBy("rank").select("id", "score").collect()] == [tuple(r) for r in got]


def test_distance_rounds_the_query_to_float32(spark):
    df = spark.createDataFrame([(1, [0.1, 0.2])], "id int, v array<float>")
    assert df.select(l2_distance("v", [0.1, 0.2])).first()[0] == 0.0


@pytest.mark.parametrize("name", ["l2", "cosine", "ip"])
def test_join_in_blocks_equals_single_searches(points, name):
    wanted = points.filter("vec_id in (3, 50, 111, 402)")
    options = dict(query_key="vec_id", query_vector="embedding", key="vec_id", vector="embedding", metric=name, k=5, digits=6)
    one = knn_join(wanted, points.repartition(3), **options)
    many = knn_join(wanted, points.repartition(5), block_bytes=2 * 64 * 8, **options)
    got = sorted(map(tuple, one.select("query_id", "rank", "vec_id", "score").collect()))
    assert got == sorted(map(tuple, many.select("query_id", "rank", "vec_id", "score").collect()))
    assert len(got) == 20
    for row in wanted.collect():
        single = knn(points, list(row["embedding"]), "embedding", name, 5, key="vec_id", names=["vec_id"], with_score=True, digits=6)
        mine = [(v, s) for q, _, v, s in got if q == row["vec_id"]]
        assert mine == [tuple(r) for r in single.collect()]


def test_join_with_a_third_copies_and_string_keys(spark):
    rng = np.random.default_rng(1)
    hot = [1.0, 0.0, 0.0, 0.0]
    rows = [(f"k{i:04d}", hot if i % 3 == 0 else rng.normal(size=4).astype("float32").tolist()) for i in range(900)]
    rows.append(("none", None))
    df = spark.createDataFrame(rows, "id string, v array<float>").repartition(4)
    queries = spark.createDataFrame([("a", hot), ("b", [0.5, 0.5, 0.0, 0.0])], "q string, v array<float>")
    got = knn_join(queries, df, query_key="q", query_vector="v", key="id", vector="v", k=400, digits=6).collect()
    mine = {q: [(r["score"], r["id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in "ab"}
    for q, vector in (("a", hot), ("b", [0.5, 0.5, 0.0, 0.0])):
        want = sorted((round(math.dist(v, vector), 6), i) for i, v in rows if v)[:400]
        assert mine[q] == want


def test_join_returns_undefined_scores_last(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 1.0])], "id int, v array<float>")
    got = knn_join(df.filter("id = 2"), df, query_key="id", query_vector="v", key="id", vector="v", metric="cosine", k=3)
    assert [(r["id"], r["score"]) for r in got.orderBy("rank").collect()] == [(2, 0.0), (1, None)]


def test_hamming_join(spark):
    rows = [(0, [True, False, True]), (1, [True, True, True]), (2, [False, True, False])]
    df = spark.createDataFrame(rows, "id int, v array<boolean>")
    got = knn_join(df, df, query_key="id", query_vector="v", key="id", vector="v", metric="hamming", k=2)
    pairs = {(r["query_id"], r["rank"]): (r["id"], r["score"]) for r in got.collect()}
    assert pairs[(0, 1)] == (0, 0.0) and pairs[(0, 2)] == (1, 1.0) and pairs[(2, 2)] == (1, 2.0)
    single = knn(df, [True, False, True], "v", "hamming", 3, key="id", names=["id"], with_score=True)
    assert [tuple(r) for r in single.collect()] == [(0, 0.0), (1, 1.0), (2, 3.0)]


def test_sparse_distances(spark):
    rows = [(1, {1: 1.0, 2: 2.0}), (2, {3: 4.0}), (3, {}), (4, {1: 1.0, 5: 3.0})]
    df = spark.createDataFrame(rows, "id int, v map<int,float>")
    q = {1: 1.0, 5: 3.0}
    near = knn(df, q, "v", "l2", 4, key="id", names=["id"], with_score=True).collect()
    assert [r["id"] for r in near] == [4, 3, 1, 2] and near[0]["score"] == 0.0
    assert near[3]["score"] == pytest.approx(math.sqrt(16 + 10))
    best = knn(df, q, "v", "ip", 2, key="id", names=["id"], with_score=True).collect()
    assert [tuple(r) for r in best] == [(4, 10.0), (1, 1.0)]
    angle = knn(df, q, "v", "cosine", 4, key="id", names=["id"], with_score=True).collect()
    assert angle[0]["score"] == pytest.approx(0.0) and angle[3]["score"] is None
    assert knn(df, {}, "v", "l2", 1, key="id", names=["id"]).first()["id"] == 3
    with pytest.raises(ValueError):
        knn(df, q, "v", "hamming", key="id")


def test_top_k_plan_keeps_local_tops(points):
    plan = knn(points, [0.0] * 64, "embedding", key="vec_id", names=["vec_id"])._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange rangepartitioning" not in plan


# --- vector indexes ------------------------------------------------------------------


@pytest.fixture(scope="module")
def index(spark, points):
    from vectrine.session import shared_dir

    return VectorIndex.build(points, shared_dir(spark), "vec_id", "embedding", 8, "l2", pq_segments=8, pq_codes=16)


def test_full_probe_equals_exact(points, index):
    q = list(points.filter("vec_id = 9").first()["embedding"])
    exact = knn(points, q, "embedding", k=20, key="vec_id", names=["vec_id"], with_score=True, digits=6).collect()
    assert index.search(q, 20, index.nlist, names=["vec_id"], with_score=True, digits=6).collect() == exact
    near = index.search(q, 20, 3, names=["vec_id"], with_score=True, digits=6).collect()
    assert near[0] == exact[0] and len({r["vec_id"] for r in near} & {r["vec_id"] for r in exact}) >= 8
    refined = index.search(q, 10, index.nlist, refine=10, names=["vec_id"], digits=6).collect()
    assert len({r["vec_id"] for r in refined} & {r["vec_id"] for r in exact[:10]}) >= 7


def test_every_row_is_in_its_nearest_cell(points, index):
    centres = index._centre_matrix()
    rows = index.rows().collect()
    assert sorted(r["vec_id"] for r in rows) == sorted(r["vec_id"] for r in points.select("vec_id").collect())
    for r in rows:
        gaps = ((centres - np.array(r["embedding"])) ** 2).sum(axis=1)
        assert gaps[r[CELL]] <= gaps.min() + 1e-9
        assert len(r[CODES]) == 8


def test_probe_reads_only_its_cells(points, index):
    q = list(points.first()["embedding"])
    plan = index.search(q, 5, 2, names=["vec_id"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(__cell" in plan or "PartitionFilters: [__cell" in plan


def test_refresh_and_rebuild(spark, points, folder):
    part = VectorIndex.build(points.filter("vec_id < 300"), folder, "vec_id", "embedding", 4, "cosine")
    grown = part.refresh(points)
    assert grown.rows().count() == points.count() and np.allclose(grown._centre_matrix(), part._centre_matrix())
    assert part.rows().count() == 300
    again = grown.rebuild(points.filter("label <> 1"))
    assert again.rows().filter("label = 1").count() == 0 and again.metric == "cosine"


def test_rows_without_a_cell_are_kept(spark, points, folder):
    odd = spark.createDataFrame([(9001, None, 0), (9002, [0.0] * 64, 0)], points.schema)
    built = VectorIndex.build(points.unionByName(odd), folder, "vec_id", "embedding", 4, "cosine")
    assert {r["vec_id"] for r in built.rows().filter("__cell = -1").collect()} == {9001, 9002}
    with pytest.raises(ValueError):
        VectorIndex.build(points, folder, "vec_id", "embedding", 4, "ip")


def test_cells_of_a_third_copies(spark, folder):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 0.0] if i % 3 == 0 else rng.normal(size=2).astype("float32").tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, v array<float>").repartition(4)
    built = VectorIndex.build(df, folder, "id", "v", 5)
    assert built.rows().count() == 600
    exact = knn(df, [1.0, 0.1], "v", k=300, key="id", names=["id"], with_score=True, digits=6).collect()
    assert built.search([1.0, 0.1], 300, 5, names=["id"], with_score=True, digits=6).collect() == exact


def test_nearest_centres_in_pieces(monkeypatch):
    from vectrine.functions import kernels

    rng = np.random.default_rng(3)
    x, c = rng.normal(size=(50, 4)), rng.normal(size=(7, 4))
    whole = kernels.nearest_rows(x, c)
    monkeypatch.setattr(kernels, "PRODUCT_CELLS", 20)
    assert (kernels.nearest_rows(x, c)[0] == whole[0]).all()
    gaps = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert (whole[0] == gaps.argmin(axis=1)).all()


# --- text --------------------------------------------------------------------------


def test_tokens(spark):
    rows = [("Hello, World2!",), ("人工智能AI芯片",), ("",), (None,), ("x_y-z\n42",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(tokens("t")).collect()]
    assert got == [["hello", "world2"], ["人", "工", "智", "能", "ai", "芯", "片"], [], [], ["x", "y", "z", "42"]]


def test_bm25_fixture(sentences):
    out = bm25_search(sentences, "like", "doc", 1, key="id", where="id > 4", with_score=True).collect()
    assert [(r["id"], r["doc"]) for r in out] == [(5, "i like coding")]
    every = bm25_search(sentences, "LIKE", "doc", key="id", with_score=True).collect()
    assert [r["id"] for r in every] == [5, 4, 6]
    n, df, lengths = 6, 3, [len(t.split()) for _, t in SENTENCES]
    mean = sum(lengths) / n
    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
    for r in every:
        length = len(r["doc"].split())
        assert r["score"] == pytest.approx(idf * 2.2 / (1 + 1.2 * (0.25 + 0.75 * length / mean)), abs=1e-6)


def test_bm25_options(sentences):
    rows = bm25_search(sentences, "like", "doc", key="id", matching_only=False, with_score=True).collect()
    assert [r["id"] for r in rows] == [5, 4, 6, 1, 2, 3] and rows[-1]["score"] == 0.0
    top = bm25_search(sentences, "like", "doc", key="id", with_score=True).first()["score"]
    assert bm25_search(sentences, "like", "doc", key="id", threshold=top).count() == 1
    assert bm25_search(sentences, "zebra !!", "doc", key="id").count() == 0
    assert bm25_search(sentences, "...", "doc", key="id").count() == 0
    with pytest.raises(ValueError):
        bm25_search(sentences, 5, "doc", key="id")
    with pytest.raises(ValueError):
        match_against(sentences, "x", [], key="id")


def test_index_search_equals_direct_search(sentences, folder):
    index = TextIndex.build(sentences, folder, "id", "doc", buckets=3)
    for text in ("like", "the sea", "i like the green sea tea", "nothing here matches zebra"):
        direct = bm25_search(sentences, text, "doc", key="id", with_score=True).collect()
        assert index.search(sentences, text, with_score=True).collect() == direct
    some = index.search(sentences, "like the", where="id > 4", threshold=0.5, names=["id"], with_score=True).collect()
    direct = bm25_search(sentences, "like the", "doc", key="id", where="id > 4", threshold=0.5, names=["id"], with_score=True)
    assert some == direct.collect()
    assert index.statistics().first()["n_docs"] == 6


def test_refresh_equals_rebuild(spark, sentences, folder):
    old = spark.createDataFrame([(1, "i love the sea"), (2, "an older text"), (9, "gone soon like this")], "id int, doc string")
    index = TextIndex.build(old, folder, "id", "doc", buckets=3).refresh(sentences)
    want = {tuple(r) for r in postings_of(sentences, "id", "doc").collect()}
    assert {tuple(r) for r in index.postings().select("id", "term", "tf", "length").collect()} == want
    fresh = index.rebuild(sentences)
    assert {tuple(r) for r in fresh.terms().collect()} == {tuple(r) for r in index.terms().collect()}
    assert fresh.version == 2 and index.statistics().collect() == fresh.statistics().collect()


def test_texts_that_are_copies_and_one_dominant_term(spark, folder):
    rows = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'same words here', concat('word', id, ' here')) as t").repartition(4)
    direct = bm25_search(rows, "same here", "t", 1500, key="id", names=["id"], with_score=True).collect()
    assert [r["id"] for r in direct[:1000]] == list(range(0, 3000, 3))
    index = TextIndex.build(rows, folder, "id", "t")
    assert index.search(rows, "same here", 1500, names=["id"], with_score=True).collect() == direct


def test_scores_keep_every_row(sentences):
    out = with_bm25(sentences, [], score="s", matched="m").collect()
    assert len(out) == 6 and {(r["s"], r["m"]) for r in out} == {(0.0, False)}


# --- search dictionaries ---------------------------------------------------------------


@pytest.mark.parametrize(
    "body, error",
    [
        ({"bool": {"should": [{"term": {"id": 1}}], "minimum_should_match": 2}}, NotImplementedError),
        ({"wildcard": {"id": "x"}}, NotImplementedError),
        ({"term": {"id; drop": 1}}, ValueError),
        ({"term": {"nope": 1}}, ValueError),
        ({"term": {"doc": "a\nb"}}, ValueError),
        ({"term": {"id": None}}, TypeError),
        ({"term": {"id": {"value": 1}}}, TypeError),
        ({"term": {"id": 1, "doc": "x"}}, ValueError),
        ({"term": {"id": 1}, "range": {"id": {}}}, ValueError),
        ("id = 1", ValueError),
    ],
)
def test_bad_dictionaries(sentences, body, error):
    with pytest.raises(error):
        where(body, sentences.schema)


def test_dictionary_defaults(sentences):
    def ids(body, **options):
        return {r["id"] for r in sentences.filter(where(body, sentences.schema, **options)).collect()}

    everything = {1, 2, 3, 4, 5, 6}
    assert ids({}) == ids([]) == ids({"bool": {}}) == ids({"range": {"id": {}}}) == everything
    assert ids({"terms": {"id": []}}) == set()
    assert ids({"bool": {"must_not": [{"match": {"doc": "sea"}}]}}) == set()
    assert ids({"bool": {"should": [{"match": {"doc": "sea"}}, {"term": {"id": 3}}]}}) == everything
    assert ids({"match": {"doc": {"query": "sea tea"}}}, text_filters=True) == {1, 2, 3}
    assert ids({"match_phrase": {"doc": "sea is"}}, text_filters=True) == {2}
    assert ids({"term": {"id": True}}) == {1}


def test_scoring_clauses():
    body = {
        "bool": {
            "must": {"match": {"a": " x y "}},
            "should": [{"match_phrase": {"b": {"query": "p q"}}}, {"term": {"c": 1}}],
            "filter": [{"bool": {"must_not": [{"query_string": {"query": "z", "fields": ["d^3"]}}]}}],
            "must_not": [{"match": {"e": "  "}}, {"query_string": {"query": "z", "fields": []}}],
        }
    }
    # branches in the order must, filter, should, must_not
    assert scoring_clauses(body) == [("a", "x y"), ("d", "z"), ("b", "p q")]
    with pytest.raises(NotImplementedError):
        scoring_clauses({"query_string": {"query": "z", "fields": ["a", "b"]}})


# --- hybrid ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def articles(spark):
    rows = [
        (1, "s0", 1, [1.0, 2.0, 3.0], "新闻", "今天的天气很好"),
        (2, "s1", 1, [1.0, 2.0, 3.1], "AI", "人工智能 changes industry"),
        (3, "s1", 1, [4.0, 2.0, 3.0], "chips", "芯片 and 人工智能"),
        (4, "s1", 0, [1.0, 2.0, 3.0], "hidden", "人工智能 人工智能"),
    ]
    return spark.createDataFrame(rows, "id int, source_id string, enabled int, vector array<float>, title string, content string")


def body(**more):
    return {
        "query": {
            "bool": {
                "must": [{"query_string": {"query": "人工智能", "fields": ["content"]}}],
                "filter": [
                    {"terms": {"source_id": ["s1", "s2"]}},
                    {"bool": {"must_not": [{"range": {"enabled": {"lt": 1}}}]}},
                ],
            }
        },
        "knn": {"field": "vector", "query_vector": [1, 2, 3], "k": 1, "num_candidates": 5, "similarity": 0.1},
        "size": 60,
        "from": 7,
        **more,
    }


def test_hybrid_fixture(articles):
    rows = hybrid_search(articles, body()).collect()
    assert {r["id"] for r in rows} == {2, 3}
    assert all(r["_distance"] == 0.0 and r["_score"] > 0 for r in rows)
    true = {r["id"]: r for r in hybrid_search(articles, body(), merge="true_values").collect()}
    assert true[2]["_distance"] == pytest.approx(0.1, abs=1e-5) and true[3]["_distance"] == 3.0
    assert true[2]["hybrid_score"] == pytest.approx(0.5 * true[2]["_score"] - 0.05, abs=1e-5)


def test_hybrid_without_text_is_a_vector_search(articles):
    plain = {"knn": {"field": "vector", "query_vector": [1, 2, 3], "filter": {"term": {"enabled": 1}}}, "size": 2}
    rows = hybrid_search(articles, plain).collect()
    assert [(r["id"], r["_score"]) for r in rows] == [(1, 0.0), (2, 0.0)]


def test_hybrid_through_indexes(articles, folder):
    index = TextIndex.build(articles, folder, "id", "content")
    assert hybrid_search(articles, body(), text_indexes={"content": index}).collect() == hybrid_search(articles, body()).collect()


@pytest.mark.parametrize(
    "wrong",
    [
        [],
        {},
        {"knn": {"field": "vector"}},
        {"knn": {"query_vector": [1]}},
        {"knn": {"field": "vector", "query_vector": "abc"}},
        {"knn": {"field": "vector", "query_vector": ["a"]}},
        {"knn": {"field": "vector", "query_vector": [1], "metric": "ip"}},
        {"knn": {"field": "vector", "query_vector": [1]}, "hybrid_weights": {"knn": -1}},
    ],
)
def test_bad_bodies(articles, wrong):
    with pytest.raises(ValueError):
        hybrid_search(articles, wrong)


def test_linear_mix(articles):
    def order(alpha, **options):
        out = search_hybrid(articles, [1, 2, 3], "vector", "人工智能", "content", key="id", alpha=alpha, names=["id"], **options)
        return [r["id"] for r in out.collect()]

    assert order(1.0) == [1, 4, 2, 3]
    assert order(0.0)[0] == 4 and order(0.0)[-1] == 1
    assert order(0.0, as_written=True)[0] == 1
    assert order(0.5, distance_threshold=0.0) == [4, 1]
    assert 1 not in order(0.5, bm25_score_threshold=0.01)


def test_hybrid_reads_the_table_three_times(articles):
    """Once for the statistics and once per branch."""
    scans = hybrid_search(articles, body())._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation")
    rdds = hybrid_search(articles, body())._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD")
    assert scans + rdds <= 3


@pytest.mark.parametrize("wrong", [{"size": True}, {"size": "3"}, {"hybrid_weights": {"knn": True}}, {"hybrid_weights": [1]}])
def test_truth_values_are_no_numbers(articles, wrong):
    with pytest.raises(ValueError, match="body"):
        hybrid_search(articles, {"knn": {"field": "vector", "query_vector": [1, 2, 3]}, **wrong})


def test_post_filter_widens_until_enough_pass(points):
    q = list(points.first()["embedding"])
    wide = knn(points, q, "embedding", k=5, key="vec_id", names=["vec_id"], where="vec_id % 97 = 5", post_filter=True).collect()
    assert wide == knn(points, q, "embedding", k=5, key="vec_id", names=["vec_id"], where="vec_id % 97 = 5").collect() and len(wide) == 5
    assert knn(points, q, "embedding", k=5, key="vec_id", names=["vec_id"], where="vec_id % 97 = 5", post_filter=True, expand=1).count() < 5


def test_joins_beyond_a_broadcast_do_not_pass_the_driver(points):
    big = knn_join(points, points, query_key="vec_id", query_vector="embedding", key="vec_id", vector="embedding", k=3, digits=6, block_bytes=64 * 8 * 100)
    plan = big._jdf.queryExecution().toString()
    assert "FlatMapCoGroups" in plan and "MapInArrow" not in plan and "CartesianProduct" not in plan
    one = knn_join(points, points, query_key="vec_id", query_vector="embedding", key="vec_id", vector="embedding", k=3, digits=6)
    assert sorted(map(tuple, big.collect())) == sorted(map(tuple, one.collect()))


def test_reserved_names_of_indexes(spark, points, folder):
    user = points.withColumn("cell", F.lit(7)).withColumn("codes", F.lit("mine"))
    built = VectorIndex.build(user, folder, "vec_id", "embedding", 4)
    row = built.search([0.0] * 64, 1, 4, names=["cell", "codes"]).first()
    assert tuple(row) == (7, "mine")
    for name in (CELL, CODES):
        with pytest.raises(ValueError):
            VectorIndex.build(points.withColumn(name, F.lit(1)), folder, "vec_id", "embedding", 4)
    with pytest.raises(ValueError):
        TextIndex.build(spark.createDataFrame([("a", "x")], "term string, t string"), folder, "term", "t")


def test_length_of_an_index_is_that_of_most_vectors(spark, folder):
    rows = [(i, [float(i), 1.0]) for i in range(50)] + [(100 + i, [1.0, 2.0, 3.0]) for i in range(8)] + [(200, [float("nan"), 1.0])]
    df = spark.createDataFrame(rows, "id int, v array<float>")
    built = VectorIndex.build(df, folder, "id", "v", 4)
    assert built.dim == 2 and built.rows().filter("__cell = -1").count() == 9
    assert built.search([0.0, 1.0], 3, 4, names=["id"]).collect() == knn(df, [0.0, 1.0], "v", k=3, key="id", names=["id"]).collect()
    assert VectorIndex.build(df, folder, "id", "v", 4, dim=3).dim == 3


def test_all_rows_are_trained_on_and_training_data_goes(spark, points, folder):
    built = VectorIndex.build(points, folder, "vec_id", "embedding", 2)
    assert not [f for f in built._commits.folders(folder) if f.startswith("training")]
    centres = built._centre_matrix()
    members = {c: [r["embedding"] for r in built.rows().filter(F.col(CELL) == c).collect()] for c in range(2)}
    for c, rows in members.items():
        assert np.allclose(np.mean(rows, axis=0), centres[c], atol=0.05)


def test_terms_are_counted_inside_the_row(spark, sentences):
    plan = postings_of(sentences, "id", "doc")._jdf.queryExecution().toString()
    assert "Exchange" not in plan
    df = spark.createDataFrame([(1, "b a b"), (2, ""), (3, None)], "id int, t string")
    assert sorted(tuple(r) for r in postings_of(df, "id", "t").collect()) == [(1, "a", 1, 3), (1, "b", 2, 3)]


def test_search_ranks_only_rows_the_table_has(sentences, folder):
    index = TextIndex.build(sentences, folder, "id", "doc")
    left = sentences.filter("id <> 5")
    assert [r["id"] for r in index.search(left, "like", 1).collect()] == [4]
