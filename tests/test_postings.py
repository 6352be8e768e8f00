"""Top-k search over blocks of documents, and phrases from the places of tokens."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectrine.indexes import TextIndex
from vectrine.indexes.postings import BLOCK, BUCKET
from vectrine.operators.bm25 import bm25_search
from vectrine.operators.search_dict import find, where
from vectrine.sources.table import SOURCE
from vectrine.functions.text import term_counts, tokens

TOP = dict(names=["id"], with_score=True)


@pytest.fixture(scope="module")
def texts(spark):
    """2,000 texts over a few hundred words, frequent and rare ones, of very different length."""
    rng = np.random.default_rng(8)
    words = np.array([f"w{i}" for i in range(300)])
    odds = 1.0 / np.arange(1, 301)
    rows = []
    for i in range(2000):
        n = int(rng.choice([0, 3, 8, 20, 60, 200], p=[0.01, 0.29, 0.3, 0.2, 0.15, 0.05]))
        rows.append((i, " ".join(rng.choice(words, n, p=odds / odds.sum())) if n else None, f"s{i % 5}"))
    return spark.createDataFrame(rows, "id long, doc string, part string").persist()


@pytest.fixture(scope="module")
def blocked(texts, tmp_path_factory):
    return TextIndex.build(texts, str(tmp_path_factory.mktemp("blocks")), "id", "doc", 4, block_documents=20, positions=True)


QUERIES = ["w0", "w250 w3", "w0 w1 w2", "w299 w298 w17", "absent", "w5 absent w5", ""]


@pytest.mark.parametrize("text", QUERIES)
@pytest.mark.parametrize("options", [{}, {"where": "part = 's3'"}, {"threshold": 1.0}, {"where": "id % 100 = 7", "threshold": 0.2}])
def test_blocks_give_the_rows_of_the_scan(texts, blocked, text, options):
    want = bm25_search(texts, text, "doc", 10, key="id", **options, **TOP).collect()
    assert blocked.search(texts, text, 10, **options, **TOP).collect() == want


def test_few_blocks_are_read(blocked):
    total = blocked.block_bounds("w250 w3").count()
    some = blocked.blocks_for("w250 w3", 5)
    assert 0 < len(some) < total / 2
    bounds = {r[BLOCK]: r["bound"] for r in blocked.block_bounds("w250 w3").collect()}
    hits = blocked._of_terms("postings", ["w250", "w3"], None).select("id", BLOCK).distinct()
    scored = blocked.scores("w250 w3", None).join(hits, "id").collect()
    assert all(r["score"] <= bounds[r[BLOCK]] + 1e-9 for r in scored)


def test_bounds_are_grouped_where_the_texts_are_cut(texts, blocked):
    most = TextIndex._bounds(texts.withColumn(SOURCE, F.lit("")), blocked.state, 5)
    plan = most._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan and most.rdd.getNumPartitions() == 5
    of = [BUCKET, "term", BLOCK, SOURCE]
    want = blocked._read("postings").groupBy(*of).agg(F.count("*").alias("rows"), F.max("tf").alias("tf"), F.min("length").alias("length"))
    assert sorted(most.select(*want.columns).collect()) == sorted(want.collect())
    assert sorted(blocked._read("bounds").select(*want.columns).collect()) == sorted(want.collect())


def test_texts_not_indexed_yet_are_cut_twice_only(spark, texts, blocked, folder):
    cut = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def made(t):
        cut.add(1)
        return t

    index = TextIndex.build(texts.filter("id % 3 > 0"), folder, "id", "doc", 4)
    fresh = texts.filter("id % 3 = 0").repartition(2).withColumn("doc", made("doc"))
    n = texts.filter("id % 3 = 0").count()
    for text in QUERIES:
        cut.value = 0
        assert sorted(index.scores(text, fresh=fresh).collect()) == sorted(blocked.scores(text).collect())
        assert cut.value <= 2 * n


def test_more_rows_than_the_first_blocks_hold(texts, blocked):
    want = bm25_search(texts, "w0 w9", "doc", 1500, key="id", **TOP).collect()
    assert blocked.search(texts, "w0 w9", 1500, **TOP).collect() == want
    assert blocked.blocks_for("absent", 5) is None


def test_a_refreshed_index_keeps_blocks_and_places(spark, texts, folder):
    index = TextIndex.build(texts.filter("id % 3 > 0"), folder, "id", "doc", 4, block_documents=20, positions=True)
    changed = texts.withColumn("doc", F.when(F.col("id") % 10 == 1, F.lit("w7 w8 w9")).otherwise(F.col("doc")))
    index = index.refresh(changed)
    assert index.search(changed, "w7 w8", 10, **TOP).collect() == bm25_search(changed, "w7 w8", "doc", 10, key="id", **TOP).collect()
    assert {r["id"] for r in index.phrase("w7 w8 w9").collect()} == {r["id"] for r in changed.filter("contains(concat(' ', doc, ' '), ' w7 w8 w9 ')").collect()}
    again = index.rebuild(changed)
    assert again.state["positions"] and again.state["block_documents"] == 20


def test_store_searches_blocks_of_a_changed_table(spark, store, texts):
    from vectrine.sources import DataType, field, table_schema

    fields = [field("id", DataType.INT64, primary=True), field("doc", DataType.STRING, nullable=True)]
    texts = texts.drop("part")
    store.create_collection("t", schema=table_schema(fields), index_params=[{"name": "words", "column": "doc", "kind": "text", "block_documents": 20, "positions": True}])
    store.insert("t", texts.filter("id < 900"))
    store.rebuild_index("t", "words")
    store.insert("t", texts.filter("id >= 900 AND id < 1200"))
    store.delete("t", where="id % 4 = 1")
    now = texts.filter("id < 1200 AND id % 4 <> 1")
    for text in ("w250 w3", "w0"):
        want = bm25_search(now, text, "doc", 10, key="id", **TOP).collect()
        assert store.bm25_search("t", text, "doc", 10, index="words", **TOP).collect() == want


@pytest.mark.parametrize("text", ["w0 w1", "w0 w0", "w1 w0 w1", "w3", "w0 w0 w0 w0", "w299 w298", "W0, w1!"])
def test_phrases_of_the_index_and_of_the_text(texts, blocked, text):
    clause = {"match_phrase": {"doc": text}}
    want = {r["id"] for r in texts.filter(where(clause, texts.schema, True)).collect()}
    assert {r["id"] for r in blocked.phrase(text).collect()} == want
    got = find(texts, clause, key="id", text_indexes={"doc": blocked})
    assert got.columns == texts.columns and {r["id"] for r in got.collect()} == want


@pytest.mark.parametrize(
    "body",
    [
        {"bool": {"must": [{"match": {"doc": "w200 w201"}}], "must_not": [{"match_phrase": {"doc": "w0 w1"}}]}},
        {"bool": {"should": [{"match_phrase": {"doc": "w2 w3"}}, {"term": {"part": "s1"}}]}},
        {"query_string": {"query": "w150", "fields": ["doc^2"]}},
        [{"match": {"doc": "!!"}}],
        [{"match_phrase": {"doc": "!!"}}],
        {"match": {"part": "s2"}},
        {},
    ],
)
def test_dictionaries_through_the_index(texts, blocked, body):
    want = texts.filter(where(body, texts.schema, True)).collect()
    got = find(texts, body, key="id", text_indexes={"doc": blocked}).collect()
    assert sorted(got, key=lambda r: r["id"]) == sorted(want, key=lambda r: r["id"])


def test_an_index_without_positions_reads_the_text(spark, texts, folder):
    index = TextIndex.build(texts, folder, "id", "doc", 4)
    with pytest.raises(ValueError):
        index.phrase("w0 w1")
    body = {"match_phrase": {"doc": "w0 w1"}}
    want = {r["id"] for r in texts.filter(where(body, texts.schema, True)).collect()}
    assert {r["id"] for r in find(texts, body, key="id", text_indexes={"doc": index}).collect()} == want
    assert index.blocks_for("w0", 3) is None


def test_places_of_terms(spark):
    rows = spark.createDataFrame([("b a, b! 漢字漢",), ("",), (None,)], "t string")
    got = rows.select(term_counts("t", True).alias("c"), tokens("t").alias("k")).collect()
    assert [(x["term"], x["tf"], x["places"]) for x in got[0]["c"]["terms"]] == [("a", 1, [1]), ("b", 2, [0, 2]), ("字", 1, [4]), ("漢", 2, [3, 5])]
    assert got[1]["c"]["terms"] == [] and got[2]["c"]["length"] == 0
