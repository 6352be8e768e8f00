import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import AWKWARD, WORDS, duplicate_share, quality_counts, table
from pyspark.sql import functions as F

from vectrine.llm.classifier import Model, build_dictionary, held_out, keep_good, logistic, score_quality, train, with_score
from vectrine.llm.quality_rules import DUPLICATE_LIMITS, broken_rules, judge_quality, measure

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_query_matches_plain_counts(run, docs):
    rows = run("op2_quality_rules")
    assert len(rows) == len(docs)
    for r in rows:
        assert [r[c] for c in COUNTS] == quality_counts(docs[r["doc_id"]])
        assert not (r["kept"] and r["base_failed"])


def test_awkward_rows(spark):
    rows = judge_quality(table(spark)).collect()
    assert sorted(([r["doc_id"] or 0, *[r[c] for c in COUNTS]] for r in rows), key=str) == sorted(([k or 0, *quality_counts(t)] for k, t in AWKWARD), key=str)
    assert judge_quality(table(spark, [])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb", "ccc", "é", "\n"]), max_size=60))
def test_shares_match_plain(words):
    text = " ".join(words)
    found = measure(text.encode())
    for k in DUPLICATE_LIMITS:
        assert found[f"share_{k}"] == pytest.approx(duplicate_share(WORDS.findall(text), k))


def test_each_rule_breaks():
    body = " ".join(f"w{i}" for i in range(100))
    assert broken_rules(measure(body.encode())) == []
    assert "symbols" in broken_rules(measure((body + " # |" * 10).encode()))
    assert "top_2" in broken_rules(measure((body + " same again" * 40).encode()))
    lines = "\n".join([body, *["one more line"] * 5])
    assert "lines" in broken_rules(measure(lines.encode()))


def test_rules_keep_good_documents(run, spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    rows = [r for r in run("op2_quality_rules") if r["doc_id"] in labels and not r["base_failed"]]
    good = [r["kept"] for r in rows if labels[r["doc_id"]] == 1]
    bad = [r["kept"] for r in rows if labels[r["doc_id"]] == 0]
    assert np.mean(good) > 0.95 and sum(bad) <= 0.1 * len(bad)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = score_quality(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [(truth[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 80
    assert np.mean([a == b for a, b in held]) > 0.95


def test_held_out_rule(spark):
    rows = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in rows)


def test_held_out_labels_are_not_used(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality) as quality")
    a, b = (sorted(map(tuple, score_quality(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_classifier_awkward_rows(spark):
    model = Model(build_dictionary([b"good text " * 50]), build_dictionary([b"### $$$ " * 50]), (0.0, 0.0), (1.0, 1.0), (5.0, 0.0), 0.0)
    df = table(spark).drop("score")
    rows = with_score(df, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows if not r["text"]} == {0.5}
    with pytest.raises(ValueError):
        with_score(table(spark), model)
    assert with_score(table(spark, []).drop("score"), model).collect() == []


def test_labels_without_both_classes(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None), (4, 0), (4, 1)], "doc_id long, quality int")
    assert train(table(spark), labels) is None
    assert all(r["score"] == 0.5 for r in score_quality(table(spark), labels).collect())
    assert keep_good(table(spark), table(spark), labels).count() == len(AWKWARD)
    assert score_quality(table(spark, []), labels).collect() == []


def test_logistic_finds_a_threshold():
    x = np.linspace(-1, 1, 201)[:, None]
    w = logistic(x, (x[:, 0] > 0.3).astype(float))
    assert -w[1] / w[0] == pytest.approx(0.3, abs=0.05)


def test_a_huge_labelled_text_does_not_end_the_sample(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"), spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality")
    usual = train(docs, labels, sample_bytes=1 << 20)
    ids = [i for i in range(10**6, 10**6 + 50)]
    huge = spark.createDataFrame([(i, f"bad {i} " * 150_000) for i in ids[:2]], "doc_id long, text string")
    both = train(docs.unionByName(huge), labels.unionByName(spark.createDataFrame([(i, 0) for i in ids[:2]], "doc_id long, quality int")), sample_bytes=1 << 20)
    assert both == usual
    only = spark.createDataFrame([(1, "good words here", 1), (2, "bad " * 1000, 0)], "doc_id long, text string, quality int")
    with pytest.raises(Exception, match="bytes or less"):
        train(only, only, sample_bytes=1000)
