import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import AWKWARD, LONG, contamination, table

from vectrine.llm import decontaminate
from vectrine.llm.decontaminate import WordHashes, contamination_report, drop_contaminated, gram_size, winnow

ITEMS = [
    (1, "quick brown fox jumps over the lazy dog near the old river bank"),
    (2, "NO KEY"),
    (3, None),
    (4, " ... "),
    (5, "near the old"),
    (5, "near the old"),
    (None, "over the lazy"),
    (10, " ".join(LONG.split()[200:240])),
    (9, "near the old"),
]


def bench(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as copy", "2 as len", "3 as key")


def test_query_matches_plain_search(run, docs, spark):
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    rows = run("op6_decontamination")
    assert len(rows) == len(docs)
    for r in rows:
        assert tuple(r)[1:] == contamination(docs[r["doc_id"]], items)


@pytest.mark.parametrize("window", [10, 3, 1])
def test_awkward_rows(spark, window):
    rows = contamination_report(table(spark), bench(spark), window=window).collect()
    want = [(k, *contamination(t, ITEMS, window)) for k, t in AWKWARD]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    assert contamination_report(table(spark, []), bench(spark)).collect() == []
    rows = contamination_report(table(spark), bench(spark, [])).collect()
    assert len(rows) == len(AWKWARD) and not any(r["contaminated"] for r in rows)


def test_contaminated_rows_go(spark):
    kept = drop_contaminated(table(spark), bench(spark))
    want = [k for k, t in AWKWARD if not contamination(t, ITEMS)[-1]]
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == sorted(k or 0 for k in want)
    assert kept.columns == table(spark).columns


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=40), st.integers(1, 10))
def test_shared_spans_share_a_fingerprint(words, window):
    """Equal windows select the same place wherever they stand, so none is missed."""
    words = [w.encode() for w in words]
    window = min(window, len(words))
    hashes = WordHashes().of(words)
    chosen = set(winnow(hashes, window)[0].tolist())
    by_window = {}
    for i in range(len(words) - window + 1):
        (at,), (fp,) = winnow(hashes[i : i + window], window)
        assert i + int(at) in chosen
        assert by_window.setdefault(tuple(words[i : i + window]), (int(at), int(fp))) == (int(at), int(fp))


def test_winnowing_keeps_few_fingerprints():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    at, _ = winnow(hashes, 10)
    k = gram_size(10)
    assert len(at) < 1.1 * 2 / (10 - k + 2) * len(hashes)


def test_hits_are_confirmed_by_words(spark, monkeypatch):
    """With a hash that says nothing every k-gram is a candidate, and the words alone decide."""
    items = [(1, "a b c d e"), (2, "c d e f"), (3, "x a b c d e"), (4, "e e e e e"), (5, "b")]
    docs = [(1, "a b c d e f"), (2, "c d e"), (3, "z a b c d y b"), (4, "e e e e"), (5, "q r s"), (6, "f e d c b a")]
    monkeypatch.setattr(decontaminate, "gram_size", lambda window: 1)
    monkeypatch.setattr(decontaminate.WordHashes, "of", lambda self, words: np.full(len(words), 7, dtype=np.uint64))
    places = decontaminate._places([b"a", b"b"], decontaminate.WordHashes().of([b"a", b"b"]), 1)
    assert len({p["fp"] for p in places}) == 1
    units = decontaminate.written(_places_of(spark, items, 3).selectExpr("id as class", "len", "fp", "lead", "words"))
    found = decontaminate._runs(_places_of(spark, docs, 3).selectExpr("id as context", "len", "fp", "lead", "words"), units)
    got = {(r["context"], r["class"]) for r in found.collect()}
    for doc, text in docs:
        for item, other in items:
            windows = {tuple(other.split()[i : i + 3]) for i in range(len(other.split()) - 2)} or {tuple(other.split())}
            have = any(tuple(text.split()[i : i + len(w)]) == w for w in windows for i in range(len(text.split())))
            assert ((doc, item) in got) <= have


def _places_of(spark, texts, window):
    rows = []
    for key, text in texts:
        words = decontaminate.words_of(text)
        for p in decontaminate._places(words, decontaminate.WordHashes().of(words), min(window, len(words))):
            rows.append((key, p["len"], p["fp"], p["lead"], p["words"]))
    return spark.createDataFrame(rows, "id long, len int, fp long, lead int, words string")


def test_many_texts_share_a_passage_of_many_items(spark):
    """One passage in every item and every text, with other words around it."""
    passage = " ".join(f"common{i}" for i in range(12))
    items = [(i, f"left{i} {passage} right{i}") for i in range(60)]
    docs = [(i, f"some{i} words {passage} and{i} more") for i in range(200)]
    rows = contamination_report(spark.createDataFrame(docs, "doc_id long, text string"), bench(spark, items)).collect()
    assert len(rows) == 200
    for r in rows:
        assert tuple(r)[1:] == contamination(docs[r["doc_id"]][1], items)
