import sys
from pathlib import Path

import pytest
from plain import AWKWARD, base_spans, contamination, groups, simhash

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """The rows after each stage."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {"documents": None}
    out["documents"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = docs.collect()
    return out


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]


def test_stages_keep_the_columns(kept):
    for name in ("quality", "near_duplicates", "decontamination", "personal_data"):
        assert kept[name] and list(kept[name][0].asDict()) == corpus_pipeline.COLUMNS


def test_quality_keeps_good_documents(kept, spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    good = [k for k in texts(kept["documents"]) if labels.get(k) == 1]
    assert len([k for k in good if k in texts(kept["quality"])]) >= 0.95 * len(good)
    assert len(kept["quality"]) < len(kept["documents"])


def test_one_of_each_group_stays(kept):
    rows = sorted(texts(kept["quality"]).items())
    roots = {rows[r][0] for r in groups([simhash(t) for _, t in rows], 2)}
    assert set(texts(kept["near_duplicates"])) == roots


def test_contaminated_documents_go(kept, spark):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    want = {k for k, t in texts(kept["near_duplicates"]).items() if not contamination(t, items)[-1]}
    assert set(texts(kept["decontamination"])) == want


def test_personal_data_is_masked(kept):
    before, after = texts(kept["decontamination"]), texts(kept["personal_data"])
    assert before.keys() == after.keys()
    assert any(base_spans(t) for t in before.values())
    for k, t in before.items():
        assert base_spans(after[k]) == [] and (after[k] == t or base_spans(t))
    assert all(r["n_chars"] == len(r["text"]) for r in kept["personal_data"])


def test_everything_is_packed(kept):
    assert {r["doc_id"] for r in kept["packing"]} == set(texts(kept["personal_data"]))


def test_run_gives_the_last_stage(spark, kept):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    light = lambda all_: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in all_)
    assert light(rows) == light(kept["packing"])


def test_awkward_rows_pass_all_stages(spark, tmp_path_factory):
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in AWKWARD], "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path_factory.mktemp(name) / "rows")
            stage(spark, docs, FOLDER).write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.columns[:2] == ["doc_id", "piece"]
