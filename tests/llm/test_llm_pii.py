import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from plain import AWKWARD, base_row, base_spans, table
from pyspark.sql import functions as F

from vectrine.llm.pii import CONTEXT_CHARS, KINDS, find_pii, luhn, mod_97, pii_report, redact

COUNTS = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256"]


def test_query_matches_plain_patterns(run, docs):
    rows = run("op1_pii")
    assert len(rows) == len(docs)
    for r in rows:
        assert [r[c] for c in COUNTS] == base_row(docs[r["doc_id"]])


def test_awkward_rows(spark):
    rows = pii_report(table(spark)).collect()
    assert sorted(([r["doc_id"] or 0, *[r[c] for c in COUNTS]] for r in rows), key=str) == sorted(([k or 0, *base_row(t)] for k, t in AWKWARD), key=str)
    assert pii_report(table(spark, [])).collect() == []


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet=st.sampled_from("aZ09.@-+ ()é😀_%4111\n"), max_size=60), min_size=1, max_size=40))
def test_any_text(spark, texts):
    rows = pii_report(table(spark, list(enumerate(texts)), extra=False)).collect()
    assert {r["doc_id"]: [r[c] for c in COUNTS] for r in rows} == {i: base_row(t) for i, t in enumerate(texts)}


def test_spans_hold_base_and_method(spark):
    (row,) = pii_report(table(spark, [AWKWARD[10]])).collect()
    spans = row["spans"].split(",")
    text = AWKWARD[10][1]
    kinds = [(s.split(":")[0], text[int(s.split(":")[1]) : int(s.split(":")[2])]) for s in spans]
    assert ("iban", "DE89 3704 0044 0532 0130 00") in kinds
    assert not any(t == "DE89370400440532013001" for _, t in kinds)  # fails mod-97
    assert [k for k, _ in kinds].count("ssn") == 2
    assert set(base_spans(text)) <= set(spans)


def test_context_decides_weak_spans(spark):
    rows = pii_report(table(spark, [(1, "part 078-05-1120"), (2, "her SSN is 078-05-1120"), (3, "ssn 000-12-3456")])).orderBy("doc_id").collect()
    assert [bool(r["spans"]) for r in rows] == [False, True, False]
    assert rows[1]["top_score"] == pytest.approx(0.8)


def test_checksums(spark):
    row = spark.range(1).select(luhn(F.lit("4111111111111111")).alias("a"), luhn(F.lit("4111111111111112")).alias("b"), mod_97(F.lit("GB82 WEST 1234 5698 7654 32")).alias("c"), mod_97(F.lit("GB82WEST12345698765433")).alias("d")).first()
    assert tuple(row) == (True, False, True, False)


def test_redaction_masks_all_spans(spark):
    df = table(spark, extra=False)
    by_key = {r["doc_id"]: r["text"] for r in redact(df).collect()}
    assert by_key[8] == "Grüße an mü<EMAIL>, Tel <PHONE> 😀 10.0.0.256 <IP>"
    assert by_key[3] is None and by_key[4] == "" and by_key[1] == AWKWARD[0][1]
    assert by_key[10] == "IBAN <IBAN> and DE89370400440532013001, ssn <SSN>, <SSN>"
    assert redact(df).columns == df.columns


def test_overlapping_spans_are_masked_once(spark):
    ((_, text),) = redact(table(spark, [(1, "call +4111111111111111 now")], extra=False)).collect()
    assert re.fullmatch(r"call <(PHONE|CARD)> now", text) or "4111" not in text


def test_name_clash_is_refused(spark):
    with pytest.raises(ValueError):
        find_pii(table(spark))


def test_no_python_in_the_plan(spark):
    plan = pii_report(table(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


MANY = "Kontakt: " + " ".join(f"müller{i}@mail.example.org +49 30 {1000000 + i} 10.0.{i % 300}.1" + " call me" * (i % 9) for i in range(1_500))


def test_many_spans_in_one_text(spark):
    """Spans and their contexts over many chunks are those of the plain search."""
    df = table(spark, [(1, MANY)], extra=False)
    (row,) = pii_report(df).collect()
    assert [row[c] for c in COUNTS] == base_row(MANY)
    (spans,) = find_pii(df).select("pii").first()
    words = {kind.name: kind for kind in KINDS}
    for s in spans:
        near = re.search(words[s["kind"]].context, MANY[max(s["start"] - CONTEXT_CHARS, 0) : s["start"]].lower())
        assert s["score"] == pytest.approx(words[s["kind"]].score + (words[s["kind"]].lift if near else 0))
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [MANY[at : s["start"]], f"<{s['kind'].upper()}>"]
        at = max(at, s["end"])
    assert redact(df).first()["text"] == "".join(out) + MANY[at:]


def test_columns_of_helpers_names_stay(spark):
    df = table(spark, AWKWARD[:10], extra=False).selectExpr("*", "'mine' as __pii_email", "'mine' as __pii_spans")
    for found in (find_pii(df).drop("pii"), redact(df)):
        assert found.columns == df.columns
        assert {(r["__pii_email"], r["__pii_spans"]) for r in found.collect()} == {("mine", "mine")}
