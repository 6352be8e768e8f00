import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from plain import AWKWARD, LONG, WORDS, table

from vectrine.llm.substrings import later_spans, paths, remove_repeats, repeat_report, sources
from vectrine.llm.words import Words


def plain_report(rows, window=13):
    """(key, n_words, n_removed, kept) of each (key, text), by looking at every window."""
    first = {}
    texts = [(k, WORDS.findall(t or "")) for k, t in rows]
    for k, words in texts:
        for i in range(len(words) - window + 1 if k is not None else 0):
            gram = tuple(words[i : i + window])
            first[gram] = min(first.get(gram, k), k)
    out = []
    for k, words in texts:
        gone = set()
        for i in range(len(words) - window + 1 if k is not None else 0):
            if first[tuple(words[i : i + window])] < k:
                gone |= set(range(i, i + window))
        out.append((k, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def digests(rows):
    return sorted(((k, n, r, hashlib.sha256(t.encode()).hexdigest()) for k, n, r, t in rows), key=repr)


def check(spark, rows, window=13):
    got = repeat_report(table(spark, rows), window=window).collect()
    assert sorted((tuple(r) for r in got), key=repr) == digests(plain_report(rows, window))


def test_every_document_like_the_plain_version(run, docs):
    assert sorted((tuple(r) for r in run("op11_substring_dedup")), key=repr) == digests(plain_report(list(docs.items())))


PASSAGE = " ".join(f"p{i}" for i in range(60))


@pytest.mark.parametrize(
    "rows",
    [
        AWKWARD,
        [(9, LONG), (8, f"before {LONG} after"), (7, LONG[:5000])],
        # a passage inside others, at the ends, twice in one text, cut short, and with a change in its middle
        [(5, f"a b {PASSAGE} c"), (4, PASSAGE), (3, f"{PASSAGE} x {PASSAGE}"), (6, PASSAGE.replace("p30", "q")), (2, PASSAGE[: PASSAGE.index(" p40")]), (1, "p50 p51 p52 p53 p54 p55 p56 p57 p58 p59 x")],
        # periods: paths that meet themselves
        [(1, "a b " * 40), (2, "b a " * 30), (3, "a " * 50), (4, "a " * 12), (5, "a " * 13), (6, "a b c " * 20 + "a " * 20)],
        # one key twice; the window exactly; one word less
        [(1, PASSAGE), (1, PASSAGE), (2, " ".join(PASSAGE.split()[:13])), (3, " ".join(PASSAGE.split()[:12])), (None, PASSAGE), (None, PASSAGE)],
        [(2, " ".join(PASSAGE.split()[5:18])), (1, "\n\t".join(PASSAGE.split()[:18])), (3, f"ü {PASSAGE} 😀")],
        [],
    ],
)
def test_awkward_rows(spark, rows):
    check(spark, rows)


def test_random_texts_over_few_words(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), " ".join(rng.choice(["x", "y"], rng.integers(0, 120)))) for k in rng.integers(0, 60, 80)]
    check(spark, rows, 5)
    check(spark, rows, 8)


def test_copies_are_one_path_each(spark):
    """Compaction: a copied text is one path, not one row a window."""
    words = [f"w{i}" for i in range(500)]
    rows = paths(table(spark, [(k, " ".join(words)) for k in range(20)] + [(30, " ".join(words[:250] + ["new"] + words[250:]))]))
    assert max(len(r["units"]) for r in rows.collect()) <= 4
    found = sources(rows).collect()
    assert len(found) <= 4 and {(r["first"], r["last"]) for r in found} <= {(0, 30), (0, 19)}
    spans = {r["key"]: r["spans"] for r in later_spans(rows).collect()}
    assert 0 not in spans and sorted(spans) == [*range(1, 20), 30]
    covered = {i for s in spans[30] for i in range(s["start"], s["start"] + s["length"])}
    assert covered == set(range(501)) - {250}


def test_removal_keeps_columns_and_other_texts(spark):
    rows = [(2, f"lead {PASSAGE} tail"), (1, PASSAGE), (3, "  spaced\n text "), (None, PASSAGE), (4, None)]
    got = remove_repeats(table(spark, rows))
    assert got.columns == table(spark, rows).columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {2: "lead tail", 1: PASSAGE, 3: "  spaced\n text ", None: PASSAGE, 4: None}
    assert {r["size"] for r in got.collect()} == {"clash"}


def test_words_of_a_slice_and_their_hashes():
    texts = pa.array(["skip", None, "a  b\u00a0c\n", "", "b\u00a0c a", "x" * 1000 + " " + "x" * 1000 + "y"]).slice(1)
    words = Words.of(texts)
    assert [words.joined(a, b - 1).decode() for a, b in zip(words.first[:-1], words.first[1:])] == ["", "a b\u00a0c", "", "b\u00a0c a", texts[4].as_py()]
    h = words.hashes()  # a no-break space is part of a word
    assert h[0] == h[3] and h[1] == h[2] and len(set(h.tolist())) == 4
