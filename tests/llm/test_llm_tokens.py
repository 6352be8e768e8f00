import json
from collections import defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import AWKWARD, crc, table
from tokenizers import Tokenizer

from vectrine.llm.packing import Limits, Plan, pack, place, sequences
from vectrine.llm.rans import CHECKPOINT_STEPS, LANES, TOTAL, Block, Corrupt, Decoder, Frequencies, encode
from vectrine.llm.token_files import read_token_files, write_token_files
from vectrine.llm.tokens import Encoder, cuts, cuttable, description_of

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return Encoder(description_of(PATH))


def ids_of(data):
    return np.frombuffer(data, dtype="<u4").tolist()


@cache
def both():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t, Encoder(description_of(PATH))


PARTS = [*" \n\t\r\x0b\x0c\x1c\x85\xa0\u3000", "a", "B", "é", "中", "1", ".", "'s", "\0", "don't", "  ", "<|endoftext|>"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30).map("".join))
def test_segments_give_the_same_ids(text):
    t, ours = both()
    assert ids_of(ours([text])[0]) == t.encode(text, add_special_tokens=False).ids


def test_documents_give_the_same_ids(docs, encoder, whole):
    texts = list(docs.values()) + [t for _, t in AWKWARD]
    assert [ids_of(b) for b in encoder(texts)] == [whole(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*PARTS, "×", "÷.", "ж!", "ǂ,", "\u02b0.", "\u2003", "\u180e"]), max_size=8).map("".join), max_size=6))
def test_arrow_texts_are_cut_where_ids_do_not_change(texts):
    t, ours = both()
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    given = pa.array([None, *texts, ""])
    assert [ids_of(b) for b in ours(given.slice(1))] == [*want, []] and ours(given)[0] == b""
    ends = np.cumsum([len(x.encode()) for x in texts], dtype=np.int64)
    data = "".join(texts).encode()
    if data:
        starts = np.unique(np.concatenate([[0], ends[:-1]]))
        at = cuts(np.frombuffer(data, dtype=np.uint8), starts[starts < len(data)]).tolist()
        alone = [t.encode(data[a:b].decode(), add_special_tokens=False).ids for a, b in zip(at, [*at[1:], len(data)])]
        assert sum(alone, []) == sum(want, [])


def test_segments_are_divided_at_newlines_and_punctuation():
    data = "the end.\nThe été, don't  go: A×. (b)".encode()
    at = cuts(np.frombuffer(data, dtype=np.uint8), np.array([0])).tolist()
    found = [data[a:b].decode() for a, b in zip(at, [*at[1:], len(data)])]
    assert found == ["the", " end", ".", "\n", "The", " été", ",", " don", "'t ", " go", ":", " A×.", " (b", ")"]


def test_other_vocabularies_encode_whole_texts():
    assert cuttable(description_of(PATH))
    other = description_of(str(public_tokenizers.path("word_bpe_49k.json")))
    assert not cuttable(other)
    t = Tokenizer.from_str(other)
    assert ids_of(Encoder(other)(["Two  words"])[0]) == t.encode("Two  words", add_special_tokens=False).ids
    assert not cuttable(json.dumps({"pre_tokenizer": {"type": "Whitespace"}}))


# --- packing -----------------------------------------------------------------------


def check_packing(rows, texts, whole, capacity=2048):
    """``texts``: (key, text); rows may hold several documents of one key."""
    docs = defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
    want = defaultdict(list)
    for k, t in texts:
        want[k].append([*whole(t), 0])
    assert docs.keys() == want.keys()
    for k, all_ids in want.items():
        pieces = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in docs[k])
        expected = []
        for ids in all_ids:
            # as many whole sequences from the end as there are; what stands before them is the first piece
            parts = []
            while len(ids) > capacity:
                ids, part = ids[:-capacity], ids[-capacity:]
                parts.insert(0, part)
            parts.insert(0, ids)
            expected += [(i, sum(map(len, parts[:i])), len(p), crc(p)) for i, p in enumerate(parts)]
        assert pieces == sorted(expected)
        assert all(r["length"] == capacity for r in docs[k] if r["piece"] > 0)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_query(run, docs, whole):
    rows = run("op7_best_fit_packing")
    used = check_packing(rows, docs.items(), whole)
    assert used <= 1.01 * sum(r["length"] for r in rows) / 2048 + 1


def test_packing_awkward_rows(spark, whole):
    check_packing(pack(table(spark), PATH).collect(), AWKWARD, whole)
    check_packing(pack(table(spark), PATH, limits=Limits(16)).collect(), AWKWARD, whole, 16)
    assert pack(table(spark, []), PATH).collect() == []


def test_sequences_hold_the_ids(spark, whole):
    placed = pack(table(spark), PATH, limits=Limits(64), with_ids=True)
    rows = sequences(placed).collect()
    assert all(len(r["ids"]) == 4 * sum(r["lengths"]) <= 4 * 64 for r in rows)
    assert sum(len(r["ids"]) for r in rows) == 4 * sum(len(whole(t)) + 1 for _, t in AWKWARD)


def best_fit(lengths, limits):
    """One piece at a time, by the same rule: the number of bins."""
    cap, bins = limits.vector(), []
    for n in sorted(lengths, reverse=True):
        need = np.array([n, 1, n * n], dtype=float)
        fits = [b for b in bins if (b >= need).all()]
        if fits:
            best = min(fits, key=lambda b: b[0])
            best -= need
        else:
            bins.append(cap - need)
    return len(bins)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=200), st.sampled_from(["norm", "dot"]), st.sampled_from([Limits(32), Limits(32, 4), Limits(32, None, 300), Limits(32, 3, 1024)]))
def test_plan_keeps_every_limit(lengths, rule, limits):
    lengths = [n for n in lengths if n * n <= limits.vector()[2]]
    histogram = defaultdict(int)
    for n in lengths:
        histogram[n] += 1
    plan = Plan(dict(histogram), limits, rule)
    bins = defaultdict(list)
    for n, lo, hi, each, base, offset in plan.rules():
        for rank in range(lo, hi):
            bins[base + (rank - lo) // each].append((offset + (rank - lo) % each * n, n))
    assert sum(map(len, bins.values())) == len(lengths) and len(bins) == plan.sequences
    cap = limits.vector()
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= cap[0] and len(held) <= cap[1] and sum(n * n for _, n in held) <= cap[2]
    if limits == Limits(32):
        assert plan.sequences <= best_fit(lengths, limits) + 1
    for n, count in histogram.items():
        runs = sorted((lo, hi) for m, lo, hi, *_ in plan.rules() if m == n)
        assert runs[0][0] == 0 and runs[-1][1] == count and all(a[1] == b[0] for a, b in zip(runs, runs[1:]))


def test_plan_does_not_grow_with_the_documents():
    small, large = ({n: 3 * scale for n in range(1, 2049, 7)} for scale in (10, 10_000_000))
    assert len(Plan(large, Limits()).rules()) < 4 * len(Plan(small, Limits()).rules())


def test_piece_beyond_the_limits():
    with pytest.raises(ValueError):
        Plan({10: 1}, Limits(8))
    with pytest.raises(ValueError):
        Plan({1: 1}, Limits(8), "first")


def test_place_keeps_other_columns(spark):
    rows = spark.createDataFrame([(i, i % 5 + 1, "x") for i in range(100)], "key long, length long, note string")
    placed = place(rows, Limits(8), order=("key",)).collect()
    assert len(placed) == 100 and {r["note"] for r in placed} == {"x"}


# --- coded files -------------------------------------------------------------------


def coded(ids):
    ids = np.array(ids, dtype="<u4")
    table_ = Frequencies.of(ids)
    return Frequencies.read(table_.bytes()), [Block.read(b.bytes()) for b in encode(ids, table_)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**32 - 1)), max_size=400))
def test_round_trip(ids):
    table_, blocks = coded(ids)
    assert [i for b in Decoder(table_)(blocks) for i in b.tolist()] == ids


def test_round_trip_of_many_blocks():
    rng = np.random.default_rng(0)
    ids = np.minimum(rng.zipf(1.2, 200_000), 50_000)
    table_, blocks = coded(ids)
    assert len(blocks) > 2 and table_.shares.sum() == TOTAL and table_.shares.min() >= 1
    decoder = Decoder(table_)
    found = decoder(blocks)
    assert (np.concatenate(found) == ids).all()
    for block, all_ids in zip(blocks, found):
        assert (decoder([block])[0] == all_ids).all()  # alone
        for p in range(len(block.places)):
            part = decoder.from_checkpoint(block, p)
            at = p * CHECKPOINT_STEPS * LANES
            assert len(part) and (part == all_ids[at : at + len(part)]).all()
    p = table_.shares / TOTAL
    bits = 8 * sum(len(b.bytes()) for b in blocks) / len(ids)
    assert bits < 1.12 * -(p * np.log2(p)).sum()


def test_damage_is_found():
    table_, blocks = coded(list(range(2000)) * 10)
    data = bytearray(blocks[0].bytes())
    for place_ in (0, 12, 200, len(data) - 1):
        bad = bytearray(data)
        bad[place_] ^= 1
        with pytest.raises(Corrupt):
            Decoder(table_)([Block.read(bytes(bad))])
    with pytest.raises(Corrupt):
        Block.read(bytes(data[:10]))


def expected_files(rows, whole):
    out, at = [], 0
    for k, t in rows:
        ids = [*whole(t), 0]
        out.append((k, at, len(ids), crc(ids)))
        at += len(ids)
    return out


def test_files_query(run, docs, whole):
    assert sorted(map(tuple, run("op8_token_files"))) == expected_files(sorted(docs.items()), whole)


@pytest.mark.parametrize("files", [None, 1, 7])
def test_files_awkward_rows(spark, folder, whole, files):
    write_token_files(table(spark), folder, PATH, files=files)
    rows = read_token_files(spark, folder, with_ids=True).orderBy("start").collect()
    ordered = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [tuple(r)[:4] for r in rows] == expected_files(ordered, whole)
    assert [ids_of(r["ids"]) for r in rows] == [[*whole(t), 0] for _, t in ordered]


def test_files_of_an_empty_table(spark, folder):
    write_token_files(table(spark, []), folder, PATH)
    assert read_token_files(spark, folder).collect() == []
