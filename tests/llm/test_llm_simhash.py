import random

import numpy as np
import pytest
from plain import AWKWARD, groups, simhash, table

from vectrine.llm.components import components
from vectrine.llm.simhash import bucket_links, keep_one, links, majority, near_duplicates, part_masks, planes_of, shingle_hashes, within


def expected(rows, radius=2):
    prints = [simhash(t) for _, t in rows]
    root = groups(prints, radius)
    out = []
    for i, (k, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        out.append((k, f"{prints[i]:016x}", min(keys) if keys else None))
    return sorted(out, key=str)


def test_query_matches_all_pairs(run, docs):
    assert sorted(map(tuple, run("op3_simhash_dedup")), key=str) == expected(sorted(docs.items()))


def test_awkward_rows(spark):
    assert sorted(map(tuple, near_duplicates(table(spark)).collect()), key=str) == expected(AWKWARD)
    assert near_duplicates(table(spark, [])).collect() == []


def test_texts_without_words_link(spark):
    rows = {r["doc_id"]: r for r in near_duplicates(table(spark)).collect()}
    assert {rows[k]["fingerprint"] for k in (3, 4, 5)} == {"0" * 16}
    assert {rows[k]["component_id"] for k in (3, 4, 5)} == {3}


@pytest.mark.parametrize("size", [1, 3, 5])
def test_fingerprint(size):
    for _, text in AWKWARD:
        if text is None or len(text) < 5000:
            assert majority(shingle_hashes(text, size)) == simhash(text, size)


def near_prints(seed, centres, each, flips):
    rng = random.Random(seed)
    found = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(each):
            found.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))))
    return sorted(found)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_distances(radius):
    prints = near_prints(radius, 6, 40, 6)
    all_ = np.array(prints, dtype=np.uint64)
    bits = list(range(64))
    planes = planes_of(all_, bits)
    member = ((all_[None, :] >> np.array(bits, dtype=np.uint64)[:, None]) & np.uint64(1)).astype(bool)
    marks = np.unpackbits(within(planes, member[:, :70], radius).view(np.uint8), axis=1, bitorder="little")[:, : len(prints)]
    assert marks.tolist() == [[int((a ^ b).bit_count() <= radius) for b in prints] for a in prints[:70]]


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_bucket_groups(radius):
    prints = near_prints(7 + radius, 5, 60, 4)
    root = groups(prints, radius)
    want = {(prints[i], prints[r]) for i, r in enumerate(root) if i != r}
    assert set(bucket_links(np.array(prints, dtype=np.uint64), radius)) == want


@pytest.mark.parametrize("radius, bucket, most", [(0, 2048, 1 << 16), (1, 2048, 1 << 16), (2, 2048, 1 << 16), (2, 16, 1 << 16), (2, 64, 40), (1, 2048, 30)])
def test_links_and_components_lose_nothing(spark, radius, bucket, most):
    prints = near_prints(20 + radius, 30, 40, 4)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = {r["node"]: r["root"] for r in components(links(spark.createDataFrame([(p,) for p in signed], "fp long"), radius, bucket, most)).collect()}
    sets = {}
    for p, r in zip(signed, groups(prints, radius)):
        sets.setdefault(r, set()).add(p)
    ours = {}
    for p in signed:
        ours.setdefault(found.get(p, p), set()).add(p)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, sets.values()))


def test_tables_cover_every_pair():
    rng = random.Random(0)
    for fixed in (0, 0xFFFF, part_masks(2)[1]):
        free = [i for i in range(64) if not fixed >> i & 1]
        for width in (3, 64):
            masks = part_masks(2, fixed, width)
            assert len(masks) == 3 and all(m & fixed == fixed and m != fixed for m in masks)
            for _ in range(300):
                diff = sum(1 << b for b in rng.sample(free, 2))
                assert any(diff & m == 0 for m in masks)


def test_few_wide_buckets_are_compared_in_blocks_that_are_given_up(monkeypatch):
    from vectrine.llm import simhash as module

    looks = []
    real = module._exceeds
    monkeypatch.setattr(module, "_exceeds", lambda count, limit: looks.append(1) or real(count, limit))
    rng = random.Random(3)
    prints = np.array(sorted({rng.getrandbits(64) for _ in range(12_000)}), dtype=np.uint64)
    assert bucket_links(prints, 2) == []
    passes = -(-len(prints) // module.QUERIES_PER_PASS)
    blocks = sum(-(-(-(-len(prints) // 64) - 2 * i) // module.WORDS_PER_BLOCK) for i in range(passes))
    assert len(looks) < 0.8 * blocks * 64 / module.PLANES_PER_LOOK  # far blocks end before their last plane


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100)]
    hub = [(1000, 2000 + i) for i in range(300)] + [(None, 3), (5, 5), (7, 6)]
    rows = components(spark.createDataFrame(chain + hub, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in rows} == {**{i: 0 for i in range(1, 101)}, **{2000 + i: 1000 for i in range(300)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_group_stays(spark):
    df = table(spark)
    kept = keep_one(df)
    keys = sorted(r["doc_id"] or 0 for r in kept.collect())
    roots = {k for k, _, c in expected(AWKWARD) if k is not None and k == c}
    assert keys == sorted([*roots, 0])  # the row without a key stays as well
    assert kept.columns == df.columns


def test_columns_of_helpers_names_stay(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (3, "e f g h i"), (None, "a b c d")]
    df = table(spark, rows, extra=False).selectExpr("*", "'mine' as __key", "'mine' as __name")
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["__key"], r["__name"]) for r in kept.collect()) == [(0, "mine", "mine"), (1, "mine", "mine"), (3, "mine", "mine")]
