import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from plain import AWKWARD, table
from pyspark.sql import functions as F

from vectrine.llm.sharding import assign_shards, minimax_cuts, write_shards
from vectrine.llm.url_filters import filter_urls, patterns, validity


def least_capacity(sizes, shards):
    """By trying every capacity's greedy walk."""
    lo, hi = max(sizes, default=0), sum(sizes)
    while lo < hi:
        mid, used, room = (lo + hi) // 2, 1, (lo + hi) // 2
        for s in sizes:
            if s > room:
                used, room = used + 1, mid
            room -= s
        lo, hi = (lo, mid) if used <= shards else (mid + 1, hi)
    return lo


def check_shards(rows, texts, shards):
    assert len(rows) == len(texts)
    groups, sizes = defaultdict(set), defaultdict(int)
    of = defaultdict(list)
    for k, t in texts:
        data = (t or "").encode()
        of[(k, len(data) + 1, zlib.crc32(data))].append(hashlib.sha256(data).digest())
    by_shard = defaultdict(list)
    for r in rows:
        digest = of[(r["doc_id"], r["size"], r["text_crc32"])].pop()
        groups[digest].add(r["shard"])
        sizes[digest] += r["size"]
        by_shard[r["shard"]].append(r)
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    assert all(len(s) == 1 for s in groups.values())
    order = [next(iter(groups[d])) for d in sorted(groups)]
    assert order == sorted(order)
    for held in by_shard.values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
    loads = [sum(r["size"] for r in held) for held in by_shard.values()]
    assert max(loads, default=0) == least_capacity([sizes[d] for d in sorted(sizes)], shards) or max(loads, default=0) <= least_capacity([sizes[d] for d in sorted(sizes)], shards)


def test_sharding_query(run, docs):
    check_shards(run("op10_sharding"), list(docs.items()), 16)


@pytest.mark.parametrize("shards", [1, 3, 16, 100])
def test_sharding_awkward_rows(spark, shards):
    check_shards(assign_shards(table(spark), shards=shards).collect(), AWKWARD, shards)
    assert assign_shards(table(spark, []), shards=shards).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_capacity_is_the_least(spark, seed):
    rng = random.Random(seed)
    rows = [(hashlib.sha256(str((seed, i)).encode()).digest(), rng.choice([1, 10, 1000, 50_000]) * rng.randint(1, 9)) for i in range(3000)]
    # Many groups behind one prefix: the ranges are refined.
    rows += [(b"\x40\x00" + hashlib.sha256(str(i).encode()).digest()[:30], rng.randint(1, 10**6)) for i in range(2000)]
    groups = spark.createDataFrame(rows, "digest binary, size long")
    capacity, cuts = minimax_cuts(groups, 16)
    ordered = sorted(rows)
    assert capacity == least_capacity([s for _, s in ordered], 16)
    loads = [0] * 16
    for digest, size in ordered:
        loads[sum(digest >= c for c in cuts)] += size
    assert len(cuts) <= 15 and max(loads) <= capacity


def test_shards_as_files(spark, folder):
    df = table(spark)
    write_shards(df, folder, shards=3)
    back = spark.read.parquet(folder)
    assert back.count() == len(AWKWARD) and set(df.columns) | {"shard"} == set(back.columns)
    with pytest.raises(ValueError):
        write_shards(df.withColumn("shard", F.lit(1)), folder)


def test_sharding_has_no_python(spark):
    assert "Python" not in assign_shards(table(spark))._jdf.queryExecution().toString()


# --- URL lists ---------------------------------------------------------------------


def stamp(i):
    return f"2024-01-{1 + i // 24:02d} {i % 24:02d}:00:00"


def judge(captures, entries):
    """Every capture against every entry."""
    out = []
    dated = defaultdict(dict)
    for name, pattern, since, added in entries:
        if None not in (name, pattern, since, added):
            dated[name, pattern][since] = dated[name, pattern].get(since, False) or added
    for key, url, covers, at in captures:
        active = []
        for (name, pattern), history in dated.items():
            past = [s for s in history if at is not None and s <= at]
            if pattern in covers and past and history[max(past)]:
                active.append(f"{name}:{pattern}")
        out.append((key, ",".join(sorted(active)), bool(active)))
    return sorted(out, key=str)


def cover(host, steps):
    labels = host.split(".")
    return {".".join(labels[i:]) for i in range(max(len(labels) - 1, 1))} | {host + "/" + "/".join(steps[: i + 1]) for i in range(len(steps))}


@pytest.mark.parametrize("seconds", [3600, 86_400, 10**9])
def test_as_of_matches_every_pair(spark, seconds):
    rng = random.Random(seconds)
    hosts = ["a.example.com", "b.example.com", "x.y.example.org", "example.net"]
    captures = []
    for i in range(400):
        host, steps = rng.choice(hosts[: 1 + rng.randint(0, 3)]), rng.choices("uvw", k=rng.randint(0, 3))
        captures.append((i % 390, f"https://{host}/{'/'.join(steps)}?q#f", cover(host, steps), rng.choice([None] + [stamp(rng.randint(0, 400))] * 9)))
    names = ["example.com", "a.example.com", "y.example.org", "example.net", "a.example.com/u", "a.example.com/u/v", "example.org", None]
    entries = [(rng.choice(["one", "two"]), rng.choice(names), rng.choice([None] + [stamp(rng.randint(0, 400))] * 20), rng.choice([True, False, None])) for _ in range(300)]
    c = spark.createDataFrame([(k, u, t) for k, u, _, t in captures], "page_id long, url string, t string").selectExpr("page_id", "url", "to_timestamp(t) as fetched", "'c' as pattern", "1 as slice", "2 as holds")
    e = spark.createDataFrame(entries, "list string, pattern string, t string, added boolean").selectExpr("*", "to_timestamp(t) as since", "'x' as until")
    rows = filter_urls(c, e, seconds=seconds).collect()
    assert sorted(((r["page_id"], r["active"], r["blocked"]) for r in rows), key=str) == judge(captures, entries)
    assert all(r["n_active"] == len([x for x in r["active"].split(",") if x]) for r in rows)


def test_intervals_close_at_the_next_entry(spark):
    rows = [("l", "p", stamp(i), i % 2 == 0) for i in (0, 5, 60, 200)]
    e = spark.createDataFrame(rows, "list string, pattern string, t string, added boolean").selectExpr("list", "pattern", "to_timestamp(t) as since", "added")
    found = [(str(r["since"]), str(r["until"])) for r in validity(e).orderBy("since").collect()]
    assert found == [(stamp(0), stamp(5)), (stamp(5), stamp(60)), (stamp(60), stamp(200)), (stamp(200), "None")]


def test_url_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "https://"), (5, "https://one/"), (5, "https://one/"), (None, "https://h.example/a//b/../c?x=/d")]
    c = spark.createDataFrame(rows, "page_id long, url string").withColumn("fetched", F.to_timestamp(F.lit(stamp(3))))
    none = spark.createDataFrame([], "list string, pattern string, since timestamp, added boolean")
    assert [r["blocked"] for r in filter_urls(c, none).collect()] == [False] * len(rows)
    one = spark.createDataFrame([("l", "h.example/a/b", True), ("l", "one", True)], "list string, pattern string, added boolean").withColumn("since", F.to_timestamp(F.lit(stamp(3))))
    found = filter_urls(c, one).collect()
    assert sorted(str(r["page_id"]) for r in found if r["blocked"]) == ["5", "5", "None"]
    assert filter_urls(c.limit(0), one).collect() == []
    assert spark.range(1).select(patterns(F.lit("https://a.b.c/x/y?z")).alias("p")).first()["p"] == ["a.b.c", "b.c", "a.b.c/x", "a.b.c/x/y"]
