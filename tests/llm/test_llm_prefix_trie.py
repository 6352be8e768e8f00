import hashlib
import zlib
from collections import defaultdict

import pytest
from plain import WORDS

from vectrine.llm import prefix_trie
from vectrine.llm.prefix_trie import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, words string, a string, conv string"


def plain_trie(rows):
    """Rows of the result, from every prefix of every conversation; rows of (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        full = turns.get(c - c % 20, [])[:h] + ts[h:]
        for d in range(len(full) + 1):
            members[tuple(full[:d])].append(c)
        ends[tuple(full)].append(c)
    children, below = defaultdict(int), defaultdict(lambda: [0, 0])
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        saved = (len(convs) - 1) * len(WORDS.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            below[node[:d]][0] += saved
            below[node[:d]][1] += not children[node]
    return sorted(
        (
            min(convs),
            len(node),
            min(members[node[:-1]]) if node else -1,
            len(convs),
            children[node],
            below[node][1],
            below[node][0],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, convs in members.items()
    )


def result(rows):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(-1 if n == "parent_conv_id" and r[n] is None else r[n] for n in names) for r in rows)


def check(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA)
    assert result(trie(df).collect()) == plain_trie(rows)


def test_every_conversation_like_the_plain_version(run, table):
    rows = [tuple(r) for r in table("conversations").select("conv_id", "turn", "role", "text").collect()]
    assert result(run("op13_prefix_trie")) == plain_trie(rows)


def talk(c, *texts, first=0):
    return [(c, first + i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]


CASES = {
    "empty": [],
    "one turn": talk(3, "hello there"),
    "no own turns left": talk(20, "a b", "c d", "e") + sum((talk(c, "x") for c in range(21, 40)), []),
    "no base": sum((talk(c, "x y", "z", "w", "v u") for c in range(41, 60)), []),
    "nulls": [(1, None, None, None), (1, 0, "user", None), (1, 1, None, "a b"), (None, 0, "user", "lost"), (2, None, "user", "a"), (2, 5, "", ""), (0, None, "x", "y")],
    "repeats and ties": talk(5, "a", "b") * 2 + talk(6, "a", "b") * 2 + [(7, 1, "r", "same"), (7, 1, "r", "same"), (7, 0, "r", "same")],
    "prefixes of each other": sum((talk(c, *[f"t{i} and more" for i in range(c % 9)]) for c in range(1, 80)), []),
    "copies": sum((talk(c, "same first", "same second", "same third", "same fourth", "same fifth") for c in range(200)), []),
    "white space": talk(60, "a b c\n\td", " ", "\n", "x" * 10_000) + talk(61, "", "", "", ""),
    "bases only": sum((talk(c, "a", f"b{c % 3}", "c", "d") for c in (0, 20, 40)), []),
}


@pytest.mark.parametrize("name", CASES)
def test_awkward_rows(spark, name):
    check(spark, CASES[name])


def test_long_conversations_pass_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    long = [f"turn {i % 7}" for i in range(200)]
    rows = talk(3, *long) + talk(4, *long[:150]) + talk(5, *long, first=1000) + talk(8, *long[:90], "other", *long[90:]) + talk(0, "p", "q", "r", "s")
    check(spark, rows)


def test_end_lists_of_many_ids(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 64)
    members = spark.range(5000).selectExpr("id % 3 AS conv", "id * 7 - 1000 AS member")
    got = {r["conv"]: r["ends"] for r in prefix_trie.end_lists(members).collect()}
    for c in range(3):
        ids = ",".join(str(i * 7 - 1000) for i in range(5000) if i % 3 == c)
        assert got[c] == hashlib.sha256(ids.encode()).hexdigest()
