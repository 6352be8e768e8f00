"""The prefix trie of conversations, by collapsing whole sequences first.

1. Turns get their place in the conversation, and every prefix a name: its length and
   two 64-bit sums (exclusive or) over hashes of (place, role, text). A prefix is never
   held as a list, so a conversation may have any number of turns.
2. Identical conversations become one weighted sequence, known by its smallest id, with
   the digest of the list of its ids.
3. Sequences that are proper prefixes of others go by an anti-join; the rest are leaves.
4. Only the weighted sequences are expanded to their prefixes, which are aggregated to
   the nodes. All sums are such that a sequence adds to each of its prefixes by itself:
   what a subtree saves is the sum over its sequences of the words below the prefix,
   times the weight, less the words of the nodes below that are the sequence's own. A
   node is its smallest member's own, so these nodes are the end of one path.

Running counts and sums are formed in blocks of ``BLOCK`` places and over the blocks'
totals, so that a conversation with a third of all turns is spread over tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BLOCK = 4096
SHARED_EVERY, MOST_SHARED = 20, 4
WORD = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "a", "b"]


def _running(rows: DataFrame, group: str, block: Column, order: list[Column], sums: dict[str, tuple[str, Column]]) -> DataFrame:
    """``rows`` with running aggregates by ``group`` in the given order.

    ``sums``: name to (aggregate function, expression). ``block`` is no null and rises
    with the order. Within a block by a window; over the blocks by a window of their
    totals.
    """
    blocks = rows.withColumn("__block", block)
    totals = blocks.groupBy(group, "__block").agg(*[_aggregate(f, e).alias(n) for n, (f, e) in sums.items()])
    earlier = Window.partitionBy(group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(group, "__block", *[F.coalesce(_aggregate(f, F.col(n)).over(earlier), F.lit(0)).alias(f"__{n}") for n, (f, _) in sums.items()])
    inside = Window.partitionBy(group, "__block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = blocks.withColumns({n: _aggregate(f, e).over(inside) for n, (f, e) in sums.items()}).join(before, [group, "__block"])
    both = {n: F.col(f"__{n}").bitwiseXOR(F.col(n)) if f == "bit_xor" else F.col(f"__{n}") + F.col(n) for n, (f, _) in sums.items()}
    return joined.withColumns(both).drop("__block", *[f"__{n}" for n in sums])


def _aggregate(name: str, column: Column) -> Column:
    return {"bit_xor": F.bit_xor, "sum": F.sum}[name](column)


def _ordered_turns(talks: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, place, role, text, words``: own turns, places from 1; rows without a conversation are left out."""
    body = {n: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for n, c in (("role", role), ("text", text))}
    slim = talks.select(F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), body["role"].alias("role"), body["text"].alias("text"))
    slim = slim.filter("conv is not null").withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.md5(F.concat("role", F.lit("\x00"), "text")), "role")})
    slim = slim.withColumn("words", F.regexp_count("text", F.lit(WORD)).cast("long")).drop("role", "text")
    # null turns first; turns of one number by their content
    order = [F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2")]
    block = F.floor(F.col("turn") / BLOCK)
    return _running(slim, "conv", F.coalesce(block, F.lit(-(1 << 60))), order, {"place": ("sum", F.lit(1))}).drop("turn")


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes over."""
    return F.pmod(F.crc32(conv.cast("string")), F.lit(MOST_SHARED))


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv, depth, h1, h2, words`` of every rebuilt conversation; one without turns has a row of depth 0 only.

    Each has a row of depth 0 (nulls else): a third of all turns may be one
    conversation's, but at most ``MOST_SHARED`` - 1 of its turns go to others.
    """
    takes = shared_turns(F.col("conv"))
    heads = written(turns.filter(F.col("place") < MOST_SHARED))
    convs = heads.filter("place = 1").select("conv", takes.alias("takes"), (F.col("conv") - F.col("conv") % SHARED_EVERY).alias("base"))
    base = heads.select(F.col("conv").alias("base"), F.col("place").alias("depth"), "h1", "h2", "words")
    lead = convs.join(base, "base").filter("depth <= takes").select("conv", "depth", "h1", "h2", "words")
    size = lead.groupBy("conv").agg(F.count("*").alias("lead"))
    own = turns.filter(F.col("place") > takes).join(size, "conv", "left")
    own = own.select("conv", (F.col("place") - takes + F.coalesce("lead", F.lit(0))).cast("long").alias("depth"), "h1", "h2", "words")
    root = convs.select("conv", F.lit(0).cast("long").alias("depth"), *[F.lit(None).cast("long").alias(c) for c in ("h1", "h2")], F.lit(0).cast("long").alias("words"))
    return root.unionByName(lead.select("conv", F.col("depth").cast("long").alias("depth"), "h1", "h2", "words")).unionByName(own)


def _prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` with the prefix's name (depth, a, b), that of the prefix before, and the words up to here."""
    a = F.when(F.col("depth") > 0, F.xxhash64("depth", "h1", "h2")).otherwise(F.lit(0))
    b = F.when(F.col("depth") > 0, F.xxhash64("h2", "depth", "h1", F.lit(7))).otherwise(F.lit(0))
    named = turns.select("conv", "depth", "words", a.cast("long").alias("x"), b.cast("long").alias("y"))
    sums = {"a": ("bit_xor", F.col("x")), "b": ("bit_xor", F.col("y")), "upto": ("sum", F.col("words"))}
    out = _running(named, "conv", F.floor(F.col("depth") / BLOCK), [F.col("depth")], sums)
    return out.withColumns({"pa": F.col("a").bitwiseXOR(F.col("x")), "pb": F.col("b").bitwiseXOR(F.col("y"))}).drop("x", "y")


def _digest_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of lists, sorted by list and piece, to one digest a list; holds one batch and one hash state."""
    now, state = None, hashlib.sha256()

    def row(key, state):
        return pa.RecordBatch.from_pylist([dict(zip(("conv", "ends"), (key, state.hexdigest())))], schema=pa.schema([("conv", pa.int64()), ("ends", pa.string())]))

    for batch in batches:
        for key, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key == now:
                state.update(b",")
            else:
                if now is not None:
                    yield row(now, state)
                now, state = key, hashlib.sha256()
            state.update(piece.encode())
    if now is not None:
        yield row(now, state)


def end_lists(members: DataFrame) -> DataFrame:
    """``conv, ends``: SHA-256 of each sequence's member ids, ascending and comma-joined.

    ``members``: (conv, member). Ids are first joined in ranges of ``BLOCK`` ids; the
    digest itself takes a list from end to end, so its pieces pass one task as a stream.
    """
    near = members.withColumn("piece", F.floor(F.col("member") / BLOCK))
    ids = F.array_join(F.transform(F.array_sort(F.collect_set("member")), lambda m: m.cast("string")), ",")
    pieces = near.groupBy("conv", "piece").agg(ids.alias("ids"))
    return pieces.repartition("conv").sortWithinPartitions("conv", "piece").select("conv", "ids").mapInArrow(_digest_lists, "conv long, ends string")


def trie(talks: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are rebuilt: the first h own turns of conversation c are replaced by
    the first h turns of conversation c - c % 20, h = crc32(c) % 4. Null roles and
    texts are empty ones; a null turn comes first; turns of one number are ordered by
    content, and a repeated row is one more turn. Rows without a conversation id are
    left out. An empty table has no nodes, not even a root. Further columns are
    ignored, whatever their names.
    """
    turns = written(_ordered_turns(talks, conv, turn, role, text))
    steps = written(_prefixes(rebuilt(turns)))

    # whole sequences: the last prefix of each conversation names it
    last = steps.groupBy("conv").agg(F.max_by(F.struct(*NODE, "upto"), "depth").alias("z")).select("conv", "z.*")
    ends = written(last.groupBy(*NODE, "upto").agg(F.min("conv").alias("first"), F.count("*").alias("weight")))
    members = last.join(ends.select(*NODE, "first"), NODE).select(F.col("first").alias("conv"), F.col("conv").alias("member"))
    digests = end_lists(members)

    # the prefixes of one conversation per sequence, with the sequence's weight and length
    whole = ends.select(F.col("first").alias("conv"), "weight", F.col("upto").alias("total"), F.col("depth").alias("length"))
    path = written(steps.join(whole, "conv"))
    proper = path.filter("depth < length").select(*NODE).distinct()
    leaves = ends.join(proper, NODE, "left_anti").select(F.col("first").alias("conv"), F.lit(1).alias("leaf"))

    nodes = written(path.groupBy(*NODE).agg(F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"), F.min("pa").alias("pa"), F.min("pb").alias("pb")))
    own = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.min("depth").alias("own"))
    # words of the sequence's own nodes at this depth and below
    facts = path.join(own, "conv").filter("depth = own").select("conv", "own", (F.col("upto") - F.col("words")).alias("outside"))
    seen = path.join(facts, "conv", "left").join(leaves, "conv", "left")
    own_words = F.when(F.col("own").isNull(), 0).when(F.col("depth") >= F.col("own"), F.col("total") - F.col("upto") + F.col("words")).otherwise(F.col("total") - F.col("outside"))
    saved = F.col("weight") * (F.col("total") - F.col("upto") + F.col("words")) - own_words
    sums = seen.groupBy(*NODE).agg(F.sum(saved).cast("long").alias("saved_tokens"), F.sum(F.coalesce("leaf", F.lit(0))).cast("long").alias("n_leaves"))

    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    parents = nodes.filter("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    # every node of depth 1 has the root for its parent; there is one root, or no node at all
    root = nodes.filter("depth = 0").first()
    top = F.when(F.col("depth") == 1, F.lit(root["conv_id"] if root else None).cast("long"))
    listed = ends.join(digests, ends["first"] == digests["conv"]).select(*NODE, "ends")
    none = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(sums, NODE)
        .join(children, NODE, "left")
        .join(parents, ["depth", "pa", "pb"], "left")
        .join(listed, NODE, "left")
        .select(
            "conv_id",
            "depth",
            F.coalesce("parent_conv_id", top).alias("parent_conv_id"),
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends", F.lit(none)).alias("ends_sha256"),
        )
    )
