"""Contiguous shards of the smallest possible capacity, groups of equal texts kept together.

Rows with equal texts form an atomic group. Groups are ordered by the SHA-256 of
their text, which spreads any input evenly over the order. The capacity of a shard
is the least for which a greedy walk over the ordered groups needs no more than
the given number of shards; a binary search finds it, and the order is cut there.

The walk never sees the groups themselves. It runs on sums over ranges of digests
(the first 65,536 ranges are given by two bytes) and bounds every cut from below
and above. Ranges that may hold a cut are divided by one more byte until both
bounds give the same capacity, so the driver holds a few thousand numbers however
many rows there are, and the capacity is exact.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, written

LAW = "bytes"
FIRST_BYTES = 2
ROWS_PER_RANK_GROUP = 20_000
MOST_RANK_GROUPS = 4096


class Ranges:
    """Sums over consecutive ranges of the digest order, each named by a digest prefix."""

    def __init__(self, rows: list[tuple[bytes, int, int]]):
        self.rows = sorted(rows)
        self.ends = list(accumulate(size for _, size, _ in self.rows))
        self.total = self.ends[-1] if self.ends else 0

    def low(self, position: int) -> int:
        """The last known group boundary at or before a position."""
        i = bisect_right(self.ends, position)
        return self.ends[i - 1] if i else 0

    def high(self, position: int) -> int:
        """The last place at or before a position where a boundary may be."""
        if position >= self.total:
            return self.total
        i = bisect_right(self.ends, position)
        return self.low(position) if self.rows[i][2] == 1 else position

    def cuts(self, capacity: int, shards: int, pessimist: bool) -> list[int]:
        """Greedy ends of the shards: a lower or an upper bound of each."""
        at, found = 0, []
        for _ in range(shards):
            at = (self.low if pessimist else self.high)(at + capacity)
            found.append(at)
        return found

    def least(self, shards: int, floor: int, pessimist: bool) -> int:
        """The smallest capacity whose greedy walk reaches the end."""
        lo, hi = floor, max(floor, self.total)
        while lo < hi:
            mid = (lo + hi) // 2
            if self.cuts(mid, shards, pessimist)[-1] >= self.total:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def open_ranges(self, shards: int, lo: int, hi: int) -> list[bytes]:
        """Ranges of several groups in which a cut may lie for a capacity from lo to hi."""
        found = set()
        for a, b in zip(self.cuts(lo, shards, True), self.cuts(hi, shards, False)):
            for i in range(bisect_right(self.ends, a), min(bisect_left(self.ends, b) + 1, len(self.ends))):
                if self.rows[i][2] > 1:
                    found.add(self.rows[i][0])
        return sorted(found)


def _sums(groups: DataFrame, bytes_used: int) -> list[tuple[bytes, int, int]]:
    prefix = F.substring("digest", 1, bytes_used)
    rows = groups.groupBy(prefix.alias("p")).agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()
    return [(bytes(r["p"]), int(r["s"]), int(r["n"])) for r in rows]


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[bytes]]:
    """The smallest capacity, and the digests at which the shards after the first begin.

    ``groups``: one row per atomic group, ``digest`` (binary) and ``size``.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    largest = groups.agg(F.max("size")).first()[0]
    if largest is None:
        return 0, []
    used = FIRST_BYTES
    ranges = Ranges(_sums(groups, used))
    while True:
        floor = max(int(largest), -(-ranges.total // shards))
        hi = ranges.least(shards, floor, pessimist=True)
        lo = ranges.least(shards, floor, pessimist=False)
        if lo == hi:
            break
        parents = ranges.open_ranges(shards, lo, hi)
        held = {len(p) for p in parents}
        used = min(held) + 1
        parents = [p for p in parents if len(p) == used - 1]
        finer = _sums(groups.filter(F.substring("digest", 1, used - 1).isin([bytearray(p) for p in parents])), used)
        gone = set(parents)
        ranges = Ranges([r for r in ranges.rows if r[0] not in gone] + finer)
    starts = {0: None} | {end: ranges.rows[i + 1][0] for i, end in enumerate(ranges.ends[:-1])}
    ends = dict.fromkeys(ranges.cuts(hi, shards, pessimist=True))
    return hi, [starts[end] for end in ends if 0 < end < ranges.total]


def text_digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 text; a null text counts as an empty one."""
    return F.unhex(F.sha2(text_or_empty(text), 256))


def shard_of(digest: Column, cuts: list[bytes]) -> Column:
    """The number of cuts at or before the digest: no join, no shuffle."""
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (digest >= F.lit(bytearray(cut))).cast("int")
    return shard


def assign_shards(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 16) -> DataFrame:
    """One row per row of ``docs``: key, size, text_crc32, law, shard, slot, grown_shard.

    A row's size is its UTF-8 bytes plus one. The text is read once, to write
    (key, size, checksum, digest); only those are shuffled. Slots count from 0
    within a shard without a gap: rows are ranked inside groups of (shard, hash of
    the key), whose counts give each group its first slot, so neither a large
    shard nor a large group of copies is ranked in one task.

    A null text is an empty text (size 1, checksum 0). Null keys and repeated rows
    are rows like any other, and each gets a slot of its own. A group larger than
    an even share makes its shard larger; others stay as even as they can be.
    With fewer groups than shards some shards stay empty; an empty table gives no
    rows. Further columns of ``docs`` are ignored, whatever their names.
    """
    body = text_or_empty(F.col(f"`{text}`"))
    slim = written(
        docs.select(
            F.col(f"`{key}`").alias("key"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body).alias("crc"),
            text_digest(body).alias("digest"),
        )
    )
    groups = slim.groupBy("digest").agg(F.sum("size").alias("size"))
    _, cuts = minimax_cuts(written(groups), shards)
    rows = slim.count()
    salts = min(MOST_RANK_GROUPS, rows // (ROWS_PER_RANK_GROUP * shards) + 1)
    placed = slim.select(
        "*",
        shard_of(F.col("digest"), cuts).alias("shard"),
        F.pmod(F.xxhash64("key", "digest"), F.lit(salts)).cast("int").alias("salt"),
    )
    counts = placed.groupBy("shard", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    # At most shards x MOST_RANK_GROUPS rows, whatever the input.
    first = counts.select("shard", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("shard", "salt").orderBy("key", "digest")) - 1
    return (
        placed.withColumn("rank", rank)
        .join(F.broadcast(first), ["shard", "salt"])
        .select(
            F.col("key").alias(key),
            "size",
            F.col("crc").alias("text_crc32"),
            F.lit(LAW).alias("law"),
            "shard",
            (F.col("first") + F.col("rank")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def write_shards(docs: DataFrame, folder: str, text: str = "text", shards: int = 16) -> int:
    """Write whole rows below ``folder/shard=N``; returns the capacity in bytes."""
    digest = text_digest(F.col(f"`{text}`"))
    size = F.octet_length(text_or_empty(F.col(f"`{text}`"))) + 1
    groups = written(docs.groupBy(digest.alias("digest")).agg(F.sum(size.cast("long")).alias("size")))
    capacity, cuts = minimax_cuts(groups, shards)
    if "shard" in docs.columns:
        raise ValueError("the rows have a column named shard already")
    docs.withColumn("shard", shard_of(digest, cuts)).hint("rebalance", "shard").write.mode("errorifexists").partitionBy("shard").parquet(folder)
    return capacity
