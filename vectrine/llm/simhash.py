"""Near duplicates by SimHash: texts whose 64-bit fingerprints differ in a few bits.

1. A text's fingerprint: the majority of the bits of its shingles' XXH64 hashes.
2. Equal fingerprints are merged first, so a group of exact copies is one row from
   then on, however large it is.
3. Candidates by the pigeonhole principle: the bits are cut into radius + 1 parts, of
   which two fingerprints within the radius agree on one. There is one table per part,
   dealt by as many bits of it as make buckets of about ``BUCKET_MEMBERS``. A bucket of
   more than ``MOST_MEMBERS`` is dealt again by the parts of its other bits, until few
   bits are left; no bucket is capped and no pair is lost.
4. Within a bucket, bit planes are stored vertically (bit i of 64 fingerprints in
   one word) and the distances of many fingerprints to many queries are counted at once
   by carry-save adders; a block of words is given up once all of it exceeds the
   radius. Near ones are tied to the smallest of their group, so a group of m gives
   m - 1 links and pairs are never listed.
5. Links over all buckets are joined to components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import over_batches, spare_name, without, written
from .components import components

BITS = 64
SEED = 42
# Fingerprints of a bucket, about; the most that are compared in one task unless its free bits are few.
BUCKET_MEMBERS = 2048
MOST_MEMBERS = 1 << 16
# Words of 64 fingerprints that are compared before the count looks whether all of them are too far.
WORDS_PER_BLOCK = 32
PLANES_PER_LOOK = 4
QUERIES_PER_PASS = 128
TABLE_ROWS_PER_TASK = 1 << 16
MOST_TASKS = 1 << 15


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of every shingle of the lower-cased words; of the whole sequence if it is shorter."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and \x20, \x09-\x0D only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest, count = xxhash.xxh64_intdigest, len(words) - size + 1
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[:count].tolist(), ends[size - 1 :].tolist())), dtype=np.uint64, count=count)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes; zero for none. Counted in pieces of bounded size."""
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[i : i + (1 << 16)].astype("<u8")).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * counts > len(hashes)))


def _fingerprint_batch(size: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([majority(shingle_hashes(t, size)) for t in batch.column(1).to_pylist()], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["key", "fp"])

    return work


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """``key, fp`` per row; ``fp`` holds the 64 bits as a long."""
    slim = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return slim.mapInArrow(over_batches(_fingerprint_batch(shingle)), f"key {slim.schema['key'].dataType.simpleString()}, fp long")


def planes_of(prints: np.ndarray, bits: list[int]) -> np.ndarray:
    """Bit planes: entry [i, w] holds bit ``bits[i]`` of fingerprints 64 w to 64 w + 63."""
    room = -(-len(prints) // 64) * 64
    planes = np.zeros((len(bits), room), dtype=np.uint8)
    for row, bit in enumerate(bits):
        planes[row, : len(prints)] = (prints >> np.uint64(bit)) & np.uint64(1)
    return np.packbits(planes, axis=1, bitorder="little").view("<u8").reshape(len(bits), -1)


def _exceeds(count: list[np.ndarray], limit: int) -> np.ndarray:
    """Marks of the vertical binary numbers above a limit."""
    above, equal = np.zeros_like(count[0]), ~np.zeros_like(count[0])
    for d in reversed(range(len(count))):
        if limit >> d & 1:
            equal = equal & count[d]
        else:
            above |= equal & count[d]
            equal = equal & ~count[d]
    return above


def within(planes: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """Marks [q, w] of the fingerprints at most ``radius`` bits from each query.

    ``queries``: the queries' bits, one row per plane (0 or 1). The number of
    differing bits so far is kept in binary, one word per digit; ``far`` is set for
    good where it overflows or, at every few planes, has passed the radius.
    """
    digits = max(1, (radius + 1).bit_length())
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.zeros((queries.shape[1], planes.shape[1]), dtype=np.uint64)
    for w in range(0, planes.shape[1], WORDS_PER_BLOCK):
        part = planes[:, w : w + WORDS_PER_BLOCK]
        count = [np.zeros((queries.shape[1], part.shape[1]), dtype=np.uint64) for _ in range(digits)]
        far = np.zeros_like(count[0])
        for i, (plane, bit) in enumerate(zip(part, queries), 1):
            carry = plane[None, :] ^ np.where(bit, full, np.uint64(0))[:, None]
            for d in range(digits):
                count[d], carry = count[d] ^ carry, count[d] & carry
            far |= carry
            if i % PLANES_PER_LOOK == 0 or i == len(part):
                far |= _exceeds(count, radius)
                if (far == full).all():
                    break
        out[:, w : w + WORDS_PER_BLOCK] = ~far
    return out


def bucket_links(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(member, smallest member) for each group of a bucket's distinct, sorted fingerprints."""
    spread = int(np.bitwise_or.reduce(prints ^ prints[0]))
    bits = [i for i in range(BITS) if spread >> i & 1]
    planes = planes_of(prints, bits)
    member = ((prints[None, :] >> np.array(bits, dtype=np.uint64)[:, None]) & np.uint64(1)).astype(bool)
    parent = np.arange(len(prints))
    for start in range(0, len(prints), QUERIES_PER_PASS):
        first = start // 64  # distances are symmetric: earlier words had their turn as queries
        near = within(planes[:, first:], member[:, start : start + QUERIES_PER_PASS], radius)
        for q in np.flatnonzero(np.bitwise_count(near).sum(axis=1) > 1):
            found = first * 64 + np.flatnonzero(np.unpackbits(near[q].view(np.uint8), bitorder="little"))
            found = found[found < len(prints)]  # the last word may hold more places than members
            tops = _tops(parent, found)
            parent[found] = parent[tops] = tops.min()
    root = _tops(parent, np.arange(len(prints)))
    return [(int(prints[i]), int(prints[root[i]])) for i in np.flatnonzero(root != np.arange(len(prints)))]


def _tops(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The smallest known member of each node's group."""
    top = parent[nodes]
    while (top != parent[top]).any():
        top = parent[top]
    return top


def _link_buckets(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            flat, ends = column.values.to_numpy(zero_copy_only=False).view(np.uint64), column.offsets.to_numpy()
            found = set()
            for a, b in zip(ends[:-1], ends[1:]):
                found.update(bucket_links(np.sort(flat[a:b]), radius))
            pairs = np.array(sorted(found), dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return run


def part_masks(radius: int, fixed: int = 0, width: int = BITS) -> list[int]:
    """One mask per part of the bits outside ``fixed``: these and at most ``width`` bits of the part.

    There are radius + 1 parts, so two fingerprints that agree on ``fixed`` and differ
    in at most ``radius`` bits agree on one of the masks.
    """
    if not 0 <= radius < BITS:
        raise ValueError(f"the radius must be from 0 to {BITS - 1}")
    free = [i for i in range(BITS) if not fixed >> i & 1]
    edges = [len(free) * i // (radius + 1) for i in range(radius + 2)]
    return sorted({fixed | sum(1 << i for i in free[a:b][:width]) for a, b in zip(edges, edges[1:])})


def _mask(mask: int) -> Column:
    return F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask).cast("long")


def _dealt(prints: DataFrame, masks: Column, tasks: int) -> DataFrame:
    """``fp, mask, bits``: a row per table, with the bits that name its bucket; written."""
    rows = prints.repartition(tasks, "fp").select("fp", F.explode(masks).alias("mask"))
    return written(rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits")))


def links(prints: DataFrame, radius: int, bucket: int = BUCKET_MEMBERS, most: int = MOST_MEMBERS) -> DataFrame:
    """Links ``a, b`` that tie all distinct fingerprints (column ``fp``) within the radius.

    ``bucket`` and ``most`` (members of a bucket, about and at most) decide the cost
    alone. A bucket above ``most`` (2^(radius + 1) at least) is dealt again; with at
    most log2(``most``) bits free it can hold no more than that many.
    """
    count, most = prints.count(), max(most, 2 << radius)
    masks = part_masks(radius, width=max(0, (count // bucket).bit_length() - 1))
    rows = _dealt(prints, F.array(*[_mask(m) for m in masks]), _tasks(count))
    out = []
    while True:
        total = rows.count()
        # Counted first, with partial sums: no group is collected whose size is not known.
        sizes = written(rows.groupBy("mask", "bits").agg(F.count("*").alias("n")).filter(F.col("n") > most))
        large = sizes.select("mask", "bits") if not sizes.isEmpty() else None
        small = rows if large is None else rows.join(large, ["mask", "bits"], "left_anti")
        buckets = small.repartition(_tasks(total), "mask", "bits").groupBy("mask", "bits").agg(F.collect_list("fp").alias("members"))
        out.append(buckets.filter("size(members) > 1").select("members").mapInArrow(_link_buckets(radius), "a long, b long"))
        if large is None:
            break
        # Fewer bits are free in every round; a bucket that all its bits name has one member.
        deeper = {m: part_masks(radius, m) for m in masks}
        masks = sorted({m for parts in deeper.values() for m in parts})
        children = F.create_map(*[c for m, parts in deeper.items() for c in (_mask(m), F.array(*[_mask(p) for p in parts]))])
        again = rows.join(large, ["mask", "bits"], "left_semi")
        rows = _dealt(again.select("fp", "mask"), children[F.col("mask")], _tasks(total))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def _tasks(rows: int) -> int:
    return min(rows // TABLE_ROWS_PER_TASK + 1, MOST_TASKS)


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per row of ``docs``: key, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest key that can be reached over links, the row's
    own included. Texts without words (null and empty ones too) have fingerprint
    zero and link like any other. Repeated rows each keep their row. A null key
    names no component: a row without a key takes the smallest key of its group,
    or null if nobody there has one. Further columns are ignored, whatever their
    names; an empty table gives no rows.
    """
    prints = written(fingerprints(docs, key, text, shingle))
    classes = written(prints.groupBy("fp").agg(F.min("key").alias("first")))
    linked = components(links(classes.select("fp"), radius))
    # Node is any fingerprint of a group but its root; the root stands for itself.
    groups = linked.select(F.col("node").alias("fp"), "root").unionByName(linked.select(F.col("root").alias("fp"), "root").distinct())
    firsts = classes.join(groups, "fp").groupBy("root").agg(F.min("first").alias("lowest"))
    lowest = groups.join(firsts, "root").select("fp", "lowest")
    named = classes.join(lowest, "fp", "left").select("fp", F.coalesce("lowest", "first").alias("component_id"))
    return prints.join(named, "fp").select(F.col("key").alias(key), hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest key, columns unchanged.

    Rows that repeat a key are taken for one document, of which one row stays. Rows
    without a key cannot be told apart by it and all stay.
    """
    name = F.col(f"`{key}`")
    spare = spare_name(docs, "__key")
    marked = written(near_duplicates(docs, key, text, shingle, radius).select(name.alias(spare), (name != F.col("component_id")).alias("later")))
    kept = without(docs, name, marked.filter("later").select(spare).distinct())
    repeated = written(marked.filter(F.col(spare).isNotNull()).groupBy(spare).count().filter("count > 1").select(spare))
    if repeated.isEmpty():
        return kept
    same = name == F.col(spare)
    return kept.join(repeated, same, "left_anti").unionByName(kept.join(repeated, same, "left_semi").dropDuplicates([key]))
