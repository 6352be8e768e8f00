"""Removal of passages that an earlier document has, by a compacted De Bruijn graph.

Every window of ``window`` words is an edge from its first words to its last, all but
one each (the nodes). Two texts that share a long passage share a path.

1. Minimizers: a window's smallest k-gram hash. A window that two documents have has a
   minimizer that two documents have, so only windows with such a one become edges. A
   document sends its distinct minimizers, a quarter of its windows.
2. Nodes: every occurrence of a node between two edges sends what stands before and
   behind it. A node with one such context in all documents does not branch; the end
   of a text or of its edges is a context, too.
3. Compaction: edges that meet in nodes that do not branch are one path. A document
   that has any edge of a path has all of it, so each document cuts its own edges
   into whole paths, and windows become few rows.
4. Coordinates: paths are named by SHA-256 over their words as they stand in the text,
   not by the hashes above, and joined with their first source. A path that a smaller
   key has is removed, at its coordinates.

Texts are read in place. Only texts that lose words are shuffled. Minimizers and
branching nodes are first known by a bitmap of bounded size: a wrong yes makes an edge
or a cut more, the same in every document, and changes no result; beyond the bitmap's
room all windows are edges of their own.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Bitmap, bitmap, bitmap_bits, over_batches, written
from .decontaminate import text_name
from .words import Words, grams

WINDOW = 13
BEFORE, BEHIND = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
UNIT = "struct<path:binary,start:int,length:int>"


def gram_size(window: int) -> int:
    return (window + 1) // 2


def minimizers(words: np.ndarray, row: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each window the smallest hash of its k-grams, and whether it lies in one text."""
    k = gram_size(window)
    small, _ = grams(words, k, row)
    count = max(len(words) - window + 1, 0)
    least = reduce(np.minimum, [small[i : i + count] for i in range(window - k + 1)])
    return least, row[:count] == row[window - 1 :] if count else np.zeros(0, dtype=bool)


def _slim(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = F.col(f"`{text}`").cast("string")
    return docs.select(F.col(f"`{key}`").alias("key"), text_name(body).alias("copy"), body.alias("text"))


def _minimizer_rows(window: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words.of(batch.column("text"))
        least, whole = minimizers(words.hashes(), words.row, window)
        row = words.row[: len(least)]
        new = whole.copy()
        new[1:] &= (least[1:] != least[:-1]) | (row[1:] != row[:-1])
        keys = batch.column("key").take(pa.array(row[new]))
        return pa.RecordBatch.from_arrays([keys, pa.array(least[new].view(np.int64))], names=["key", "h"])

    return over_batches(work)


class Edges:
    """The edges of a batch: which windows are, and the nodes on their two sides."""

    def __init__(self, texts: pa.Array, window: int, repeated: Bitmap):
        self.words = Words.of(texts)
        self.hashes, self.row = self.words.hashes(), self.words.row
        least, whole = minimizers(self.hashes, self.row, window)
        self.edge = whole & repeated(least) if len(least) else whole
        self.at = np.flatnonzero(self.edge)
        # node i: the words that windows i - 1 and i share
        self.node = grams(self.hashes, window - 1, self.row)[0]
        # joined[i]: windows i - 1 and i are edges of one text
        self.joined = np.zeros(len(self.edge) + 1, dtype=bool)
        if len(self.edge) > 1:
            self.joined[1:-1] = self.edge[1:] & self.edge[:-1] & (self.row[1 : len(self.edge)] == self.row[: len(self.edge) - 1])


def _context_rows(window: int, shared):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        e = Edges(batch.column("text"), window, shared.value)
        whole, around = grams(e.hashes, window, e.row)[0], grams(e.hashes, window + 1, e.row)[0]
        inner = np.flatnonzero(e.joined)
        begins, ends = e.at[~e.joined[e.at]], e.at[~e.joined[e.at + 1]]
        nodes = np.concatenate([e.node[inner], e.node[begins], e.node[ends + 1]])
        contexts = np.concatenate([around[inner - 1], whole[begins] ^ BEHIND, whole[ends] ^ BEFORE])
        return pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), pa.array(contexts.view(np.int64))], names=["node", "context"])

    return over_batches(work)


def _path_rows(window: int, shared):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        repeated, branching = shared.value
        e = Edges(batch.column("text"), window, repeated)
        words = e.words
        begins = e.at[~(e.joined[e.at] & ~branching(e.node[e.at]))] if len(e.at) else e.at
        # a path goes on to the edge before the next path's first, or to the last edge of its run
        last = np.append(e.at[np.searchsorted(e.at, begins)[1:] - 1], e.at[-1:]) if len(begins) else begins
        paths = [hashlib.sha256(words.joined(a, b + window - 1)).digest() for a, b in zip(begins.tolist(), last.tolist())]
        row = words.row[begins]
        units = pa.StructArray.from_arrays(
            [pa.array(paths, pa.binary()), pa.array(begins - words.first[row], pa.int32()), pa.array(last - begins + window, pa.int32())],
            names=["path", "start", "length"],
        )
        ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
        whole = [hashlib.sha256(words.joined(a, b - 1)).hexdigest() for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist())]
        return pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("copy"), pa.array(np.diff(words.first), pa.int64()), pa.array(whole), pa.ListArray.from_arrays(pa.array(ends), units)],
            names=["key", "copy", "n_words", "sha256", "units"],
        )

    return over_batches(work)


def _bitmap_of(hashes: DataFrame, column: str) -> Bitmap:
    hashes = written(hashes)
    return bitmap(hashes, column, bitmap_bits(hashes.count()))


def paths(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: key, copy (names the text), n_words, sha256 (of its words), units.

    ``units`` are the compacted paths of the graph in the text: ``path`` (digest of
    the words), ``start`` and ``length`` in words. They cover every window that two
    documents have, and perhaps some that one has. Written to the shared folder.
    """
    slim = _slim(docs, key, text)
    kind, sc = slim.schema["key"].dataType.simpleString(), docs.sparkSession.sparkContext
    found = slim.select("key", "text").filter("key is not null").mapInArrow(_minimizer_rows(window), f"key {kind}, h long")
    shared = found.groupBy("h").agg(F.min("key").alias("a"), F.max("key").alias("b")).filter("a < b").select("h")
    repeated = _bitmap_of(shared, "h")
    contexts = slim.select("text").mapInArrow(_context_rows(window, sc.broadcast(repeated)), "node long, context long")
    branching = contexts.groupBy("node").agg(F.min("context").alias("a"), F.max("context").alias("b")).filter("a != b").select("node")
    known = sc.broadcast((repeated, _bitmap_of(branching, "node")))
    schema = f"key {kind}, copy binary, n_words long, sha256 string, units array<{UNIT}>"
    return written(slim.mapInArrow(_path_rows(window, known), schema))


def _units(rows: DataFrame) -> DataFrame:
    return rows.filter("key is not null and size(units) > 0").select("key", "copy", F.explode("units").alias("u")).select("key", "copy", "u.*")


def sources(rows: DataFrame) -> DataFrame:
    """``path, first, last``: the smallest and largest key of each path that several documents have, from ``paths``."""
    return _units(rows).groupBy("path").agg(F.min("key").alias("first"), F.max("key").alias("last")).filter("first < last")


def later_spans(rows: DataFrame) -> DataFrame:
    """``key, copy, spans``: where a text repeats a document with a smaller key, from ``paths``.

    ``spans`` are sorted (start, length) in words; they may overlap.
    """
    later = _units(rows).join(sources(rows).select("path", "first"), "path").filter("key > first")
    return later.groupBy("key", "copy").agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"))


def _kept(batch: pa.RecordBatch) -> pa.RecordBatch:
    kept, removed = [], []
    for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
        words, out, at, gone = (text or "").encode("utf-8", "replace").split(), [], 0, 0
        for s in spans:
            end = s["start"] + s["length"]
            out += words[at : s["start"]]
            gone += max(end - max(at, s["start"]), 0)
            at = max(at, end)
        kept.append(b" ".join(out + words[at:]).decode("utf-8", "replace"))
        removed.append(gone)
    return pa.RecordBatch.from_arrays([batch.column("key"), batch.column("copy"), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["key", "copy", "n_removed", "kept"])


def _may_lose(spans: DataFrame, key: Column, copy: Column) -> Column:
    """False for rows that no span names; those need not be shuffled."""
    shared = spans.sparkSession.sparkContext.broadcast(_bitmap_of(spans.select(F.xxhash64("key", "copy").alias("h")), "h"))

    @F.arrow_udf("boolean")
    def named(hashes: pa.Array) -> pa.Array:
        return pa.array(shared.value(hashes.to_numpy(zero_copy_only=False).view(np.uint64)))

    return key.isNotNull() & named(F.xxhash64(key, copy))


def _shortened(docs: DataFrame, key: str, text: str, spans: DataFrame) -> DataFrame:
    """``key, copy, n_removed, kept`` of the rows that lose words."""
    slim = _slim(docs, key, text)
    kind = slim.schema["key"].dataType.simpleString()
    hit = slim.filter(_may_lose(spans, F.col("key"), F.col("copy"))).join(spans, ["key", "copy"])
    short = hit.select("key", "copy", "text", "spans").mapInArrow(over_batches(_kept), f"key {kind}, copy binary, n_removed long, kept string")
    return short.dropDuplicates(["key", "copy"])


def repeat_report(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_removed, kept_sha256.

    A word goes if it lies in a window of ``window`` words that also starts in a
    document with a smaller key; all windows are judged on the input. Null and empty
    texts have no words, and shorter texts no window. Rows with one key are one
    document: they remove nothing of each other. A row without a key loses nothing
    and removes nothing. Ties and repeated rows each keep their row; an empty table
    gives no rows; further columns are ignored, whatever their names.
    """
    rows = paths(docs, key, text, window)
    spans = written(later_spans(rows))
    short = _shortened(docs, key, text, spans).select("key", "copy", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    return rows.join(short, ["key", "copy"], "left").select(
        F.col("key").alias(key), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256")
    )


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated words gone from ``text``; kept words are joined by one space.

    Texts that lose nothing, null ones too, stay as they are. See ``repeat_report``.
    """
    spans = written(later_spans(paths(docs, key, text, window)))
    short = written(_shortened(docs, key, text, spans).select(F.col("key").alias("__key"), F.col("copy").alias("__copy"), F.col("kept").alias("__kept")))
    name, copy = F.col(f"`{key}`"), text_name(F.col(f"`{text}`"))
    loses = F.coalesce(_may_lose(spans, name, copy), F.lit(False))
    body = F.coalesce("__kept", F.col(f"`{text}`").cast("string")).alias(text)
    changed = docs.filter(loses).join(short, (name == F.col("__key")) & (copy == F.col("__copy")), "left")
    return docs.filter(~loses).unionByName(changed.select(*[body if c == text else F.col(f"`{c}`") for c in docs.columns]))
