"""Best-fit packing of tokenised documents into sequences of bounded length.

Bins have three capacities: tokens, documents and attention cost (the sum of squared
lengths). Pieces go to bins from long to short. Among the open bins with room under
every constraint the one with the smallest weighted residual norm after the piece is
taken (or, by choice, the largest weighted dot product of piece and residual); a new
bin is opened only if none has room. A capacity weighs as much as the whole input
fills it.

The choice depends on lengths alone, and there are no more lengths than tokens in a
sequence. So the plan is made from the histogram of lengths: bins with the same
history are one entry with a count, and all pieces of a length are placed in runs.
The plan's size depends on the capacity, not on the number of documents. It says, for
ranges of ranks among the pieces of a length, which sequences and offsets they get;
Spark ranks the pieces in small groups and looks them up.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import over_batches, written
from .tokens import CACHED_SEGMENTS, END, Encoder, give_back, shared_description

# Text encoded at a time; the other stages of a pipeline need the memory, too.
TEXT_BYTES = 4 << 20
CAPACITY = 2048
ROWS_PER_RANK_GROUP = 10_000
MOST_RANK_GROUPS = 256


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold; by default the last two follow from the first."""

    tokens: int = CAPACITY
    documents: int | None = None
    attention: int | None = None

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], dtype=np.float64)


@dataclass
class Run:
    """Pieces ``first`` to ``first + each * bins - 1`` of one length, ``each`` per bin, from ``offset`` on."""

    length: int
    first: int
    each: int
    offset: int

    def part(self, skip: int) -> Run:
        return Run(self.length, self.first + skip * self.each, self.each, self.offset)


def needs(length: int) -> np.ndarray:
    return np.array([length, 1, length * length], dtype=np.float64)


class Plan:
    """Bins by kind: how many there are, what room each has left, and what it holds."""

    def __init__(self, histogram: dict[int, int], limits: Limits, rule: str = "norm"):
        if rule not in ("norm", "dot"):
            raise ValueError("the rule is 'norm' or 'dot'")
        self.capacity, self.rule = limits.vector(), rule
        load = sum((needs(n) * c for n, c in histogram.items()), np.zeros(3)) / self.capacity
        self.weights = load / load.sum() if load.sum() else np.ones(3) / 3
        self.counts: list[int] = []
        self.runs: list[list[Run]] = []
        self.room = np.zeros((1024, 3))
        for length in sorted(histogram, reverse=True):
            if histogram[length] > 0:
                self._place(length, int(histogram[length]))

    def _add(self, count: int, room: np.ndarray, runs: list[Run]) -> None:
        if len(self.counts) == len(self.room):
            self.room = np.concatenate([self.room, np.zeros_like(self.room)])
        self.room[len(self.counts)] = room
        self.counts.append(count)
        self.runs.append(runs)

    def _best(self, need: np.ndarray) -> int | None:
        """The open kind with room that scores best."""
        room = self.room[: len(self.counts)]
        fits = np.flatnonzero((room >= need).all(axis=1))
        if not len(fits):
            return None
        left = room[fits] / self.capacity
        if self.rule == "norm":
            score = -(self.weights * (left - need / self.capacity) ** 2).sum(axis=1)
        else:
            score = (self.weights * left * (need / self.capacity)).sum(axis=1)
        return int(fits[np.argmax(score)])

    def _place(self, length: int, pieces: int) -> None:
        need, first = needs(length), 0
        if (need > self.capacity).any():
            raise ValueError(f"a piece of {length} tokens exceeds a sequence's limits")
        while pieces:
            kind = self._best(need)
            if kind is None:
                # As many whole new bins as the pieces fill, then one for the rest.
                each = int(min((self.capacity // need).min(), pieces))
                bins = pieces // each
                self._add(bins, self.capacity - each * need, [Run(length, first, each, 0)])
                first, pieces = first + bins * each, pieces - bins * each
                continue
            room = self.room[kind].copy()
            each = int(min((room // need).min(), max(pieces // self.counts[kind], 1)))
            bins = min(self.counts[kind], pieces // each)
            if bins < self.counts[kind]:
                self._add(self.counts[kind] - bins, room, [r.part(bins) for r in self.runs[kind]])
            self.counts[kind] = bins
            self.runs[kind].append(Run(length, first, each, int(self.capacity[0] - room[0])))
            self.room[kind] = room - each * need
            first, pieces = first + bins * each, pieces - bins * each

    @property
    def sequences(self) -> int:
        return sum(self.counts)

    def rules(self) -> list[tuple[int, int, int, int, int, int]]:
        """(length, first rank, end rank, pieces per bin, first sequence, offset)."""
        out, base = [], 0
        for count, runs in zip(self.counts, self.runs):
            out += [(r.length, r.first, r.first + r.each * count, r.each, base, r.offset) for r in runs]
            base += count
        return out


def cuts(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of a document's pieces: all of a full sequence but the first, which holds what is left over."""
    ends = range((total - 1) % capacity + 1, total + 1, capacity)
    return list(zip([0, *ends[:-1]], ends))


def _cut(shared, capacity: int, with_ids: bool, cached: int):
    """Texts to pieces: (key, piece, start, length, checksum[, ids])."""

    def run(batches):
        encoder = Encoder(shared.value, cached)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            docs = [ids + END for ids in encoder(batch.column(1))]
            row, piece, start, length, sums, ids = [], [], [], [], [], []
            for i, doc in enumerate(docs):
                for p, (at, end) in enumerate(cuts(len(doc) // 4, capacity)):
                    part = doc[4 * at : 4 * end]
                    row.append(i)
                    piece.append(p)
                    start.append(at)
                    length.append(end - at)
                    sums.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(sums, pa.int64())]
            names = ["key", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
                names.append("ids")
            return pa.RecordBatch.from_arrays(columns, names=names)

        yield from over_batches(work, TEXT_BYTES)(batches)
        encoder.forget()
        give_back()

    return run


def token_pieces(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False, cached: int = CACHED_SEGMENTS) -> DataFrame:
    """``key, piece, start, length, ids_crc32`` (and ``ids``, little-endian 32-bit) of every document.

    A document is its ids and the end id. Only longer ones than the capacity are
    cut, into pieces of the capacity; the first piece may be shorter.
    """
    slim = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = slim.schema["key"].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return slim.mapInArrow(_cut(shared_description(docs.sparkSession, vocabulary), capacity, with_ids, cached), schema)


def place(pieces: DataFrame, limits: Limits | None = None, rule: str = "norm", order: tuple[str, ...] = ("key", "piece")) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; pieces need a ``length`` and should be a stored table.

    Ranks among the pieces of a length are given in groups by a hash of ``order``,
    whose counts say where each begins: at most (lengths x 256) rows, sent to all
    tasks like the plan's rules. A length that a third of the pieces have is ranked
    in as many tasks as the groups it is dealt to.
    """
    limits = limits or Limits()
    spark = pieces.sparkSession
    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rules = Plan(histogram, limits, rule).rules()
    salts = min(MOST_RANK_GROUPS, sum(histogram.values()) // ROWS_PER_RANK_GROUP + 1)
    dealt = pieces.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    counts = dealt.groupBy("length", "__salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "__salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    rank = F.row_number().over(Window.partitionBy("length", "__salt").orderBy(*order)) - 1
    ranked = dealt.withColumn("__rank", rank).join(F.broadcast(firsts), ["length", "__salt"]).withColumn("__rank", F.col("__rank") + F.col("__first"))
    columns = pa.table(list(zip(*rules)) or [[]] * 6, schema=pa.schema([(n, pa.int64()) for n in ("__len", "__lo", "__hi", "__each", "__base", "__off")]))
    table = F.broadcast(spark.createDataFrame(columns))
    inside = (F.col("length") == F.col("__len")) & (F.col("__rank") >= F.col("__lo")) & (F.col("__rank") < F.col("__hi"))
    turn = F.col("__rank") - F.col("__lo")
    return (
        ranked.join(table, inside)
        .withColumn("sequence_id", (F.col("__base") + F.floor(turn / F.col("__each"))).cast("long"))
        .withColumn("offset", (F.col("__off") + (turn % F.col("__each")) * F.col("length")).cast("long"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def pack(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", limits: Limits | None = None, rule: str = "norm", with_ids: bool = False, cached: int = CACHED_SEGMENTS) -> DataFrame:
    """Every piece of every document with its place: key, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is an empty one: the end id alone. Null keys and repeated rows are
    rows like any other; each gets a place. An empty table gives no rows. Further
    columns are ignored, whatever their names. Documents are tokenised once; the
    pieces are written to the shared folder and only they are shuffled. ``cached``
    segments are remembered by a task: memory against time, never the result.
    """
    limits = limits or Limits()
    pieces = written(token_pieces(docs, vocabulary, key, text, limits.tokens, with_ids, cached))
    placed = place(pieces, limits, rule, ("key", "piece", "ids_crc32"))
    return placed.withColumnRenamed("key", key)


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, ids, lengths`` from placed pieces with ids: at most one capacity each."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    grouped = placed.groupBy("sequence_id").agg(inside.alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return grouped.select("sequence_id", joined.alias("ids"), F.transform("p", lambda x: x["length"]).alias("lengths"))
