"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrine.session import shared_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, folder: str | None = None, compression: str = "zstd") -> DataFrame:
    """``df`` written once as Parquet below the shared folder, and read back.

    Cuts the lineage: what follows reads files that every executor sees, so a
    lost executor costs a re-read and never a second run of what came before.
    """
    folder = folder or shared_dir(df.sparkSession)
    df.write.mode("overwrite").option("compression", compression).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def spare_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def over_batches(work: Callable[[pa.RecordBatch], pa.RecordBatch], size: int = 2 << 20) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that turns each batch into one batch, in small slices.

    A slice holds at most ``SLICE_ROWS`` rows and about ``size`` bytes (or one
    row that is larger), so the Python side never holds more than a few copies
    of that much text, however many rows Spark hands over at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, size):
                yield work(part)

    return run


SLICE_ROWS = 4096


def slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in order, cut by rows and bytes."""
    rows = batch.num_rows
    if not rows:
        return
    step = max(1, min(SLICE_ROWS, rows * size // max(batch.nbytes, 1)))
    for start in range(0, rows, step):
        yield batch.slice(start, step)


# Bits of a bitmap: at least 2^16, at most 2^27 (16 MB), else about 64 for each hash.
LEAST_BITS, MOST_BITS, BITS_PER_HASH = 16, 27, 64


class Bitmap:
    """Which hashes may be in a set; a hash's last bits are its place."""

    def __init__(self, bits: int, words: np.ndarray):
        self.mask, self.words = np.uint64((1 << bits) - 1), words

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap_bits(hashes: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, (hashes * BITS_PER_HASH).bit_length()))


def bitmap(hashes: DataFrame, column: str, bits: int) -> Bitmap:
    """Put together by Spark: at most 2^(bits - 6) words reach the driver, however many hashes there are."""
    at = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    word = F.shiftright(at, 6).cast("int")
    bit = F.expr(f"shiftleft(1L, cast({column} & 63 as int))")
    rows = hashes.select(word.alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    words[rows["w"].to_numpy()] = rows["b"].to_numpy().view(np.uint64)
    return Bitmap(bits, words)


def without(docs: DataFrame, name: Column, listed: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``name`` is among those of ``listed`` (one column, no nulls).

    Rows that a bitmap of the listed names rules out stay where they are. Only the
    others, few more than there are listed rows, are shuffled for the exact join; with
    more names than the bitmap has room for that becomes all of them.
    """
    spare = spare_name(docs, "__name")
    names = written(listed.select(F.col(listed.columns[0]).alias(spare)))
    rows = names.select(F.xxhash64(spare).alias("h"))
    bits = bitmap_bits(rows.count())
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(rows, "h", bits))

    @F.arrow_udf("boolean")
    def may_be(hashes: pa.Array) -> pa.Array:
        return pa.array(shared.value(hashes.to_numpy(zero_copy_only=False).view(np.uint64)))

    listed_maybe = name.isNotNull() & may_be(F.xxhash64(name))
    rest = docs.filter(listed_maybe).join(names, name == F.col(spare), "left_anti")
    return docs.filter(~listed_maybe).unionByName(rest)
