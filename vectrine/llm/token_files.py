"""Token ids in compressed files: written in key order, read back in parallel.

A range shuffle by key puts the texts in order; each task tokenises its range and
writes segments. A segment holds whole documents, about ``SEGMENT_IDS`` ids, one
frequency table shared by its blocks, and the blocks (see ``rans``). Segments are rows
of a Parquet file, so files are committed by Spark's writer on any file system, a
lost task leaves nothing behind, and readers split them as usual. A task holds one
segment at a time, or one document if that is longer.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices
from .rans import Block, Corrupt, Decoder, Frequencies, encode
from .tokens import END, SLICE_BYTES, Encoder, give_back, shared_description

SEGMENT_IDS = 2 << 20
TEXT_BYTES_PER_FILE = 32 << 20


def _schema(kind: str) -> str:
    return f"part int, segment int, keys array<{kind}>, lengths array<long>, ids long, freq binary, blocks array<binary>"


def _write_task(shared, key_type: pa.DataType):
    def run(batches):
        encoder, part = Encoder(shared.value), TaskContext.get().partitionId()
        keys, docs, held, segment = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(docs), dtype="<u4")
            table = Frequencies.of(ids)
            blocks = [b.bytes() for b in encode(ids, table)]
            columns = [
                pa.array([part], pa.int32()),
                pa.array([segment], pa.int32()),
                pa.array([keys], pa.list_(key_type)),
                pa.array([[len(d) // 4 for d in docs]], pa.list_(pa.int64())),
                pa.array([len(ids)], pa.int64()),
                pa.array([table.bytes()], pa.binary()),
                pa.array([blocks], pa.list_(pa.binary())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["part", "segment", "keys", "lengths", "ids", "freq", "blocks"])

        for batch in batches:
            for some in slices(batch, SLICE_BYTES):
                for key, ids in zip(some.column(0).to_pylist(), encoder(some.column(1))):
                    keys.append(key)
                    docs.append(ids + END)
                    held += len(ids) // 4 + 1
                    if held >= SEGMENT_IDS:
                        yield flush()
                        keys, docs, held, segment = [], [], 0, segment + 1
        if docs:
            yield flush()
        encoder.forget()
        give_back()

    return run


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, key: str = "doc_id", text: str = "text", files: int | None = None) -> None:
    """Write the ids of every document of ``docs``, each with the end id, in ascending key order.

    ``files``: how many; by default one for each ``TEXT_BYTES_PER_FILE`` of text. A
    null text is an empty one; null keys come first; rows that repeat a key follow
    each other, ordered by their texts' hash. Further columns are ignored, whatever
    their names. An empty table gives a folder without rows.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    if files is None:
        size = slim.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        files = int(size // TEXT_BYTES_PER_FILE) + 1
    ordered = slim.repartitionByRange(files, "key", F.xxhash64("text")).sortWithinPartitions("key", F.xxhash64("text"))
    kind = slim.schema["key"].dataType.simpleString()
    key_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    rows = ordered.mapInArrow(_write_task(shared_description(spark, vocabulary), key_type), _schema(kind))
    # The payload is at its entropy already.
    rows.write.mode("errorifexists").option("compression", "uncompressed").option("parquet.block.size", 16 << 20).parquet(folder)


def segment_starts(spark: SparkSession, folder: str, kind: str = "bigint") -> DataFrame:
    """``part, segment, before``: ids in front of each segment, in key order."""
    sizes = spark.read.schema(_schema(kind)).parquet(folder).select("part", "segment", "ids")
    parts = sizes.groupBy("part").agg(F.sum("ids").alias("total"))
    # One row per file.
    upto = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = parts.select("part", F.coalesce(upto, F.lit(0)).alias("file_start"))
    inside = F.sum("ids").over(Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1))
    return sizes.withColumn("inside", F.coalesce(inside, F.lit(0))).join(files, "part").select("part", "segment", (F.col("file_start") + F.col("inside")).alias("before"))


def _read_task(with_ids: bool):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in ("part", "segment", "keys", "lengths", "freq", "blocks")}
                decoder = Decoder(Frequencies.read(row["freq"].as_py()))
                found = decoder([Block.read(b) for b in row["blocks"].as_py()])
                ids = np.concatenate([np.zeros(0, dtype=np.uint32), *found]).astype("<u4", copy=False)
                keys, lengths = row["keys"].values, np.array(row["lengths"].as_py(), dtype=np.int64)
                ends = np.cumsum(lengths)
                if len(keys) != len(lengths) or (len(ends) and ends[-1] != len(ids)):
                    raise Corrupt("a segment's documents do not fill it")
                raw = ids.tobytes()
                parts = [raw[4 * (b - n) : 4 * b] for b, n in zip(ends.tolist(), lengths.tolist())]
                columns = [
                    pa.array([row["part"].as_py()] * len(parts), pa.int32()),
                    pa.array([row["segment"].as_py()] * len(parts), pa.int32()),
                    keys,
                    pa.array(ends - lengths),
                    pa.array(lengths),
                    pa.array(list(map(zlib.crc32, parts)), pa.int64()),
                ]
                names = ["part", "segment", "key", "inside", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(parts, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read_token_files(spark: SparkSession, folder: str, key: str = "doc_id", kind: str = "bigint", with_ids: bool = False) -> DataFrame:
    """Per document of the files: key, start (ids of all before it), n_tokens, ids_crc32 (and ids).

    Every block is checked against its checksums; damage raises ``Corrupt``.
    """
    rows = spark.read.schema(_schema(kind)).parquet(folder)
    out = f"part int, segment int, key {kind}, inside long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    docs = rows.mapInArrow(_read_task(with_ids), out).join(segment_starts(spark, folder, kind), ["part", "segment"])
    extra = ["ids"] if with_ids else []
    return docs.select(F.col("key").alias(key), (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *extra)
