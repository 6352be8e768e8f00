"""Quality by compression: which of two Zstandard dictionaries makes a text smaller.

One dictionary is built from text labelled good, one from text labelled bad. Every
text is cut into pieces of ``PIECE`` bytes, so a dictionary keeps its say in long
texts too, and each piece is compressed with either. The difference of the sizes per
byte of text, beside the size per byte with the good dictionary (a text of one
repeated word is tiny with both), becomes a probability by logistic calibration on
labelled texts that built neither dictionary.

Training reads a bounded sample of the labelled rows: the ``sample`` rows per label
that come first by a hash of their key, and of these no more than ``sample_bytes``
bytes of text per label. Texts over a ``LARGE_SHARE``th of that come after all others,
from short to long, so that none of them takes the place of many. Scoring has no such
bound.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import over_batches, written

PIECE = 512
LEVEL = 3
DICTIONARY_BYTES = 112_640
DICTIONARY_PIECES = 4000
SAMPLE = 3000
SAMPLE_BYTES = 16 << 20
LARGE_SHARE = 64
RIDGE = 0.01


@dataclass(frozen=True)
class Model:
    """Two dictionaries and the calibration: score = logistic(weights . standardised features + bias)."""

    good: bytes
    bad: bytes
    mean: tuple[float, float]
    scale: tuple[float, float]
    weights: tuple[float, float]
    bias: float

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = ((features - self.mean) / self.scale) @ np.array(self.weights) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def pieces(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)]


def build_dictionary(texts: list[bytes]) -> bytes:
    """A dictionary from evenly spaced pieces; their plain bytes if there are too few to train on."""
    parts = [p for t in texts for p in pieces(t)]
    if not parts:
        return b""
    step = max(1.0, len(parts) / DICTIONARY_PIECES)
    chosen = [parts[int(i * step)] for i in range(int(len(parts) / step))]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, chosen).as_bytes()
    except zstandard.ZstdError:
        return b"".join(chosen)[-DICTIONARY_BYTES:]


class Sizes:
    """Compressed sizes of whole texts under both dictionaries; made inside a task."""

    def __init__(self, good: bytes, bad: bytes):
        self.press = [
            zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False)
            for d in (good, bad)
        ]

    def features(self, text: str | None) -> tuple[float, float]:
        """Size difference (bad less good) and good size, per byte; zeros for an empty text."""
        data = (text or "").encode("utf-8", "replace")
        parts = pieces(data)
        good, bad = (sum(map(len, map(p.compress, parts))) for p in self.press)
        n = max(len(data), 1)
        return (bad - good) / n, good / n


def _feature_task(good: bytes, bad: bytes, place: int, finish):
    """Adds columns made from the features of the text column at ``place``."""

    def run(batches):
        sizes = Sizes(good, bad)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([sizes.features(t) for t in batch.column(place).to_pylist()], dtype=np.float64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, finish(found))], names=[f"c{i}" for i in range(batch.num_columns + len(finish(found)))])

        yield from over_batches(work)(batches)

    return run


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (bias last) by Newton steps with a small ridge."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -500, 500)))
        grad = x.T @ (y - p) - RIDGE * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(x.shape[1])
        move = np.linalg.solve(hess, grad)
        w += move / max(1.0, np.abs(move).max() / 5.0)
        if np.abs(move).max() < 1e-9:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, usable: Column, sample: int, sample_bytes: int) -> DataFrame:
    """``key, y, text, part``: the bounded training sample, written once.

    Rows without a key or with a label other than 0 and 1 are left out, as are keys
    with both labels. Of repeated texts of one key the smallest is taken.
    """
    known = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("y"))
    known = known.filter(F.col("key").isNotNull() & F.col("y").isin(0, 1) & usable).groupBy("key").agg(F.min("y").alias("y"), F.max("y").alias("other")).filter("y = other")
    place = F.xxhash64("key")
    chosen = [known.filter(F.col("y") == y).select("key", "y", place.alias("place")).orderBy("place", "key").limit(sample) for y in (0, 1)]
    ids = chosen[0].unionByName(chosen[1])  # 2 x sample rows at most
    body = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rows = body.join(F.broadcast(ids), "key").groupBy("key", "y", "place").agg(F.min("text").alias("text"))
    size = F.octet_length("text").cast("long")
    large = F.when(size > sample_bytes // LARGE_SHARE, size).otherwise(0)
    order = Window.partitionBy("y").orderBy(large, "place", "key")
    so_far, turn = F.sum(size).over(order), F.row_number().over(order)
    none = F.raise_error(F.lit(f"no text of a label has {sample_bytes} bytes or less")).cast("boolean")
    ranked = rows.select("key", "y", "text", so_far.alias("bytes"), turn.alias("turn"))
    fits = F.when(F.col("bytes") <= sample_bytes, True).when(F.col("turn") == 1, none).otherwise(False)
    return written(ranked.filter(fits).select("key", "y", "text", (F.col("turn") % 2).alias("part")))


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    usable: Column | None = None,
    sample: int = SAMPLE,
    sample_bytes: int = SAMPLE_BYTES,
) -> Model | None:
    """A model, or None where the usable labels don't hold both classes.

    A label whose texts are all longer than ``sample_bytes`` is an error. ``usable``: which labelled rows may be learnt from, as a condition on ``key``.
    """
    rows = labelled_sample(docs, labels, key, text, label, F.lit(True) if usable is None else usable, sample, sample_bytes)
    dictionaries = {}
    for y in (0, 1):
        texts = [r["text"].encode("utf-8", "replace") for r in rows.filter((F.col("y") == y) & (F.col("part") == 1)).orderBy(F.xxhash64("key"), "key").select("text").toLocalIterator()]
        dictionaries[y] = build_dictionary(texts)
    if not dictionaries[0] or not dictionaries[1]:
        return None
    task = _feature_task(dictionaries[1], dictionaries[0], 1, lambda f: [f[:, 0], f[:, 1]])
    # The half that built no dictionary; all of it where there are only a few rows.
    spare = rows.filter("part = 0")
    spare = spare if spare.select("y").distinct().count() == 2 else rows
    known = spare.select("y", "text").mapInArrow(task, "y int, text string, a double, b double").select("y", "a", "b").toArrow()
    x = np.column_stack([known["a"].to_numpy(), known["b"].to_numpy()])
    y = known["y"].to_numpy().astype(float)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    w = logistic((x - mean) / scale, y)
    return Model(dictionaries[1], dictionaries[0], tuple(mean), tuple(scale), (float(w[0]), float(w[1])), float(w[2]))


def with_score(docs: DataFrame, model: Model | None, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with a probability of being good, from the whole text alone.

    Null and empty texts have the score of size differences of zero. Without a model
    every score is 0.5. Rows and other columns stay as they are; a column named
    ``into`` is refused rather than replaced.
    """
    if into in docs.columns:
        raise ValueError(f"the rows have a column named {into} already")
    if model is None:
        return docs.withColumn(into, F.lit(0.5))
    task = _feature_task(model.good, model.bad, docs.columns.index(text), lambda f: [model.probability(f)])
    return docs.mapInArrow(task, T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())]))


def held_out(key: Column) -> Column:
    """Rows kept for measuring: crc32 of the key's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """One row per row of ``docs``: key, held_out, score, predicted; learnt from rows not held out."""
    model = train(docs, labels, key, text, label, usable=~held_out(F.col("key")))
    scored = with_score(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text")), model, "text", "score")
    return scored.select(F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labelled: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """``docs`` without the rows whose score is below one half; learnt from ``labelled`` rows not held out."""
    model = train(labelled, labels, key, text, label, usable=~held_out(F.col("key")))
    return with_score(docs, model, text, "__quality").filter("__quality >= 0.5").drop("__quality")
