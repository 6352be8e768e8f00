"""Benchmark decontamination by winnowing.

Within every window of ``WINDOW`` words (or over a whole item, if it is shorter) the
leftmost k-gram with the smallest hash is selected. Consecutive windows mostly select
the same place, so an item keeps few fingerprints, and a span of the window's length
selects the same place in a document as in the item it was copied from. Fingerprints
of documents and items are joined, and every hit is extended word by word to both
sides as far as the words agree: a run of a window's length is contamination.

A fingerprint travels with the words that its windows can reach, so the extension
compares words, never hashes. Documents are read once and their text is never
shuffled: a bitmap of the benchmark's fingerprints (its size has a fixed bound) goes to
all tasks, and only places that pass it leave them. Equal surroundings are compared
once, however many documents hold them, and items are listed once per set of runs.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap, bitmap_bits, over_batches, text_or_empty, without, written

WINDOW = 10
KNOWN_WORDS = 500_000
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

# Lower-cases A-Z; every byte outside 0-9, a-z and 0x80-0xFF becomes a space.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


class WordHashes(dict):
    """The 64-bit hash of each word, remembered for the frequent ones."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < KNOWN_WORDS and len(word) <= 64:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on."""
    count = max(len(words) - n + 1, 0)
    out = np.full(count, n, dtype=np.uint64)
    for i in range(n):
        out = out * BASE + words[i : i + count]
    return _mixed(out)


def gram_size(window: int) -> int:
    return (window + 1) // 2


def winnow(words: np.ndarray, window: int, known=None) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the selected k-grams in order, each once; only those that may be ``known``, if given."""
    k = gram_size(window)
    grams = gram_hashes(words, k)
    count, choices = max(len(words) - window + 1, 0), window - k + 1
    least = reduce(np.minimum, [grams[i : i + count] for i in range(choices)])
    of = np.arange(count) if known is None else np.flatnonzero(known(least))
    # Of equal hashes in a window the first counts, so equal windows select alike.
    at = np.unique(of + np.argmax(grams[of[:, None] + np.arange(choices)] == least[of, None], axis=1)) if len(of) else of
    return at, grams[at]


# A selected k-gram at word ``at`` of windows of ``len`` words; ``words`` is what those windows can reach, ``lead`` of them before it.
FIELDS = "array<struct<len:int,at:int,fp:long,lead:int,words:string>>"
ARROW_FIELDS = pa.list_(pa.struct([("len", pa.int32()), ("at", pa.int32()), ("fp", pa.int64()), ("lead", pa.int32()), ("words", pa.string())]))


def _places(words: list[bytes], hashes: np.ndarray, window: int, known=None) -> list[dict]:
    reach, k = window - gram_size(window), gram_size(window)
    at, fingerprints = winnow(hashes, window, known)
    out = []
    for p, fp in zip(at.tolist(), fingerprints.view(np.int64).tolist()):
        first = max(p - reach, 0)
        out.append({"len": window, "at": p, "fp": fp, "lead": p - first, "words": b" ".join(words[first : p + k + reach]).decode()})
    return out


def _item_places(window: int):
    def run(batches):
        hashes = WordHashes()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                rows.append(_places(words, hashes.of(words), min(window, len(words))) if words else [])
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, ARROW_FIELDS)], names=["item", "places"])

        yield from over_batches(work)(batches)

    return run


def item_places(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """``item, class, len, fp, lead, words``: the selected places of each item, written once; equal surroundings are one class."""
    slim = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").cast("string").alias("text"))
    found = slim.mapInArrow(_item_places(window), f"item string, places {FIELDS}").select("item", F.explode("places").alias("p"))
    return written(found.select("item", _surroundings("p").alias("class"), "p.len", "p.fp", "p.lead", "p.words").distinct())


def _surroundings(place: str) -> Column:
    return F.unhex(F.md5(F.concat_ws(" ", f"{place}.len", f"{place}.lead", f"{place}.words")))


def _document_places(lengths: list[int], shared):
    def run(batches):
        hashes = WordHashes()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, rows = [], []
            for text in batch.column(2).to_pylist():
                words = words_of(text)
                known = hashes.of(words)
                counts.append(len(words))
                rows.append([place for size in lengths if size <= len(words) for place in _places(words, known, size, shared.value)])
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(rows, ARROW_FIELDS)], names=["key", "copy", "n_words", "hits"])

        yield from over_batches(work)(batches)

    return run


def text_name(text: Column) -> Column:
    """Equal for equal texts; a null text counts as an empty one."""
    return F.unhex(F.md5(text_or_empty(text)))


def _union_length(spans: Column) -> Column:
    """Words inside any of the sorted (start, len) spans."""
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("sum"))

    def step(acc: Column, span: Column) -> Column:
        end = F.greatest(acc["end"], span["start"] + span["len"])
        return F.struct(end.alias("end"), (acc["sum"] + end - F.greatest(acc["end"], F.least(span["start"], end))).alias("sum"))

    return F.aggregate(spans, begin, step, lambda acc: acc["sum"])


def _agreeing(a: Column, b: Column) -> Column:
    """How many words two lists have in common from their beginnings on."""
    n = F.least(F.size(a), F.size(b))
    first = F.array_position(F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x == y), False)
    return F.when(first == 0, n).otherwise(first - 1).cast("int")


def _runs(places: DataFrame, units: DataFrame) -> DataFrame:
    """``context, class, left, right``: words in common to the left of a fingerprint, and from it on, where these make a window."""
    theirs = units.select("class", "len", "fp", F.col("lead").alias("before"), F.split("words", " ").alias("b")).distinct()
    ours = places.select("context", "len", "fp", "lead", F.split("words", " ").alias("a")).distinct()
    rest = lambda words, lead: F.slice(words, F.col(lead) + 1, F.size(words))
    back = lambda words, lead: F.reverse(F.slice(words, 1, F.col(lead)))
    pairs = ours.join(theirs, ["len", "fp"]).select(
        "context", "class", "len", _agreeing(back("a", "lead"), back("b", "before")).alias("left"), _agreeing(rest("a", "lead"), rest("b", "before")).alias("right")
    )
    return pairs.filter("right >= floor((len + 1) / 2) and left + right >= len").drop("len")


def find_contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(rows, facts): ``key, copy, n_words`` per document; ``copy, n_hit, items`` per contaminated text.

    ``copy`` names a text; equal texts have one row of facts.
    """
    units = item_places(benchmark, item, item_text, window)
    size = units.agg(F.count("*").alias("n"), F.collect_set("len").alias("lengths")).first()
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(units, "fp", bitmap_bits(size["n"])))
    slim = docs.select(F.col(f"`{key}`").alias("key"), text_name(F.col(f"`{text}`")).alias("copy"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = slim.schema["key"].dataType.simpleString()
    rows = written(slim.mapInArrow(_document_places(sorted(size["lengths"]), shared), f"key {kind}, copy binary, n_words long, hits {FIELDS}"))
    places = rows.filter("size(hits) > 0").select("copy", F.explode("hits").alias("p"))
    places = written(places.select("copy", "p.at", _surroundings("p").alias("context"), "p.len", "p.fp", "p.lead", "p.words").distinct())
    runs = written(_runs(places, units))

    # All runs of one place hold its fingerprint, so together they are one stretch of words.
    widest = runs.groupBy("context").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    stretch = F.slice(F.split("words", " "), F.col("lead") - F.col("left") + 1, F.col("left") + F.col("right"))
    name = F.unhex(F.md5(F.concat_ws(" ", "len", "left", F.array_join(stretch, " ")))).alias("run")
    hits = written(places.join(widest, "context").select("copy", "context", name, (F.col("at") - F.col("left")).alias("start"), (F.col("left") + F.col("right")).alias("len")))
    spans = hits.groupBy("copy").agg(F.array_sort(F.collect_set(F.struct("start", "len"))).alias("spans"), F.array_sort(F.collect_set("run")).alias("runs"))
    texts = written(spans.select("copy", _union_length(F.col("spans")).alias("n_hit"), F.md5(F.concat_ws(",", F.transform("runs", F.hex))).alias("set"), "runs"))

    # Equal stretches agree with the same items, and texts with equal stretches have the same list.
    of_run = hits.select("run", "context").distinct().join(runs.select("context", "class"), "context").select("run", "class").distinct()
    of_run = of_run.join(units.filter("item is not null").select("class", "item"), "class").select("run", "item").distinct()
    sets = texts.select("set", "runs").dropDuplicates(["set"]).select("set", F.explode("runs").alias("run"))
    lists = sets.join(of_run, "run").groupBy("set").agg(F.array_sort(F.collect_set("item")).alias("items"))
    facts = texts.join(lists, "set", "left").select("copy", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return rows.drop("hits"), facts


def contamination_report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words and no hits, on either side. An item without
    an id makes hits but is not counted or listed; repeated items count once. Null
    keys and repeated rows are rows like any other. With an empty benchmark nothing
    is hit. Further columns are ignored, whatever their names.
    """
    rows, facts = find_contamination(docs, benchmark, key, text, item, item_text, window)
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.join(facts, "copy", "left").select(
        F.col("key").alias(key),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows whose text shares a window with the benchmark.

    Null and empty texts share nothing and stay, as does everything beside an empty
    benchmark. Repeated rows and null keys are rows like any other; all columns of
    ``docs`` are kept, whatever their names.
    """
    _, facts = find_contamination(docs, benchmark, key, text, item, item_text, window)
    return without(docs, text_name(F.col(f"`{text}`")), facts.select("copy"))
