"""Rules on repetition: how much of a text lies inside its own duplicated n-grams and lines.

Each text is judged on its own inside one Arrow batch, so nothing is shuffled. Words
get exact ids per text. A rolling hash over the ids' random 64-bit values gives the
hash of every n-gram of a length at once (numpy, wrapping 64-bit arithmetic);
places whose hash occurs again are marked, and the characters under the marks are
summed. A text whose n-grams are all different has no longer ones that repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import over_batches

# Published limits for repetition in web text: shares of the characters of the words,
# of the lines, and symbols per word.
TOP_LIMITS = {2: 0.20, 3: 0.18, 4: 0.16}
DUPLICATE_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.30
LINE_CHARS_LIMIT = 0.20
SYMBOL_LIMIT = 0.10
LEAST_WORDS = 50
REPEAT_WINDOW = 3
REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

MIX_A, MIX_B, BASE = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mixed(ids: np.ndarray) -> np.ndarray:
    """A fixed random-looking 64-bit value for each id."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * BASE
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def rolling_hashes(ids: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """For each n, the hash of the n-gram that starts at each word.

    One multiply-add per length: the hash of n + 1 words extends that of n.
    """
    values, out = _mixed(ids), {}
    rolled = values
    for n in range(1, max(lengths) + 1):
        if n > 1:
            if len(values) < n:
                break
            rolled = rolled[: len(values) - n + 1] * BASE + values[n - 1 :]
        if n in lengths:
            out[n] = rolled
    return out


def _covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie in an n-gram that starts at one of the given places."""
    edge = np.zeros(words + 1, dtype=np.int32)
    edge[starts] += 1
    edge[starts + n] -= 1
    return np.cumsum(edge[:-1]) > 0


class Grams:
    """The n-grams of one length: which occur twice or more, and the most frequent."""

    def __init__(self, codes: np.ndarray):
        order = np.sort(codes)
        edges = np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1])))
        counts = np.diff(np.append(edges, len(order)))
        self.codes, self.top = codes, int(counts.max())
        self.twice = order[edges[counts > 1]]
        self.tied = order[edges[counts == self.top]] if self.top > 1 else order[:0]

    def _places(self, values: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(values, self.codes), max(len(values) - 1, 0))
        return np.flatnonzero(values[at] == self.codes) if len(values) else at[:0]

    def repeats(self) -> np.ndarray:
        """Places of the n-grams that occur twice or more, the first time included."""
        return self._places(self.twice)

    def most_frequent(self, chars: np.ndarray) -> np.ndarray:
        """Places of the most frequent n-gram; among equals that with the most characters."""
        places = self._places(self.tied)
        return places[self.codes[places] == self.codes[places[np.argmax(chars[places])]]] if len(places) else places


def measure(text: bytes) -> dict[str, float]:
    """Everything the rules look at, of one UTF-8 text."""
    words = text.split()  # bytes are split at \x20 and \x09-\x0D only
    n = len(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    earlier: set[bytes] = set()
    dup_lines = dup_line_chars = line_chars = 0
    for line in lines:
        chars = _code_points(line)
        line_chars += chars
        if line in earlier:
            dup_lines += 1
            dup_line_chars += chars
        earlier.add(line)
    found = {"n_words": n, "word_chars": 0, "n_symbols": len(text) - len(text.translate(None, SYMBOLS)), "n_dup_lines": dup_lines, "n_repeat_words": 0}
    found["line_share"] = dup_lines / len(lines) if lines else 0.0
    found["line_char_share"] = dup_line_chars / line_chars if line_chars else 0.0
    shares = {k: 0.0 for k in (*TOP_LIMITS, *DUPLICATE_LIMITS)}
    if n:
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=n)
        sizes = np.fromiter(map(_code_points, known), dtype=np.int64, count=len(known))[ids]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        found["word_chars"] = total = int(ends[-1])
        for k, codes in rolling_hashes(ids, [*shares]).items():
            grams = Grams(codes)
            if grams.top == 1:
                break  # no longer n-gram can occur twice
            if k == REPEAT_WINDOW:
                found["n_repeat_words"] = int(_covered(grams.repeats(), k, n).sum())
            places = grams.most_frequent(ends[k:] - ends[:-k]) if k in TOP_LIMITS else grams.repeats()
            shares[k] = float(sizes[_covered(places, k, n)].sum() / total)
    found |= {f"share_{k}": v for k, v in shares.items()}
    return found


def _code_points(piece: bytes) -> int:
    return len(piece.decode("utf-8", "replace"))


def base_failed(m: dict) -> bool:
    return m["n_words"] < LEAST_WORDS or 100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"]


def broken_rules(m: dict) -> list[str]:
    """Names of the repetition and symbol rules a text breaks."""
    found = [f"top_{k}" for k, limit in TOP_LIMITS.items() if m[f"share_{k}"] > limit]
    found += [f"duplicate_{k}" for k, limit in DUPLICATE_LIMITS.items() if m[f"share_{k}"] > limit]
    if m["line_share"] > LINE_LIMIT:
        found.append("lines")
    if m["line_char_share"] > LINE_CHARS_LIMIT:
        found.append("line_chars")
    if m["n_symbols"] > SYMBOL_LIMIT * m["n_words"]:
        found.append("symbols")
    return found


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _judge(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = [measure((t or "").encode("utf-8", "replace")) for t in batch.column(1).to_pylist()]
    broken = [broken_rules(m) for m in rows]
    failed = [base_failed(m) for m in rows]
    columns = [batch.column(0)]
    columns += [pa.array([m[c] for m in rows], pa.int64()) for c in COUNTS]
    columns += [
        pa.array(failed, pa.bool_()),
        pa.array([not f and not b for f, b in zip(failed, broken)], pa.bool_()),
        pa.array([",".join(b) for b in broken], pa.string()),
        pa.array([max(m[f"share_{k}"] for k in DUPLICATE_LIMITS) for m in rows], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["key", *COUNTS, "base_failed", "kept", "broken", "duplicate_share"])


def judge_quality(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, counts, base_failed, kept, the broken rules, the largest share.

    A null or empty text has no words, fails and is not kept. Null keys and repeated
    rows are rows like any other; further columns are ignored, whatever their names.
    Whole texts are measured; memory follows the longest text.
    """
    slim = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = slim.schema["key"].dataType.simpleString()
    out = f"key {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, broken string, duplicate_share double"
    return slim.mapInArrow(over_batches(_judge), out).withColumnRenamed("key", key)
