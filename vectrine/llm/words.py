"""The words of a batch of texts and their hashes, by numpy over the batch's bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from .decontaminate import BASE, _mixed, gram_hashes

# A word ends at \x20 or \x09-\x0D.
SPACES = np.isin(np.arange(256), [32, *range(9, 14)])
BYTE_VALUES = np.where(SPACES, np.uint64(0), _mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * BASE))
# Words up to here are hashed together, longer ones each by XXH64.
LONGEST = 256
POWERS = np.cumprod(np.full(LONGEST, BASE, dtype=np.uint64))
BLOCK = 1 << 20


@dataclass
class Words:
    """Word i lies in text ``row[i]``, at bytes ``start[i]`` to ``end[i]`` of ``data``."""

    data: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # per text the number of its first word, and the count of all

    @classmethod
    def of(cls, texts: pa.Array) -> Words:
        """Null texts have no words."""
        texts = texts.fill_null("").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        body = texts.buffers()[2]
        data = np.frombuffer(body, dtype=np.uint8) if body else np.zeros(0, dtype=np.uint8)
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        inside = ~SPACES[data]
        full = offsets[:-1][offsets[:-1] < offsets[1:]], offsets[1:][offsets[:-1] < offsets[1:]] - 1
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        begins[full[0]], ends[full[1]] = inside[full[0]], inside[full[1]]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        first = np.searchsorted(start, offsets)
        return cls(data, np.repeat(np.arange(len(texts)), np.diff(first)), start, end, first)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same wherever it stands."""
        out = np.empty(len(self), dtype=np.uint64)
        cuts = np.unique(np.concatenate([np.searchsorted(self.start, np.arange(0, len(self.data), BLOCK)), [0, len(self)]]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            start, low = self.start[a:b], self.start[a]
            values = BYTE_VALUES[self.data[low : self.end[b - 1]]]
            place = np.arange(len(values)) - np.repeat(start - low, np.diff(np.append(start - low, len(values))))
            values *= POWERS[np.minimum(place, LONGEST - 1)]
            out[a:b] = np.add.reduceat(values, start - low)
        out = _mixed(out + (self.end - self.start).astype(np.uint64))
        for i in np.flatnonzero(self.end - self.start > LONGEST):
            out[i] = xxhash.xxh64_intdigest(self.data[self.start[i] : self.end[i]].tobytes())
        return out

    def joined(self, first: int, last: int) -> bytes:
        """Words ``first`` to ``last`` of one text, one space between them."""
        return b" ".join(self.data[self.start[first] : self.end[last]].tobytes().split()) if first <= last else b""


def grams(words: np.ndarray, n: int, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``n`` words from each place on, and whether they lie in one text."""
    count = max(len(words) - n + 1, 0)
    return gram_hashes(words, n), row[:count] == row[n - 1 :] if count else np.zeros(0, dtype=bool)
