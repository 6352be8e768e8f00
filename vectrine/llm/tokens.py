"""Token ids of whole texts, by the tokenizers library.

The vocabulary file's path is a parameter. The driver reads the file, and its text
(a few megabytes) travels to the tasks, so executors need no copy of it.

A byte-level pre-tokenizer never joins the two sides of the last white-space
character before a word, nor a letter and the punctuation behind it, nor a newline and
a word behind it, so a text may be cut there and each segment encoded by itself; the
ids are the same. Segments repeat, so Arrow finds the distinct ones of a slice and puts
their ids together again; a task remembers the ids of those it has seen, up to a bound,
and encodes only new ones. Vocabularies of another kind encode whole texts.
"""

from __future__ import annotations

import ctypes.util
import json
import os
import string
import sys
import zlib
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

END_ID = 0
# Two generations of as many are remembered, some 50 MB each.
CACHED_SEGMENTS = 250_000
CACHED_CHARS = 48
# Text cut at a time: the more, the fewer segments come again in a later slice.
SLICE_BYTES = 8 << 20
# Letters up to here have been letters in every version of Unicode that the two sides may follow.
LAST_PLAIN_LETTER = "\u052f"

# What a byte of UTF-8 may be: a bit each. A first byte of several (below 0xE0) is PAIR if
# all its characters are letters that have always been; SOLID bytes begin no white space.
SPACE, NEWLINE, PUNCTUATION, LETTER, PAIR, SOLID = 1, 2, 4, 8, 16, 32


def _kinds() -> np.ndarray:
    kinds = np.zeros(256, dtype=np.uint8)
    kinds[list(b" \n")] |= SPACE
    kinds[ord("\n")] |= NEWLINE
    kinds[list(string.punctuation.encode())] |= PUNCTUATION
    kinds[list(string.ascii_letters.encode())] |= LETTER
    # U+00C0 to U+027F, U+0400 to U+047F
    kinds[[*range(0xC3, 0xCA), 0xD0, 0xD1]] |= PAIR
    kinds[0x21:0x7F] |= SOLID
    kinds[0xC3:0xF5] |= SOLID
    # U+1680, U+180E, U+2000 to U+205F and U+3000 are white space, or were
    kinds[[0xE1, 0xE2, 0xE3]] &= ~np.uint8(SOLID)
    return kinds


KINDS = _kinds()


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where segments begin: places in the bytes of several texts, the first of which begin at ``starts``.

    The ids of a text's segments, one after another, are those of the text. Where that
    is in doubt, there is no cut.
    """
    kinds = KINDS[data]
    solid = (kinds & SOLID).astype(bool)
    cut = np.zeros(len(data), dtype=bool)
    # Before white space with something else behind it, in the same text.
    cut[:-1] = (kinds[:-1] & SPACE).astype(bool) & solid[1:]
    cut[starts[1:] - 1] = False
    # Behind a newline.
    cut[1:] |= (kinds[:-1] & NEWLINE).astype(bool) & solid[1:]
    # Between a letter and punctuation.
    letter = (kinds & LETTER).astype(bool)
    # The signs of multiplication and division are no letters.
    letter[1:] |= (kinds[:-1] & PAIR).astype(bool) & ~((data[:-1] == 0xC3) & ((data[1:] & 0xDF) == 0x97))
    cut[1:] |= letter[:-1] & (kinds[1:] & PUNCTUATION).astype(bool)
    cut[starts] = True
    return np.flatnonzero(cut)


def byte_alphabet() -> dict[int, str]:
    """What the byte-level pre-tokenizer makes of each plain character, as a translation table."""
    from tokenizers.pre_tokenizers import ByteLevel

    level = ByteLevel(add_prefix_space=False, use_regex=False)
    return {i: level.pre_tokenize_str(chr(i))[0][0] for i in range(ord(LAST_PLAIN_LETTER) + 1)}


def one_word(segment: str) -> bool:
    """Letters, perhaps behind a space: one unit of the pre-tokenizer."""
    return (segment[1:] if segment[0] == " " else segment).isalpha() and (segment.isascii() or max(segment) <= LAST_PLAIN_LETTER)


def cuttable(description: str) -> bool:
    """Whether the vocabulary's description says that segments may be encoded by themselves."""
    d = json.loads(description)
    pre = d.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    return bool(plain) and not d.get("normalizer") and not d.get("truncation") and not d.get("padding")


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    numbers = array("I", ids)
    if sys.byteorder != "little":
        numbers.byteswap()
    return numbers.tobytes()


class Encoder:
    """Texts to bytes of little-endian unsigned 32-bit ids; made inside a task."""

    def __init__(self, description: str, cached: int = CACHED_SEGMENTS):
        self.cached = cached
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        self.tokenizer.encode_special_tokens = True  # such strings in a text are ordinary text
        plain = cuttable(description)
        self.plain = plain
        self.model, self.alphabet = (self.tokenizer.model, byte_alphabet()) if plain else (None, {})
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def forget(self) -> None:
        """Drop what is remembered."""
        self.known, self.older = {}, {}

    def _learn(self, new: Iterable[str]) -> None:
        """Ids of segments: from the older generation, else from the tokenizer.

        A single word needs no pre-tokenizer and goes to the tokenizer's model at once.
        """
        older, known, mixed = self.older, self.known, []
        for s in new:
            ids = older.get(s)
            if ids is not None:
                known[s] = ids
            elif self.model is not None and one_word(s):
                known[s] = packed([t.id for t in self.model.tokenize(s.translate(self.alphabet))])
            else:
                mixed.append(s)
        for s, e in zip(mixed, self.tokenizer.encode_batch_fast(mixed, add_special_tokens=False)):
            known[s] = packed(e.ids)

    def __call__(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Ids of each text (none of a null one), without an end."""
        if len(self.known) > self.cached:
            self.older, self.known = self.known, {}
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        texts = pc.fill_null(texts, "")
        # Of the texts one after another: where each ends, and the segments.
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        if not len(ends) or not ends[-1]:
            return [b""] * len(texts)
        begin = np.concatenate([[0], ends[:-1]])
        data = pc.binary_join(pa.LargeListArray.from_arrays([0, len(texts)], texts), pa.scalar("", pa.large_string())).buffers()[2]
        starts = begin[begin < ends]
        at = cuts(np.frombuffer(data, dtype=np.uint8, count=ends[-1]), starts) if self.plain else starts
        offsets = pa.py_buffer(np.append(at, ends[-1]))
        dealt = pa.LargeStringArray.from_buffers(len(at), offsets, data).dictionary_encode()
        distinct, known = dealt.dictionary.to_pylist(), self.known
        needed = [s for s in distinct if s not in known]
        self._learn(needed)
        ids = pa.array(map(known.__getitem__, distinct), pa.large_binary(), size=len(distinct)).take(dealt.indices)
        # Long ones are known for this call only.
        for s in needed:
            if len(s) > CACHED_CHARS:
                del known[s]
        places = np.frombuffer(ids.buffers()[1], dtype=np.int64, count=len(at) + 1)
        out = places[np.searchsorted(at, np.append(begin, ends[-1]))].tolist()
        joined = memoryview(ids.buffers()[2])
        return [bytes(joined[a:b]) for a, b in zip(out, out[1:])]


def give_back() -> None:
    """Return freed memory to the system at a task's end, as the worker lives on."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.util.find_library("c")
    if libc and hasattr(trim := ctypes.CDLL(libc), "malloc_trim"):
        trim.malloc_trim(0)


END = np.array([END_ID], dtype="<u4").tobytes()


def crc(ids: bytes) -> int:
    return zlib.crc32(ids)


def description_of(path: str) -> str:
    """The vocabulary file's text, read on the driver."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def shared_description(spark: SparkSession, path: str):
    """The vocabulary for all tasks, by broadcast: its size is that of the file."""
    return spark.sparkContext.broadcast(description_of(path))
