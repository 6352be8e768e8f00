"""Static range asymmetric numeral systems over token ids, many lanes at a time.

A block of ids is dealt over ``LANES`` interleaved lanes (id i to lane i mod LANES).
Each lane is a 64-bit state between 2^31 and 2^63. Coding an id with frequency f and
cumulated frequency c (out of 2^SCALE) maps state x to (x // f) 2^SCALE + x mod f + c;
32 low bits go to the block's word stream first where the result would not fit. All
lanes of all blocks advance together as numpy vectors. Blocks have their own words and
states, so any of them can be decoded alone, and from any of its checkpoints on.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

SCALE = 18
LANES = 128
BLOCK_STEPS = 512
CHECKPOINT_STEPS = 256
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
TOTAL = 1 << SCALE
MAGIC = b"RANS1"


class Corrupt(ValueError):
    """A checksum or a count does not agree."""


@dataclass(frozen=True)
class Frequencies:
    """A table shared by blocks: the symbols that occur and their shares of 2^SCALE."""

    symbols: np.ndarray
    shares: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray) -> Frequencies:
        symbols, counts = np.unique(ids, return_counts=True)
        if len(symbols) > TOTAL // 2:
            raise ValueError("more different ids than the scale has room for")
        shares = np.maximum(counts * np.int64(TOTAL) // max(int(counts.sum()), 1), 1).astype(np.int64)
        over = int(shares.sum()) - TOTAL
        order = np.argsort(-shares, kind="stable")
        if over < 0 and len(shares):
            shares[order[0]] -= over
        while over > 0:
            # Taken from the largest shares in turn, never below one.
            give = np.minimum(shares[order] - 1, max(1, over // len(order)))
            give[np.cumsum(give) > over] = 0
            shares[order] -= give
            over -= int(give.sum())
        return cls(symbols.astype(np.int64), shares)

    def bytes(self) -> bytes:
        gaps = np.diff(self.symbols, prepend=0).astype("<u4").tobytes() + self.shares.astype("<u4").tobytes()
        return zlib.compress(struct.pack("<I", len(self.symbols)) + gaps, 6)

    @classmethod
    def read(cls, data: bytes) -> Frequencies:
        plain = zlib.decompress(data)
        n = struct.unpack("<I", plain[:4])[0]
        both = np.frombuffer(plain, dtype="<u4", offset=4).astype(np.int64)
        return cls(np.cumsum(both[:n]), both[n : 2 * n])

    def starts(self) -> np.ndarray:
        return np.cumsum(self.shares) - self.shares


@dataclass(frozen=True)
class Block:
    """``count`` ids; states at each checkpoint, and how many words were read by then."""

    count: int
    states: np.ndarray  # [checkpoints, LANES]
    places: np.ndarray  # [checkpoints]
    words: np.ndarray
    checksum: int

    def bytes(self) -> bytes:
        body = self.states.astype("<u8").tobytes() + self.places.astype("<u4").tobytes() + self.words.astype("<u4").tobytes()
        head = struct.pack("<5sIIIII", MAGIC, self.count, len(self.places), len(self.words), self.checksum, zlib.crc32(body))
        return head + body

    @classmethod
    def read(cls, data: bytes) -> Block:
        size = struct.calcsize("<5sIIIII")
        if len(data) < size:
            raise Corrupt("a block ends early")
        magic, count, points, words, checksum, own = struct.unpack("<5sIIIII", data[:size])
        body = data[size:]
        if magic != MAGIC or zlib.crc32(body) != own or len(body) != points * (LANES * 8 + 4) + words * 4:
            raise Corrupt("a block is damaged")
        a, b = points * LANES * 8, points * (LANES * 8 + 4)
        return cls(count, np.frombuffer(body[:a], "<u8").reshape(points, LANES), np.frombuffer(body[a:b], "<u4").astype(np.int64), np.frombuffer(body[b:], "<u4"), checksum)


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def encode(ids: np.ndarray, table: Frequencies) -> list[Block]:
    """Blocks of ``LANES * BLOCK_STEPS`` ids; the last may be shorter."""
    room = LANES * BLOCK_STEPS
    whole = len(ids) // room
    out = _encode_equal(ids[: whole * room].reshape(whole, BLOCK_STEPS, LANES), [room] * whole, table) if whole else []
    rest = ids[whole * room :]
    if len(rest):
        steps = -(-len(rest) // LANES)
        padded = np.concatenate([rest, np.full(steps * LANES - len(rest), rest[0], dtype=rest.dtype)])
        out += _encode_equal(padded.reshape(1, steps, LANES), [len(rest)], table)
    return out


def _encode_equal(ids: np.ndarray, counts: list[int], table: Frequencies) -> list[Block]:
    """Blocks of equally many steps, together; steps are coded from the last to the first."""
    blocks, steps, _ = ids.shape
    lookup = np.zeros(int(table.symbols.max()) + 1, dtype=np.int32)
    lookup[table.symbols] = np.arange(len(table.symbols))
    place = lookup[ids]
    shares, starts = table.shares.astype(np.uint64), table.starts().astype(np.uint64)
    x = np.full((blocks, LANES), LOW, dtype=np.uint64)
    words, lanes, points = [None] * steps, [None] * steps, {}
    scale, room = np.uint64(SCALE), np.uint64(63 - SCALE)
    for t in range(steps - 1, -1, -1):
        at = place[:, t, :]
        f, c = shares[at], starts[at]
        full = x >= (f << room)
        lanes[t] = np.flatnonzero(full)
        words[t] = (x[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        x = np.where(full, x >> WORD, x)
        whole = x // f
        x = (whole << scale) + (x - whole * f) + c
        if t % CHECKPOINT_STEPS == 0:
            points[t] = x.copy()
    block_of = np.concatenate(lanes) // LANES
    stream = np.concatenate(words)
    order = np.argsort(block_of, kind="stable")
    ends = np.cumsum(np.bincount(block_of, minlength=blocks))
    streams = np.split(stream[order], ends[:-1])
    per_step = np.stack([np.bincount(l // LANES, minlength=blocks) for l in lanes], axis=1)
    read = np.concatenate([np.zeros((blocks, 1), dtype=np.int64), np.cumsum(per_step, axis=1)], axis=1)
    stops = sorted(points)
    return [
        Block(counts[b], np.stack([points[t][b] for t in stops]), read[b, stops], streams[b], checksum(ids[b].reshape(-1)[: counts[b]]))
        for b in range(blocks)
    ]


class Decoder:
    """Reads blocks coded with one table."""

    def __init__(self, table: Frequencies):
        self.shares, self.starts = table.shares.astype(np.uint64), table.starts().astype(np.uint64)
        self.symbols = table.symbols.astype(np.uint32)
        self.slots = np.repeat(np.arange(len(table.symbols), dtype=np.int32), table.shares)

    def _run(self, x: np.ndarray, words: np.ndarray, at: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """``steps`` steps of several blocks; ``words`` [blocks, most], ``at`` the next word of each."""
        out = np.empty((len(x), steps, LANES), dtype=np.uint32)
        mask, scale = np.uint64(TOTAL - 1), np.uint64(SCALE)
        rows = np.arange(len(x))[:, None]
        last = words.shape[1] - 1
        for t in range(steps):
            slot = x & mask
            s = self.slots[slot]
            out[:, t] = self.symbols[s]
            x = self.shares[s] * (x >> scale) + slot - self.starts[s]
            need = x < LOW
            turn = np.cumsum(need, axis=1)
            take = words[rows, np.minimum(at[:, None] + turn - 1, last)]
            x = np.where(need, (x << WORD) | take, x)
            at = at + turn[:, -1]
        return out, at

    def __call__(self, blocks: list[Block]) -> list[np.ndarray]:
        """Ids of each block, checked. Blocks of equal length are decoded together."""
        out: list[np.ndarray | None] = [None] * len(blocks)
        by_steps: dict[int, list[int]] = {}
        for i, b in enumerate(blocks):
            by_steps.setdefault(-(-b.count // LANES), []).append(i)
        for steps, members in by_steps.items():
            most = max(len(blocks[i].words) for i in members) + 1
            words = np.zeros((len(members), most), dtype=np.uint64)
            for row, i in enumerate(members):
                words[row, : len(blocks[i].words)] = blocks[i].words
            x = np.stack([blocks[i].states[0] for i in members]).astype(np.uint64)
            ids, at = self._run(x, words, np.zeros(len(members), dtype=np.int64), steps)
            for row, i in enumerate(members):
                found = ids[row].reshape(-1)[: blocks[i].count]
                if at[row] != len(blocks[i].words) or checksum(found) != blocks[i].checksum:
                    raise Corrupt("a block's ids do not agree with its checksum")
                out[i] = found
        return out

    def from_checkpoint(self, block: Block, point: int) -> np.ndarray:
        """The ids from a checkpoint to the next one, without what lies before."""
        steps = -(-block.count // LANES)
        first = point * CHECKPOINT_STEPS
        n = min(CHECKPOINT_STEPS, steps - first)
        words = np.append(block.words, 0).astype(np.uint64)[None, :]
        ids, _ = self._run(block.states[point][None, :].astype(np.uint64), words, block.places[point : point + 1], n)
        return ids.reshape(-1)[: block.count - first * LANES]
