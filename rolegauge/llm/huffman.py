"""Canonical, length-limited Huffman codes of token ids, in numpy: package-merge lengths, vectorised packing, and table-driven decoding
in many lanes at once, one lane for each bit-offset checkpoint."""

from __future__ import annotations

import numpy as np

MAX_BITS = 18
CHECKPOINT = 512


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal lengths of at most `limit` bits for symbols with the given positive counts (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.uint8)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need more than {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    levels, now = [], leaves
    is_leaf = np.ones(n, bool)
    for _ in range(limit - 1):
        levels.append(is_leaf)
        pairs = now[: len(now) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([leaves, pairs])
        place = np.argsort(merged, kind="stable")
        now, is_leaf = merged[place], place < n
    levels.append(is_leaf)
    lengths, take = np.zeros(n, np.uint8), 2 * n - 2
    for flags in reversed(levels):
        own = int(flags[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    found = np.empty(n, np.uint8)
    found[order] = lengths
    return found


class Codebook:
    """The canonical code of `symbols` (ascending) with `lengths`: shorter codes first, then by symbol."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        self.symbols, self.lengths = symbols.astype(np.uint32), lengths.astype(np.uint8)
        order = np.lexsort([self.symbols, self.lengths])
        by_length = self.lengths[order].astype(np.int64)
        self.bits = max(1, int(by_length.max(initial=1)))
        room = np.left_shift(1, self.bits - by_length)
        firsts = np.cumsum(room) - room  # a code, filled up to `bits` bits
        size = int(self.symbols.max(initial=0)) + 1
        self.code, self.length = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.code[self.symbols[order]] = (firsts >> (self.bits - by_length)).astype(np.uint64)
        self.length[self.symbols[order]] = by_length.astype(np.uint64)
        used = int(room.sum())
        self.table_symbol, self.table_length = np.zeros(1 << self.bits, np.uint32), np.zeros(1 << self.bits, np.uint8)
        self.table_symbol[:used] = np.repeat(self.symbols[order], room)
        self.table_length[:used] = np.repeat(by_length, room)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Packed bits, and the bit offset of every CHECKPOINT-th id."""
        length = self.length[ids]
        ends = np.cumsum(length)
        offsets = ends - length
        words = np.zeros((int(ends[-1]) >> 5) + 2 if len(ids) else 0, np.uint64)
        if len(ids):
            spread = self.code[ids] << (np.uint64(64) - (offsets & np.uint64(31)) - length)
            word = (offsets >> np.uint64(5)).astype(np.int64)
            first = np.concatenate([[0], np.nonzero(np.diff(word))[0] + 1])
            words[word[first]] += np.add.reduceat(spread >> np.uint64(32), first)
            words[word[first] + 1] += np.add.reduceat(spread & np.uint64(0xFFFFFFFF), first)
        used = (int(ends[-1]) + 7) // 8 if len(ids) else 0
        return words.astype(">u4").tobytes()[:used], offsets[::CHECKPOINT].astype(np.uint64)

    def decode(self, packed: bytes, count: int, checkpoints: np.ndarray) -> np.ndarray:
        """The ids; raises ValueError for bits that are no code or checkpoints that do not meet."""
        lanes = len(checkpoints)
        if lanes != -(-count // CHECKPOINT):
            raise ValueError("wrong number of checkpoints")
        data = np.frombuffer(packed + bytes(8), np.uint8).astype(np.uint32)
        quads = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
        place = checkpoints.astype(np.int64)
        found = np.zeros((lanes, CHECKPOINT), np.uint32)
        last = count - (lanes - 1) * CHECKPOINT if lanes else 0
        for step in range(min(CHECKPOINT, count)):
            live = lanes if step < last else lanes - 1
            at = place[:live]
            if live and int(at.max()) >= 8 * len(packed):
                raise ValueError("bits end too early")
            key = (quads[at >> 3] >> (32 - self.bits - (at & 7)).astype(np.uint32)) & np.uint32((1 << self.bits) - 1)
            length = self.table_length[key]
            if live and not length.all():
                raise ValueError("bits are no code")
            found[:live, step] = self.table_symbol[key]
            place[:live] += length
        if lanes > 1 and (place[:-1] != checkpoints[1:].astype(np.int64)).any():
            raise ValueError("checkpoints do not meet")
        return found.reshape(-1)[:count]
