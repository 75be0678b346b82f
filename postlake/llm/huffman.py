"""Length-limited canonical Huffman codes over arrays of ids."""

from __future__ import annotations

import numpy as np

TABLE_BITS = 16
"""Longest code (and size of the decoding table) unless the alphabet needs more."""


def code_lengths(counts: np.ndarray, limit: int = TABLE_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; 0 for unused ids."""
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(len(used) - 1).bit_length())
    used = used[np.lexsort((used, counts[used]))]
    weights = counts[used].astype(np.int64)
    level, leaf_flags = weights, [np.ones(len(used), dtype=bool)]
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        order = np.argsort(both, kind="stable")
        leaf_flags.append(order < len(weights))
        level = both[order]
    take, depth = 2 * len(used) - 2, np.zeros(len(used), dtype=np.uint8)
    for flags in reversed(leaf_flags):
        leaves = int(np.count_nonzero(flags[:take]))
        depth[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[used] = depth
    return lengths


class Codes:
    """Canonical codes: ordered by length, then by id; the lengths alone define them."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        used = used[np.lexsort((used, lengths[used]))]
        self.bits = int(lengths.max(initial=0)) or 1
        widths = np.int64(1) << (self.bits - self.lengths[used])
        first = np.cumsum(widths) - widths
        self.codes = np.zeros(len(lengths), dtype=np.int64)
        self.codes[used] = first >> (self.bits - self.lengths[used])
        self.ids_at = np.zeros(1 << self.bits, dtype=np.uint32)
        self.ids_at[: int(widths.sum())] = np.repeat(used, widths)
        self.bits_at = self.lengths[self.ids_at] if len(used) else self.ids_at.astype(np.int64)

    def encode(self, ids: np.ndarray, counts: np.ndarray, step: int) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Runs of ids, each beginning at a whole byte: payload, first byte of each run (and
        the end), and the bit offset of every ``step``-th id of each run within the run."""
        length = self.lengths[ids]
        bits_before = np.concatenate([[0], np.cumsum(length)])
        first = np.concatenate([[0], np.cumsum(counts)])
        run_bits = np.diff(bits_before[first])
        run_bytes = np.concatenate([[0], np.cumsum((run_bits + 7) // 8)])
        shift = np.repeat(8 * run_bytes[:-1] - bits_before[first[:-1]], counts)
        at = bits_before[:-1] + shift
        out = np.zeros(int(run_bytes[-1]) // 4 + 3, dtype=np.uint32)
        if len(ids):
            word = at >> 5
            value = self.codes[ids].astype(np.uint64) << (64 - length - (at & 31)).astype(np.uint64)
            begin = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
            value, word = np.bitwise_or.reduceat(value, begin), word[begin]
            out[word] |= (value >> np.uint64(32)).astype(np.uint32)
            out[word + 1] |= value.astype(np.uint32)
        lanes = -(-counts // step)
        place = np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        marks = at[np.repeat(first[:-1], lanes) + step * place] - np.repeat(8 * run_bytes[:-1], lanes)
        return out.astype(">u4").tobytes()[: int(run_bytes[-1])], run_bytes, marks

    def decode(self, payload: bytes, marks: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """``counts[i]`` ids from each bit offset ``marks[i]``, all offsets side by side."""
        buf = payload + bytes(8)
        words = np.ndarray((len(buf) - 3,), dtype=">u4", buffer=buf, strides=(1,))
        order = np.argsort(-counts, kind="stable")
        at, left = marks[order].astype(np.int64), counts[order]
        target = (np.cumsum(counts) - counts)[order]
        out = np.zeros(int(counts.sum()), dtype=np.uint32)
        shift, mask = 32 - self.bits, (1 << self.bits) - 1
        active = len(left)
        for i in range(int(left.max(initial=0))):
            active = int(np.searchsorted(-left[:active], -i, side="left"))
            here = at[:active]
            peek = (words[here >> 3].astype(np.int64) >> (shift - (here & 7))) & mask
            out[target[:active] + i] = self.ids_at[peek]
            here += self.bits_at[peek]
        return out
