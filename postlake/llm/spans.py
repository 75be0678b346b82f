"""Exact tokenizing of whole texts in reusable pieces.

A *safe cut* is a place where any text may be split without changing its tokens:
before a lone space, and around a lone line feed, between characters that are not
white space, and between a letter (of ASCII or Latin-1) and ASCII punctuation other than
``<|>``.  Both public BPE files restart there: no pre-token reaches over it, no normalizer
joins across it, and no special token holds such a place.
Where the characters next to a space might be white space themselves no cut is made;
the piece is longer then, never wrong.

Pieces are known by a 64-bit hash of their bytes.  The caches below are bounded, so
at most a few million pieces meet: two of them collide with probability below 1e-6.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np

from postlake.llm.common import kept_by, span_hashes

#: Lead bytes of the blocks that hold all white space beyond ASCII.
_LEADS = (0xC2, 0xE1, 0xE2, 0xE3)
_LETTER, _STOP = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_LETTER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_STOP[list(b"!\"#$%&'()*+,-./:;=?@[\\]^_`{}~")] = True
_LATIN = np.zeros(256, dtype=bool)  # second bytes of Latin-1 letters, after 0xC3
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
_AT_ONCE = 8192
"""Pieces the library encodes in one call: what it returns is far larger than the ids."""


def safe_cuts(buf: np.ndarray) -> np.ndarray:
    """Positions where ``buf`` (UTF-8 bytes) may be cut; texts must be cut apart besides."""
    n = len(buf)
    if n < 3:
        return np.zeros(0, dtype=np.int64)
    starts_word = np.ones(256, dtype=bool)  # as the byte after
    starts_word[:0x21] = starts_word[0x7F] = False
    starts_word[list(_LEADS)] = False
    gaps = np.flatnonzero((buf[1:-1] == 0x20) | (buf[1:-1] == 0x0A)) + 1
    before, two, three = buf[gaps - 1], buf[gaps - 2], buf[gaps - 3]
    ascii_end = (before > 0x20) & (before < 0x7F)
    two_bytes = (before >= 0x80) & (two >= 0xC3) & (two <= 0xDF) & (gaps >= 2)
    three_bytes = (
        (before >= 0x80) & (two >= 0x80) & (two < 0xC0) & (three >= 0xE0) & (three <= 0xEF)
        & ~np.isin(three, _LEADS) & (gaps >= 3)
    )
    safe = (ascii_end | two_bytes | three_bytes) & starts_word[buf[gaps + 1]]
    gaps = gaps[safe]
    cut = np.zeros(n, dtype=bool)
    cut[gaps] = True
    cut[gaps[buf[gaps] == 0x0A] + 1] = True
    stops = np.flatnonzero(_STOP[buf])
    stops = stops[stops > 0]
    before = buf[stops - 1]
    cut[stops[_LETTER[before] | (_LATIN[before] & (buf[stops - 2] == 0xC3) & (stops > 1))]] = True
    return np.flatnonzero(cut)


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs flat[start:start + length], one after the other."""
    total = int(lengths.sum())
    if not total:
        return flat[:0]
    ends = np.cumsum(lengths)
    index = np.arange(total, dtype=np.int64)
    index += np.repeat(starts - (ends - lengths), lengths)
    return flat[index]


class SpanCache:
    """Hash → run of ids, in flat arrays; emptied when it would hold over ``limit`` runs."""

    def __init__(self, limit: int = 1_000_000):
        self.limit = limit
        self.mask = (1 << (2 * limit - 1).bit_length()) - 1
        self.clear()

    def clear(self) -> None:
        self.rows = 0
        self.used = 0
        self.table = np.full(self.mask + 1, -1, dtype=np.int32)
        self.keys = np.zeros(1024, dtype=np.uint64)
        self.starts = np.zeros(1024, dtype=np.int64)
        self.lengths = np.zeros(1024, dtype=np.int64)
        self.ids = np.zeros(1024, dtype=np.uint32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 where there is none."""
        slots = (hashes & np.uint64(self.mask)).astype(np.int64)
        out = self.table[slots]
        open_ = np.flatnonzero((out >= 0) & (self.keys[out] != hashes))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            out[open_] = row = self.table[slots[open_]]
            open_ = open_[(row >= 0) & (self.keys[row] != hashes[open_])]
        return out

    def _grown(self, name: str, need: int) -> None:
        old = getattr(self, name)
        if need > len(old):
            new = np.zeros(max(need, 2 * len(old)), dtype=old.dtype)
            new[: len(old)] = old
            setattr(self, name, new)

    def add(self, hashes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """New, distinct hashes with their ids laid end to end."""
        rows = np.arange(self.rows, self.rows + len(hashes), dtype=np.int32)
        for name in ("keys", "starts", "lengths"):
            self._grown(name, self.rows + len(hashes))
        self._grown("ids", self.used + len(ids))
        self.keys[rows] = hashes
        self.starts[rows] = self.used + np.cumsum(lengths) - lengths
        self.lengths[rows] = lengths
        self.ids[self.used : self.used + len(ids)] = ids
        self.rows += len(hashes)
        self.used += len(ids)
        slots = (hashes & np.uint64(self.mask)).astype(np.int64)
        while len(rows):
            free = self.table[slots] < 0
            self.table[slots[free]] = rows[free]
            left = self.table[slots] != rows
            rows, slots = rows[left], (slots[left] + 1) & self.mask

    def full(self, more: int) -> bool:
        return self.rows + more > self.limit

    def runs(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these rows end to end, and how many each has."""
        lengths = self.lengths[rows]
        return gather(self.ids, self.starts[rows], lengths), lengths


def _visible() -> np.ndarray:
    """Byte-level BPE writes each byte as a visible character: those that have one as
    themselves, the others from U+0100 on."""
    out = np.arange(256, dtype="<u2")
    hidden = [b for b in range(256) if not (0x21 <= b < 0x7F or 0xA1 <= b < 0xAD or 0xAE <= b)]
    out[hidden] = 0x100 + np.arange(len(hidden))
    return out


_VISIBLE = _visible()


class Encoder:
    """A tokenizer of the ``tokenizers`` library with a cache of pieces between safe cuts."""

    def __init__(self, path: str, limit: int = 2_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cache = SpanCache(limit)
        self.reads = self._reads_words()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)

    def library(self, pieces: list[str]) -> Iterator[list[int]]:
        for start in range(0, len(pieces), _AT_ONCE):
            for e in self.tokenizer.encode_batch_fast(pieces[start : start + _AT_ONCE], add_special_tokens=False):
                yield e.ids

    def _reads_words(self) -> str | None:
        """Whether the file's normalizer and pre-tokenizer leave a word of Latin letters whole
        ("spaced": with the space before it; "lowered": in lower case, without).  The BPE
        model is asked for such words directly."""
        state = json.loads(self.tokenizer.to_str())
        before, split = state["normalizer"], state["pre_tokenizer"] or {}
        if before is None and split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]:
            return "spaced"
        kinds = [n["type"] for n in (before or {}).get("normalizers", [])]
        steps = [s.get("pattern", {}).get("Regex", "") for s in split.get("pretokenizers", [])]
        if kinds == ["NFC", "Replace", "Lowercase"] and len(steps) == 2 and "|[\\p{L}]+|" in steps[0]:
            return "lowered"
        return None

    def new(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
        """Ids of pieces met for the first time, in their order."""
        lengths = ends - starts
        flat = gather(buf, starts, lengths)
        to = np.cumsum(lengths)
        at = to - lengths
        plain = np.zeros(len(at), dtype=bool)
        if self.reads:
            second = _LATIN[flat]
            second[1:] &= flat[:-1] == 0xC3
            letter = _LETTER[flat] | second
            letter[:-1] |= second[1:]
            before = np.concatenate([[0], np.cumsum(letter)])
            spaced = (flat[at] == 0x20).astype(np.int64)
            plain = (before[to] - before[at + spaced] == lengths - spaced) & (lengths > spaced)
        words = flat
        if self.reads == "lowered":
            upper = ((flat >= 0x41) & (flat <= 0x5A)) | (second & (flat < 0x9F))
            words, at = flat + np.uint8(0x20) * upper, np.where(plain, at + spaced, at)
        text = _VISIBLE[words].tobytes().decode("utf-16-le")
        raw = flat.tobytes()
        rows = list(zip(at.tolist(), to.tolist(), plain.tolist(), strict=True))
        rest = self.library([raw[a:b].decode() for a, b, is_word in rows if not is_word])
        tokenize = self.tokenizer.model.tokenize
        return [[t.id for t in tokenize(text[a:b])] if is_word else next(rest) for a, b, is_word in rows]

    def pieces(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces buf[start:end] end to end, and how many each piece has."""
        hashes = span_hashes(buf, starts, ends)
        rows = self.cache.find(hashes)
        new = np.flatnonzero(rows < 0)
        if len(new):
            if self.cache.full(len(new)):
                self.cache = SpanCache(max(self.cache.limit, len(hashes)))
                new = np.arange(len(hashes))
            kinds, first = np.unique(hashes[new], return_index=True)
            at = new[first]
            found = self.new(buf, starts[at], ends[at])
            lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            flat = np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(lengths.sum()))
            self.cache.add(kinds, flat, lengths)
            rows = self.cache.find(hashes)
        return self.cache.runs(rows)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts end to end, and how many each text has."""
        buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
        begin = np.cumsum([0, *map(len, texts)])
        cut = np.zeros(len(buf) + 1, dtype=bool)
        cut[safe_cuts(buf)] = True
        cut[begin] = True
        cuts = np.flatnonzero(cut)
        starts, ends = cuts[:-1], cuts[1:]
        ids, lengths = self.pieces(buf, starts, ends)
        before = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(before[np.searchsorted(cuts, begin)])


_encoders: dict[str, Encoder] = {}
kept_by("encoder", _encoders.clear)


def encoder(path: str) -> Encoder:
    """One per worker process and file; tasks that follow each other share its cache."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
