"""Two tokenizers side by side: which tokens cover the same bytes.

Each document is encoded by a byte-level BPE (A, of the text with a space before it) and by a
piece model (B, which adds that space itself).  Tokens become byte ranges.  In batches of
documents ``pandas.merge_asof``, keyed by document, finds for the start of every A token the B
token that covers it, and for B tokens that start elsewhere the A token that covers them: a pair
of ranges overlaps exactly if one of them starts within the other, so the union of both
directions is all overlaps, each once.  Bytes where both sides end close a *group*.

How common a pair of ids is takes all documents.  Texts are worked off in *slices* of about
``SLICE`` bytes.  A slice is written with its different pairs and how many of its documents hold
each, and every document with the places of its pairs in that list and how often it has them.
Counts are summed by pair and go back to the slices that asked, pair by pair; so no table of
pairs is ever sent to all tasks, a pair that all documents share is one row of a slice, and no
document is encoded twice.

Rows: null and empty texts have no tokens, nor have texts that one side does not give back byte
for byte (U+2581 reads as a space in B); repeated rows are documents of their own; a null doc_id
stays null; an empty table gives no rows; a very long text is a slice by itself; other columns
are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import SLICE_BYTES, batches, in_python, kept_by, staged, text_of
from postlake.llm.spans import Encoder, gather

SLICE = 8 << 20
_SHIFT = 32
"""An id pair is one number: A's id above, B's below."""


class ByteSide:
    """Byte-level BPE of the ``tokenizers`` library; special tokens in texts are plain text."""

    def __init__(self, path: str):
        self.tool = Encoder(path, limit=1_000_000)
        self.tool.tokenizer.encode_special_tokens = True
        names = [self.tool.tokenizer.id_to_token(i) or "" for i in range(self.tool.size)]
        shown = {c: b for b, c in enumerate(_visible())}
        self.entries = _Entries([bytes(shown[c] for c in name) if all(c in shown for c in name) else name.encode() for name in names])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = self.tool.encode(texts)
        return ids.astype(np.int64), counts


class PieceSide:
    """A ``sentencepiece`` model; it puts the space before a text by itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.tool = SentencePieceProcessor(model_file=path)
        names = [self.tool.id_to_piece(i) for i in range(self.tool.vocab_size())]
        self.entries = _Entries(
            [bytes([int(name[3:5], 16)]) if self.tool.is_byte(i) else name.replace("▁", " ").encode() for i, name in enumerate(names)]
        )

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of texts that begin with the space the model adds."""
        found = self.tool.encode([t[1:].decode() for t in texts], num_threads=1)
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(counts.sum())), counts


class _Entries:
    """The bytes of each id, end to end."""

    def __init__(self, entries: list[bytes]):
        self.bytes = np.frombuffer(b"".join(entries), dtype=np.uint8)
        self.lengths = np.fromiter(map(len, entries), dtype=np.int64, count=len(entries))
        self.starts = np.cumsum(self.lengths) - self.lengths

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.bytes, self.starts[ids], self.lengths[ids])


def _visible() -> list[str]:
    """The character that byte-level BPE shows for each byte."""
    out = [chr(b) for b in range(256)]
    hidden = [b for b in range(256) if not (0x21 <= b < 0x7F or 0xA1 <= b < 0xAD or 0xAE <= b)]
    for k, b in enumerate(hidden):
        out[b] = chr(0x100 + k)
    return out


@dataclass
class Tokens:
    """Tokens of one side of several documents: ids, document and byte range in the joined texts."""

    ids: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray


def _given_back(side: ByteSide | PieceSide, ids: np.ndarray, counts: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Which texts the joined tokens equal."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    doc = np.repeat(np.arange(len(texts)), counts)
    ok = np.bincount(doc, weights=side.entries.lengths[ids], minlength=len(texts)).astype(np.int64) == lengths
    expected = np.frombuffer(b"".join(t for t, good in zip(texts, ok, strict=True) if good), dtype=np.uint8)
    wrong = np.flatnonzero(side.entries.joined(ids[ok[doc]]) != expected)
    ok[np.repeat(np.flatnonzero(ok), lengths[ok])[wrong]] = False
    return ok


def tokens_of(a: ByteSide, b: PieceSide, texts: list[bytes]) -> tuple[Tokens, Tokens]:
    """Both sides of the texts; of those that a side does not give back, none."""
    spaced = [b" " + t for t in texts]
    asked = np.flatnonzero([len(t) > 0 for t in texts])
    given = [spaced[i] for i in asked]
    found = [(side, *side.encode(given)) for side in (a, b)]
    ok = np.logical_and.reduce([_given_back(side, ids, counts, given) for side, ids, counts in found])
    lengths = np.fromiter(map(len, given), dtype=np.int64, count=len(given)) * ok
    base = np.cumsum(lengths) - lengths
    out = []
    for side, ids, counts in found:
        doc = np.repeat(np.arange(len(given)), counts)
        kept = ok[doc]
        ids, doc = ids[kept], doc[kept]
        size = side.entries.lengths[ids]
        end = np.cumsum(size)  # the texts that count lie end to end, so do their tokens
        out.append(Tokens(ids, asked[doc], end - size, end))
    assert not len(out[0].end) or out[0].end[-1] == out[1].end[-1] == base[-1] + lengths[-1]
    return tuple(out)


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b whose byte ranges overlap, each pair once."""

    def covering(tokens: Tokens, rows: np.ndarray, others: Tokens) -> np.ndarray:
        left = pd.DataFrame({"doc": tokens.doc[rows], "at": tokens.start[rows]})
        right = pd.DataFrame({"doc": others.doc, "at": others.start, "row": np.arange(len(others.ids))})
        return pd.merge_asof(left, right, on="at", by="doc")["row"].to_numpy()

    if not len(a.ids):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    all_a = np.arange(len(a.ids))
    later = np.flatnonzero(~np.isin(b.start, a.start, assume_unique=True))
    of_a, of_b = covering(a, all_a, b).astype(np.int64), covering(b, later, a).astype(np.int64)
    return np.concatenate([all_a, of_b]), np.concatenate([of_a, later])


def groups(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the group of each A and of each B token, and the document of each group."""
    ends = np.intersect1d(a.end, b.end, assume_unique=True)
    of_a, of_b = np.searchsorted(ends, a.end), np.searchsorted(ends, b.end)
    doc = np.zeros(len(ends), dtype=np.int64)
    doc[of_a] = a.doc
    return of_a, of_b, doc


class _Writer:
    """Groups as text: ids of A, a bar, ids of B, a semicolon between groups."""

    def __init__(self, n_a: int, n_b: int):
        plain = [f"{i}," for i in range(max(n_a, n_b))]
        self.words = plain + [f"{i}|" for i in range(n_a)] + [f"{i};" for i in range(n_b)]
        self.last_a, self.last_b = len(plain), len(plain) + n_a

    def digests(self, a: Tokens, b: Tokens, n_docs: int) -> list[str]:
        of_a, of_b, _ = groups(a, b)
        last_a = np.append(np.diff(of_a) != 0, True)[: len(of_a)]
        last_b = np.append(np.diff(of_b) != 0, True)[: len(of_b)]
        place_a = np.arange(len(of_a)) + np.searchsorted(of_b, of_a, side="left")
        place_b = np.arange(len(of_b)) + np.searchsorted(of_a, of_b, side="right")
        words = np.empty(len(of_a) + len(of_b), dtype=np.int64)
        words[place_a] = a.ids + self.last_a * last_a
        words[place_b] = b.ids + self.last_b * last_b
        count = np.bincount(a.doc, minlength=n_docs) + np.bincount(b.doc, minlength=n_docs)
        ends = np.cumsum(count).tolist()
        listed, out, start = words.tolist(), [], 0
        for end in ends:
            text = "".join([self.words[w] for w in listed[start:end]])
            out.append(hashlib.sha256(text[:-1].encode()).hexdigest() if text else "")
            start = end
        return out


_tools: dict[tuple[str, str], SimpleNamespace] = {}
kept_by("alignment", _tools.clear)


def _both(byte_bpe: str, piece_bpe: str) -> SimpleNamespace:
    key = (byte_bpe, piece_bpe)
    if key not in _tools:
        a, b = ByteSide(byte_bpe), PieceSide(piece_bpe)
        _tools[key] = SimpleNamespace(a=a, b=b, writer=_Writer(len(a.entries.lengths), len(b.entries.lengths)))
    return _tools[key]


_SLICED = (
    "slice long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "places binary, times binary, pairs array<long>, holders array<int>"
)


def _sliced(docs: DataFrame, byte_bpe: str, piece_bpe: str, slice_bytes: int) -> DataFrame:
    """A row for each document and, with ``pairs``, one for each slice."""
    names = [part.split()[0] for part in _SLICED.split(", ")]

    def finished(number: int, rows: list[tuple], doc: list[np.ndarray], pair: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        n = len(rows)
        pairs, at = np.unique(np.concatenate(pair), return_inverse=True)
        held, times = np.unique(np.concatenate(doc) * max(len(pairs), 1) + at, return_counts=True)
        owner, at = held // max(len(pairs), 1), held % max(len(pairs), 1)
        holders = np.bincount(at, minlength=len(pairs))
        cuts = np.searchsorted(owner, np.arange(n + 1))
        places = [np.diff(at[x:y], prepend=0).astype("<u4").tobytes() for x, y in zip(cuts, cuts[1:], strict=False)]
        counted = [times[x:y].astype("<u4").tobytes() for x, y in zip(cuts, cuts[1:], strict=False)]
        columns = [pa.array([r[k] for r in rows]) for k in range(6)]
        columns[0], columns[5] = columns[0].cast(pa.int64()), columns[5].cast(pa.string())
        none = [pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, number)), *columns, pa.array(places, pa.binary()), pa.array(counted, pa.binary()), *none], names
        )
        ends = pa.array([0, len(pairs)], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(pairs)), pa.ListArray.from_arrays(ends, pa.array(holders.astype(np.int32)))]
        kinds = [pa.int64()] * 5 + [pa.string(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([number]), *(pa.nulls(1, kind) for kind in kinds), *lists], names)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _both(byte_bpe, piece_bpe)
        number = TaskContext.get().partitionId() << 32
        rows, doc, pair, size = [], [], [], 0
        for batch in batches(found):
            texts = batch["text"].to_pylist()
            n = len(texts)
            a, b = tokens_of(tools.a, tools.b, texts)
            at_a, at_b = overlaps(a, b)
            counted = [np.bincount(x, minlength=n).tolist() for x in (a.doc, b.doc, groups(a, b)[2], a.doc[at_a])]
            digests = tools.writer.digests(a, b, n)
            doc.append(a.doc[at_a] + len(rows))
            pair.append((a.ids[at_a] << _SHIFT) | b.ids[at_b])
            rows += zip(batch["doc_id"].to_pylist(), *counted, digests, strict=True)
            size += batch["text"].nbytes
            if size >= slice_bytes:
                yield from finished(number, rows, doc, pair)
                rows, doc, pair, size = [], [], [], 0
                number += 1
        if rows:
            yield from finished(number, rows, doc, pair)

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return in_python(given, run, _SLICED, kind="alignment")


def pair_counts(sliced: DataFrame) -> DataFrame:
    """pair, documents (that hold it) and whether that is the most of its A id."""
    counts = sliced.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p")).groupBy("p.pairs").agg(F.sum("p.holders").alias("documents"))
    counts = staged(counts.withColumnRenamed("pairs", "pair"), "pair-counts")
    of_a = F.shiftright("pair", _SHIFT).alias("a")
    most = counts.groupBy(of_a).agg(F.max("documents").alias("most"))
    both = counts.withColumn("a", of_a).join(most, "a")
    return both.select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


_SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _scored(docs: pa.Table, asked: pa.Table) -> pa.Table:
    """Documents of one slice with the counts of its pairs."""
    place = asked["place"].to_numpy()
    documents, best = (np.zeros(len(place), dtype=np.int64) for _ in range(2))
    documents[place] = asked["documents"].to_numpy()
    best[place] = asked["best"].to_numpy(zero_copy_only=False)
    n_best, count_sum = [], []
    for places, times in zip(docs["places"].to_pylist(), docs["times"].to_pylist(), strict=True):
        at = np.cumsum(np.frombuffer(places, "<u4"), dtype=np.int64)
        n = np.frombuffer(times, "<u4").astype(np.int64)
        n_best.append(int((n * best[at]).sum()))
        count_sum.append(int((n * documents[at]).sum()))
    out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    out = out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))
    return out.append_column("groups_sha256", docs["groups_sha256"])


def aligned(
    docs: DataFrame, byte_bpe: str, piece_bpe: str, *, doc_id: str = "doc_id", text: str = "text", slice_bytes: int = SLICE
) -> DataFrame:
    """Of every document: n_a, n_b, n_groups, n_links, n_best (links whose pair is the most common
    of its A id), count_sum (of the pairs of all links) and groups_sha256."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sliced = staged(_sliced(rows, byte_bpe, piece_bpe, slice_bytes), "aligned")
    listed = sliced.where(F.col("pairs").isNotNull())
    asked = listed.select("slice", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(pair_counts(listed), "pair").select(F.col("slice").alias("of"), "place", "documents", "best")
    found = sliced.where(F.col("pairs").isNull()).drop("pairs", "holders")
    return found.groupBy("slice").cogroup(answers.groupBy("of")).applyInArrow(_scored, _SCORED)


_LINKS = "doc_id long, a_start long, a_end long, a_id long, b_start long, b_end long, b_id long, group long"


def links(docs: DataFrame, byte_bpe: str, piece_bpe: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every overlap itself: byte ranges in the text with its space, ids and group (from 0)."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _both(byte_bpe, piece_bpe)
        for batch in batches(found, size=SLICE_BYTES // 4):
            a, b = tokens_of(tools.a, tools.b, batch["text"].to_pylist())
            at_a, at_b = overlaps(a, b)
            of_a, _, owner = groups(a, b)
            base = np.full(batch.num_rows, 0)
            base[a.doc[::-1]] = a.start[::-1]  # the first token of a document is written last
            before = np.searchsorted(owner, np.arange(batch.num_rows))
            doc = a.doc[at_a]
            order = np.lexsort((b.start[at_b], a.start[at_a]))
            at_a, at_b, doc = at_a[order], at_b[order], doc[order]
            shift = base[doc]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(doc)),
                    *(pa.array(x) for x in (a.start[at_a] - shift, a.end[at_a] - shift, a.ids[at_a])),
                    *(pa.array(x) for x in (b.start[at_b] - shift, b.end[at_b] - shift, b.ids[at_b])),
                    pa.array(of_a[at_a] - before[doc]),
                ],
                [part.split()[0] for part in _LINKS.split(", ")],
            )

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return in_python(given, run, _LINKS, kind="alignment")
