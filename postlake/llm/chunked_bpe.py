"""BPE by content-defined chunks that are encoded once.

A rolling hash over ``ROLL`` bytes cuts every text into chunks of about ``CHUNK`` bytes, so
documents that share a passage share its chunks wherever it stands.  Of a chunk only the
inside is encoded for reuse: from its first to its last safe cut (see ``spans``) that its
own bytes decide.  What lies between two insides is the join.  The join is repaired by
encoding it again as one text; as it begins and ends at safe cuts, its ids and those of
both neighbours then agree with the encoding of the whole text, which the tests check
against the library.  A chunk without a safe cut becomes part of one longer join.

Documents with common lines are sent to the same task (by the smallest hash of a line), so
a chunk of theirs is encoded once; routes that hold more than a fair part of all rows are
dealt out further.  Decoding writes the vocabulary entry of each id, separated by spaces.

Rows: null and empty texts have no ids and decode to the empty text; repeated rows are
encoded alike; an empty table gives no rows.  Columns other than the id and the text are
left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import batches, in_python, kept_by, partitions_of, span_hashes, text_of
from postlake.llm.spans import Encoder, SpanCache, encoder, safe_cuts

ROLL = 16
CHUNK = 128
CHUNKS_KEPT = 500_000
_TOKENS = "doc_id long, n_tokens long, ids binary"


def chunk_cuts(buf: np.ndarray) -> np.ndarray:
    """Places where the rolling hash of the last ROLL bytes ends a chunk, between characters."""
    at = np.arange(max(len(buf) - ROLL, 0))
    ends = at[span_hashes(buf, at, at + ROLL) % np.uint64(CHUNK) == 0] + ROLL
    return ends[(buf[ends] & 0xC0) != 0x80]


def _put(out: np.ndarray, starts: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> None:
    """Lay runs of values, end to end, at the given starts."""
    ends = np.cumsum(lengths)
    out[np.arange(len(values)) + np.repeat(starts - (ends - lengths), lengths)] = values


class ChunkEncoder:
    def __init__(self, tool: Encoder, limit: int = CHUNKS_KEPT):
        self.tool = tool
        self.chunks = SpanCache(limit)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts end to end, and how many each text has."""
        buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
        begin = np.cumsum([0, *map(len, texts)])
        marked = np.zeros(len(buf) + 1, dtype=bool)
        marked[safe_cuts(buf)] = True
        inner = np.flatnonzero(marked)
        marked[begin] = True
        cuts = np.flatnonzero(marked)
        units, unit_ends = cuts[:-1], cuts[1:]
        marked[:] = False
        marked[chunk_cuts(buf)] = True
        marked[begin] = True
        edges = np.flatnonzero(marked)
        # The inside of each chunk; a safe cut looks at four bytes before and two after it.
        low = np.searchsorted(inner, edges[:-1] + 4)
        high = np.searchsorted(inner, edges[1:] - 2, side="right") - 1
        has = low < high
        starts, ends = inner[low[has]], inner[high[has]]
        hashes = span_hashes(buf, edges[:-1][has], edges[1:][has])
        if self.chunks.full(len(hashes)):
            self.chunks = SpanCache(max(self.chunks.limit, len(hashes)))
        new = np.flatnonzero(self.chunks.find(hashes) < 0)
        kinds, first = np.unique(hashes[new], return_index=True)
        fresh = new[first]
        # Units to encode now: those inside new chunks, and those of the joins.
        inside = np.searchsorted(starts, units, side="right") - 1
        held = (inside >= 0) & (units < ends[np.maximum(inside, 0)]) if len(starts) else np.zeros(len(units), dtype=bool)
        if len(fresh):
            is_fresh = np.zeros(len(starts), dtype=bool)
            is_fresh[fresh] = True
            mine = held & is_fresh[np.maximum(inside, 0)]
            ids, counts = self.tool.pieces(buf, units[mine], unit_ends[mine])
            per_chunk = np.bincount(inside[mine], weights=counts, minlength=len(starts)).astype(np.int64)
            order = np.argsort(fresh)  # the ids lie in the order of the text
            self.chunks.add(kinds[order], ids, per_chunk[fresh[order]])
        inner_ids, inner_counts = self.chunks.runs(self.chunks.find(hashes))
        join_ids, join_counts = self.tool.pieces(buf, units[~held], unit_ends[~held])
        place = np.concatenate([starts, units[~held]])
        counts = np.concatenate([inner_counts, join_counts])
        order = np.argsort(place, kind="stable")
        at = np.empty(len(place), dtype=np.int64)
        at[order] = np.cumsum(counts[order]) - counts[order]
        out = np.empty(int(counts.sum()), dtype=np.uint32)
        _put(out, at[: len(starts)], inner_counts, inner_ids)
        _put(out, at[len(starts) :], join_counts, join_ids)
        before = np.concatenate([[0], np.cumsum(counts[order])])
        return out, np.diff(before[np.searchsorted(place[order], begin)])


_chunkers: dict[str, ChunkEncoder] = {}
kept_by("encoder", _chunkers.clear)


def chunker(path: str) -> ChunkEncoder:
    if path not in _chunkers:
        _chunkers[path] = ChunkEncoder(encoder(path))
    return _chunkers[path]


def _route(text: str) -> Column:
    """The smallest hash of a line: texts with common lines mostly agree on it."""
    return F.coalesce(F.array_min(F.transform(F.split(text, "\n"), lambda line: F.xxhash64(line))), F.lit(0))


def together(rows: DataFrame) -> DataFrame:
    """(doc_id, text) dealt out so that documents with common lines meet."""
    parts = partitions_of(rows.sparkSession)
    routed = rows.withColumn("route", _route("text"))
    fair = max(1, rows.count() // (4 * parts))
    # Fewer than 4 * parts routes can hold more than that share of all rows.
    sizes = routed.groupBy("route").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > fair)
    hot = [r.route for r in sizes.collect()]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(parts)) if hot else F.lit(0)
    spread = F.when(F.col("route").isin(hot), salt).otherwise(0) if hot else F.lit(0)
    return routed.repartition(parts, "route", spread).select("doc_id", "text")


def _dealt(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return together(rows).select("doc_id", text_of().alias("text"))


def _runs(tool: ChunkEncoder, texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    ids, counts = tool.encode(texts)
    raw, ends = ids.astype("<u4").tobytes(), np.cumsum(counts)
    return counts, [raw[4 * a : 4 * b] for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]


def encoded(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of every whole text."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = chunker(tokenizer)
        for batch in batches(found):
            counts, runs = _runs(tool, batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(runs, pa.binary())], ["doc_id", "n_tokens", "ids"]
            )

    return in_python(_dealt(docs, doc_id, text), run, _TOKENS, kind="encoder")


def _vocabulary(tokenizer: str) -> list[str]:
    tool = encoder(tokenizer).tokenizer
    return [tool.id_to_token(i) or "" for i in range(tool.get_vocab_size(with_added_tokens=True))]


def _text(entries: list[str], raw: bytes) -> str:
    return " ".join(map(entries.__getitem__, np.frombuffer(raw, "<u4").tolist()))


def decoded(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """``tokens`` with the text of their ids, special tokens included.

    For tokenizers whose file names no decoder: the entries, joined by one space."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _vocabulary(tokenizer)
        for batch in batches(found, "ids"):
            texts = [_text(entries, x) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    return in_python(tokens.select("doc_id", "n_tokens", "ids"), run, f"{_TOKENS}, text string", kind="encoder")


def round_trip(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encoded, decoded from the ids again and digested in one pass: doc_id, n_tokens,
    ids_sha256 (decimal ids joined by one space) and decoded_sha256."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, entries = chunker(tokenizer), _vocabulary(tokenizer)
        decimal = [str(i) for i in range(len(entries))]
        for batch in batches(found):
            counts, runs = _runs(tool, batch["text"].to_pylist())
            digest = lambda words: pa.array([hashlib.sha256(_text(words, x).encode()).hexdigest() for x in runs], pa.string())  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), digest(decimal), digest(entries)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return in_python(_dealt(docs, doc_id, text), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", kind="encoder")
