"""Substring dedup by relative Lempel-Ziv factors.

The reference of a document is every document with a smaller doc_id, cut into *blocks* by
content: a window of ``WINDOW`` words belongs to the block that its anchor names, the
smallest hash among its runs of ``ANCHOR`` words.  Equal windows have equal anchors, so
each window of a document can only be found in one block, and dealing windows out by
anchor lets every document be factored against every block without meeting them all.

Within a block an index over the windows (anchor, hash) gives the earliest holder of each.
A document is factored greedily: a factor grows as long as the next window's holder
continues where it left off.  A factor ends at the change of the holder or of the block;
as every window there is looked up by itself, windows that straddle two factors are found
too, and a factor is never shorter than a window.  Words covered by factors are duplicates.

Each task first resolves its own rows: of equal windows only those of the smallest doc_id
go on to the exchange, so a passage of a window or more that a third of all documents
share reaches a block once from each chunk.  A shorter run that many share is the anchor of
windows that all differ.  So windows are first counted by slices of anchors (partly summed
in each task), and those of a slice with far more than its share are dealt out by their own
hash as well: equal windows still meet, and the rest of the group is split over all blocks.
Windows are compared by 112 hashed bits.

Rows: null texts have no words; texts shorter than a window are kept whole; rows with a
null doc_id are neither compared nor changed; rows of one doc_id are not copies of each
other; an empty table gives no rows.  Columns other than the id and the text are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import batches, in_python, mixed, partitions_of, span_hashes, staged, text_key, text_of, word_hashes

WINDOW = 50
ANCHOR = 10
CHUNK_WORDS = 400_000
"""Words a task resolves at once before the exchange."""
BLOCKS_PER_PARTITION = 4
SLICES_PER_BLOCK = 64
HOT_WINDOWS = 20_000
"""Slices of anchors with fewer windows are never split."""
_FACTOR = "doc_id long, key int, start int, windows int, ref_doc long, ref_start int"
_RUN = np.dtype([("anchor", "<u8"), ("doc", "<i8"), ("key", "<i4"), ("start", "<i4"), ("count", "<i4")])
_DONE = np.dtype([("doc", "<i8"), ("key", "<i4"), ("start", "<i4"), ("count", "<i4"), ("ref", "<i8"), ("ref_start", "<i4")])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows: text number, start within the text, anchor, hash."""
    words, first = word_hashes(texts)
    sizes = np.maximum(np.diff(first) - WINDOW + 1, 0)
    which = np.repeat(np.arange(len(texts)), sizes)
    start = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    if not len(which):
        return which, start, words[:0], words[:0]
    at = np.arange(len(words) - ANCHOR + 1)
    anchors = _least(span_hashes(words, at, at + ANCHOR), WINDOW - ANCHOR + 1)
    place = first[which] + start
    return which, start, anchors[place], span_hashes(words, place, place + WINDOW) >> np.uint64(16)


def _resolved(anchor: np.ndarray, code: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window the smallest doc that holds it, where that one holds it, and whether
    it is smaller than the window's own."""
    if not len(doc):
        return doc, start, np.zeros(0, dtype=bool)
    order = np.argsort(anchor ^ (code << np.uint64(16)), kind="stable")
    a, c = anchor[order], code[order]
    begin = np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])])
    group = np.cumsum(begin) - 1
    edges = np.flatnonzero(begin)
    least = np.minimum.reduceat(doc[order], edges)[group]
    here = np.where(doc[order] == least, start[order], np.iinfo(np.int32).max)
    where = np.minimum.reduceat(here, edges)[group]
    ref, ref_start = np.empty_like(doc), np.empty_like(start)
    ref[order], ref_start[order] = least, where
    return ref, ref_start, ref < doc


def _factors(doc, key, start, ref, ref_start) -> np.ndarray:
    """Windows in order of text and start, joined while holder and text go on together."""
    out = np.zeros(0, dtype=_DONE)
    if len(doc):
        goes_on = (
            (doc[1:] == doc[:-1]) & (key[1:] == key[:-1]) & (start[1:] == start[:-1] + 1)
            & (ref[1:] == ref[:-1]) & (ref_start[1:] == ref_start[:-1] + 1)
        )
        edges = np.concatenate([[0], np.flatnonzero(~goes_on) + 1])
        out = np.zeros(len(edges), dtype=_DONE)
        for name, column in (("doc", doc), ("key", key), ("start", start), ("ref", ref), ("ref_start", ref_start)):
            out[name] = column[edges]
        out["count"] = np.diff(np.append(edges, len(doc)))
    return out


def _slice(anchor: np.ndarray, slices: int) -> np.ndarray:
    return (anchor % np.uint64(slices)).astype(np.int64)


def _sent(blocks: int, hot: np.ndarray, ids: np.ndarray, keys: np.ndarray, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """What a chunk of documents sends to each block: runs of unresolved windows and their
    hashes, and the factors that the chunk could already make.  ``hot`` tells for each slice
    of anchors whether its windows are dealt out one by one."""
    which, start, anchor, code = _windows(texts)
    if not len(which):
        return
    start = start.astype(np.int32)
    doc, key = ids[which], keys[which]
    ref, ref_start, found = _resolved(anchor, code, doc, start)
    done = _factors(doc[found], key[found], start[found], ref[found], ref_start[found])
    left = np.flatnonzero(~found)
    which, start, anchor, code = which[left], start[left], anchor[left], code[left]
    cut = np.ones(len(left), dtype=bool)
    spread = hot[_slice(anchor, len(hot))]
    route = np.where(spread, mixed(anchor ^ code), anchor)
    cut[1:] = (which[1:] != which[:-1]) | (start[1:] != start[:-1] + 1) | (anchor[1:] != anchor[:-1]) | spread[1:] | spread[:-1]
    begin = np.flatnonzero(cut)
    runs = np.zeros(len(begin), dtype=_RUN)
    for name, column in (("anchor", anchor), ("doc", ids[which]), ("key", keys[which]), ("start", start)):
        runs[name] = column[begin]
    runs["count"] = np.diff(np.append(begin, len(left)))
    block = (route[begin] % np.uint64(blocks)).astype(np.int64)
    by_block = np.argsort(block, kind="stable")
    of_window = np.argsort(np.repeat(block, runs["count"]), kind="stable")
    codes = code[of_window].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    runs, block = runs[by_block], block[by_block]
    edges = np.searchsorted(block, np.arange(blocks + 1))
    ends = np.concatenate([[0], np.cumsum(runs["count"])])[edges]
    home = (done["doc"] % blocks).astype(np.int64)
    rows = []
    for b in range(blocks):
        mine = done[home == b]
        if edges[b] < edges[b + 1] or len(mine):
            rows.append((b, runs[edges[b] : edges[b + 1]].tobytes(), codes[ends[b] : ends[b + 1]].tobytes(), mine.tobytes()))
    if rows:
        b, r, c, d = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(b, pa.int32()), pa.array(r, pa.binary()), pa.array(c, pa.binary()), pa.array(d, pa.binary())],
            ["block", "runs", "codes", "done"],
        )


def _table(rows: np.ndarray) -> pa.RecordBatch:
    names = ("doc", "key", "start", "count", "ref", "ref_start")
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(rows[n])) for n in names],
        ["doc_id", "key", "start", "windows", "ref_doc", "ref_start"],
    )


def _factored(runs: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """All factors of one block."""
    wide = np.zeros((len(codes) // 6, 8), dtype=np.uint8)
    wide[:, :6] = codes.reshape(-1, 6)
    code = wide.view("<u8").reshape(-1)
    count = runs["count"]
    within = np.arange(len(code), dtype=np.int32) - np.repeat(np.cumsum(count) - count, count).astype(np.int32)
    doc, key, anchor = (np.repeat(runs[n], count) for n in ("doc", "key", "anchor"))
    start = np.repeat(runs["start"], count) + within
    ref, ref_start, found = _resolved(anchor, code, doc, start)
    return _factors(doc[found], key[found], start[found], ref[found], ref_start[found])


def _hot(rows: DataFrame, slices: int, blocks: int) -> np.ndarray:
    """Slices of anchors with more than an eighth of a block's share of all windows: at most
    eight for each block."""

    def count(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(slices, dtype=np.int64)
        for batch in batches(found):
            seen += np.bincount(_slice(_windows(batch["text"].to_pylist())[2], slices), minlength=slices)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], ["slice", "n"])

    counts = in_python(rows.select("text"), count, "slice int, n long").groupBy("slice").agg(F.sum("n").alias("n"))
    counts = staged(counts, "anchor-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    many = counts.where(F.col("n") > max(HOT_WINDOWS, total // (8 * blocks))).select("slice").collect()
    out = np.zeros(slices, dtype=bool)
    out[[r["slice"] for r in many]] = True
    return out


def dealt(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(block, runs, codes, done): what each chunk of documents sends to each block."""
    blocks = BLOCKS_PER_PARTITION * partitions_of(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), _key(text).alias("key"), text_of(text).alias("text")
    ).where(F.col("doc_id").isNotNull())
    hot = _hot(rows, SLICES_PER_BLOCK * blocks, blocks)

    def send(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys, texts, size = [], [], [], 0
        for batch in batches(found):
            ids.append(batch["doc_id"].to_numpy())
            keys.append(batch["key"].to_numpy())
            more = batch["text"].to_pylist()
            texts += more
            size += sum(map(len, more))
            if size >= 6 * CHUNK_WORDS:
                yield from _sent(blocks, hot, np.concatenate(ids), np.concatenate(keys), texts)
                ids, keys, texts, size = [], [], [], 0
        if texts:
            yield from _sent(blocks, hot, np.concatenate(ids), np.concatenate(keys), texts)

    return in_python(rows, send, "block int, runs binary, codes binary, done binary")


def factors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, key (of the text, for rows of one doc_id), start, windows, ref_doc, ref_start:
    ``windows`` windows from word ``start`` on lie in document ``ref_doc`` < doc_id."""

    def factor(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, runs, codes = None, [], []
        for batch in found:
            for row in batch.to_pylist():
                if runs and row["block"] != here:
                    yield _table(_factored(np.concatenate(runs), np.concatenate(codes)))
                    runs, codes = [], []
                here = row["block"]
                runs.append(np.frombuffer(row["runs"], dtype=_RUN))
                codes.append(np.frombuffer(row["codes"], dtype=np.uint8))
                if row["done"]:
                    yield _table(np.frombuffer(row["done"], dtype=_DONE))
        if runs:
            yield _table(_factored(np.concatenate(runs), np.concatenate(codes)))

    sent = dealt(docs, doc_id, text).repartition(partitions_of(docs.sparkSession), "block")
    return in_python(sent.sortWithinPartitions("block"), factor, _FACTOR)


def _key(text: str):
    return F.shiftright(text_key(text), 32).cast("int")


def without_factors(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and the kept words, joined by one space."""
    spans = found.groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _key(text).alias("key"), text_of(text).alias("text"))
    joined = rows.join(spans, ["doc_id", "key"], "left").select("doc_id", "text", "spans.start", "spans.windows")

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(found):
            out = []
            columns = (batch[c].to_pylist() for c in ("text", "start", "windows"))
            for body, starts, windows in zip(*columns, strict=True):
                words = body.split()
                total = len(words)
                if starts:
                    edge = np.zeros(total + 1, dtype=np.int64)
                    begin = np.array(starts, dtype=np.int64)
                    np.add.at(edge, begin, 1)
                    np.subtract.at(edge, begin + np.array(windows, dtype=np.int64) + WINDOW - 1, 1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]
                out.append((total, total - len(words), b" ".join(words).decode()))
            n, removed, kept = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return in_python(joined, run, "doc_id long, n_words long, n_removed long, kept string")


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document without the words that lie in a window of a smaller doc_id."""
    return without_factors(docs, factors(docs, doc_id, text), doc_id, text)




def oracle() -> str:
    """DuckDB SQL of ``without_copies`` with a digest of what is left: every window of every
    document beside the smallest document that holds it."""
    return r"""WITH texts AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    starts AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM texts),
    windows AS (SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS win FROM starts),
    copied AS (SELECT r, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY win) < doc_id),
    gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS k FROM copied),
    words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM texts),
    kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS rest FROM words ANTI JOIN gone USING (r, k) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(rest, '')) AS kept_sha256 FROM texts LEFT JOIN kept USING (r)"""
