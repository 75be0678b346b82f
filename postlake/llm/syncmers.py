"""Document fingerprints from closed syncmers.

A run of ``K`` characters is a closed syncmer if the smallest hash among its runs of ``S``
characters lies at its first or last place.  Whether a run is chosen depends on its own
characters alone, so an edit elsewhere moves no anchor.  A fingerprint is the ``ANCHORS``
chosen runs with the smallest hashes, written in text order as 8 hexadecimal digits each:
a sample that two texts draw alike.

Two fingerprints are compared by position: anchors of both that are small enough to be in
either sample are matched, and those on the longest chain that ascends in both texts count,
as a share of all such anchors (1 for equal texts, 0 without a common anchor).

``with_neighbours`` deals texts out by ranges of doc_id, each text once; a range also gets
the first document of the next range, so the successor of every document is at hand.

Rows: null is empty; the empty text has the empty fingerprint, like itself (1) and nothing
else (0); a text without a syncmer has one anchor made of the whole text; null doc_ids come
first, rows of one doc_id are ordered by text; the only row is its own successor; an empty
table gives no rows.  Columns other than the id and the text are left out.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import SLICE_BYTES, dealt_by_range, in_python, mixed, partitions_of, range_bucket, range_splits, span_hashes

S = 8
K = 2 * S
ANCHORS = 64
SHARE = 8
_OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _limit(share: int) -> int:
    """The largest hash that is always kept."""
    return (1 << 32) // share - 1


def sketches(texts: list[str], share: int = SHARE) -> list[list[int]]:
    """The anchors of each text, in text order."""
    raw = [t.encode("utf-32-le", "surrogatepass") for t in texts]
    points = np.frombuffer(b"".join(raw), dtype="<u4")
    sizes = np.array([len(r) // 4 for r in raw], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    out: list[list[int]] = [[] for _ in texts]
    if len(points) >= K:
        at = np.arange(len(points) - S + 1)
        small = span_hashes(points, at, at + S)
        least = small
        for step in (1, 2, 4, 1):  # 2, 4, 8, then 9 = K - S + 1 neighbours
            least = np.minimum(least[:-step], least[step:])
        starts = np.flatnonzero((small[: len(least)] == least) | (small[K - S :] == least))
        doc = np.searchsorted(first, starts, side="right") - 1
        inside = starts + K <= (first + sizes)[doc]
        starts, doc = starts[inside], doc[inside]
        code = mixed(small[starts] * np.uint64(3) + small[starts + S]) >> np.uint64(32)
        order = np.lexsort((starts, code, doc))
        doc, code, starts = doc[order], code[order], starts[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
        doc, code, starts = doc[new], code[new], starts[new]
        begin = np.searchsorted(doc, np.arange(len(texts) + 1))
        taken = (np.arange(len(doc)) - begin[doc] < ANCHORS) | (code <= np.uint64(_limit(share)))
        doc, code, starts = doc[taken], code[taken], starts[taken]
        order = np.argsort(starts, kind="stable")
        code = code[order]
        begin = np.searchsorted(doc[order], np.arange(len(texts) + 1))
        out = [code[a:b].tolist() for a, b in zip(begin[:-1], begin[1:], strict=True)]
    for i, text in enumerate(texts):
        if text and not out[i]:
            out[i] = [int.from_bytes(hashlib.sha256(raw[i]).digest()[:4])]
    return out


def _bound(anchors: list[int], share: int) -> int:
    """Up to where all anchors of the text are in its sample."""
    return 1 << 32 if len(anchors) < ANCHORS else max(_limit(share), max(anchors))


def likeness(a: list[int], b: list[int], share: int = SHARE) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    bound = min(_bound(a, share), _bound(b, share))
    place = {code: i for i, code in enumerate(b) if code <= bound}
    own = [code for code in a if code <= bound]
    chain: list[int] = []
    for code in own:
        if (at := place.get(code)) is not None:
            where = bisect_left(chain, at)
            chain[where : where + 1] = [at]
    total = len(own) + len(place)
    return 2 * len(chain) / total if total else 0.0


def as_text(anchors: list[int]) -> str:
    return "".join(f"{code:08x}" for code in anchors)


def edited(text: str, following: str) -> str:
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def with_neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(range, halo, doc_id, text) dealt out by range and sorted; ``halo`` rows are copies of
    the document that follows the last one of the range."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    parts = partitions_of(docs.sparkSession)
    bucket = range_bucket("doc_id", range_splits(rows.select("doc_id"), "doc_id", parts))
    ranges = rows.select("doc_id", bucket.alias("range")).groupBy("range")
    # One row for each range: its first doc_id, null if it holds any null.
    found = ranges.agg(F.min("doc_id").alias("first"), F.bool_or(F.col("doc_id").isNull()).alias("holds_null"))
    ends = sorted((r.range, None if r.holds_null else r.first) for r in found.collect())
    halo = F.lit(None).cast("int")
    if ends:
        before = [ends[-1][0], *(r for r, _ in ends[:-1])]
        for (_, value), to in zip(ends, before, strict=True):
            if value is None:
                halo = F.when(F.col("doc_id").isNull(), to).otherwise(halo)
        pairs = [x for (_, value), to in zip(ends, before, strict=True) if value is not None for x in (F.lit(value), F.lit(to))]
        if pairs:
            halo = F.coalesce(halo, F.try_element_at(F.create_map(*pairs), F.col("doc_id")))
    own = F.struct(bucket.cast("int").alias("range"), F.lit(0).alias("halo"))
    other = F.struct(halo.alias("range"), F.lit(1).alias("halo"))
    copies = F.explode(F.filter(F.array(own, other), lambda c: c["range"].isNotNull()))
    dealt = rows.select(copies.alias("to"), "doc_id", "text").select("to.*", "doc_id", "text")
    return dealt_by_range(dealt, parts).sortWithinPartitions("range", "halo", "doc_id", "text")


def _rows(found: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str]]:
    """doc_id, text and the next text of every document."""
    last = None
    closed = False  # the range's last document has met its successor
    for batch in found:
        for place, halo, doc, text in zip(*(batch[c].to_pylist() for c in ("range", "halo", "doc_id", "text")), strict=True):
            if last is not None and last[0] == place and not closed:
                yield last[1], last[2], text
            closed = halo == 1
            last = (place, doc, text)


def compared(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = SHARE) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and its successor."""

    def made(held: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
        changed = [edited(t, after) for _, t, after in held]
        own = sketches([t for _, t, _ in held] + [held[-1][2]], share)
        other = sketches(changed, share)
        # Rows follow each other within a range; where a new range begins, look again.
        nexts = [
            own[i + 1] if i + 1 == len(held) or held[i + 1][1] == held[i][2] else sketches([held[i][2]], share)[0]
            for i in range(len(held))
        ]
        columns = (
            [d for d, _, _ in held],
            [len(t) for _, t, _ in held],
            [hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed],
            list(map(as_text, own[:-1])),
            list(map(as_text, other)),
            [likeness(a, b, share) for a, b in zip(own, other, strict=False)],
            [likeness(a, b, share) for a, b in zip(own, nexts, strict=False)],
        )
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in _rows(found):
            held.append(row)
            size += len(row[1])
            if size >= SLICE_BYTES // 4:
                yield made(held)
                held, size = [], 0
        if held:
            yield made(held)

    return in_python(with_neighbours(docs, doc_id, text), run, _OUT)
