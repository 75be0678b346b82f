"""Near-duplicates by the likeness of their shingle sets, joined exactly.

Two texts are linked if the Jaccard similarity of their sets of word shingles is at least
4/5, and a document's class is everything reachable.  Shingles compare by 64 hashed bits,
whole sets by 64 as well; texts of one set are one *node*.

Sets are ordered by one order of all shingles, rare ones first: by the count of a bucket
of hashes, then by the hash.  Any order finds all pairs; this one keeps what many texts
share out of the way.  Two sets of similarity 4/5 share a shingle among the first
n - ceil(4n/5) + 1 of each (the *prefix*), and from the place of a shared one on enough must be
left in both.  Such pairs are candidates, and the whole sets decide.

The first candidates come from SimHash (``simhash.py``): a node's fingerprint is that of one of its
texts, nodes of one fingerprint meet the least of them, and fingerprints at most two bits apart
meet where the BK-trees link them.  So copies with a small edit lie in one class before shingles
are joined, and those joins are left to what two bits do not reach.

What many nodes hold is not compared all with all.  First every holder of a shingle meets
one of them, the least by a hash, so a group of near copies sends one row for each of its
members; then, under other hashes, again.  Only shingles whose holders lie in several
classes after that have their pairs of different classes compared.  Pairs in one class
are linked already, so nothing is lost.

Before whole sets are compared, a sketch of 256 counters bounds what two sets can have in common.  Whole sets are made
again from the texts, for the nodes of the pairs that are left; tables are deleted as soon as
what follows from them is written.

Rows: null and empty texts (no words) have the empty set and are one node; fewer words than
a shingle make one shingle; ASCII letters compare in lower case; repeated rows are one node and
one of them stays; a very long text is one set like any other; a null doc_id comes last; an empty
table gives no rows; columns of any name stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm import simhash
from postlake.llm.common import batches, free_names, in_python, mixed, span_hashes, staged, text_key, text_of, unstaged, word_hashes
from postlake.llm.components import components

BUCKETS = 1 << 18
SKETCH = 256
"""Counters of a set's sketch: how many of its shingles fall to each, 255 for more."""
STARS = 2
"""Rounds in which the holders of a shingle meet one of them only."""
_KEYS = ("__none", "__id", "__key")  # in this order null doc_ids come last


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of all distinct shingles, in this order."""
    words, first = word_hashes([t.lower() for t in texts])
    count = np.diff(first)
    number = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    which = np.repeat(np.arange(len(texts)), number)
    start = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
    codes = span_hashes(words, start, np.minimum(start + size, first[which + 1]))
    order = np.lexsort((codes, which))
    which, codes = which[order], codes[order]
    new = np.ones(len(codes), dtype=bool)
    new[1:] = (which[1:] != which[:-1]) | (codes[1:] != codes[:-1])
    return which[new], codes[new]


def _bucket(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(46)).astype(np.int64)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, dtype=np.uint64, out=before[1:])
    ends = np.cumsum(sizes)
    return before[ends] - before[ends - sizes]


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def commonness(keyed: DataFrame, size: int) -> np.ndarray:
    """Of every bucket of hashes how many shingles of all texts it has, on a scale of logarithms."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches(found, "_text"):
            seen += np.bincount(_bucket(shingle_sets(batch["_text"].to_pylist(), size)[1]), minlength=BUCKETS)
        at = np.flatnonzero(seen)
        for start in range(0, len(at), 1 << 16):
            part = at[start : start + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(seen[part])], ["bucket", "n"])

    counts = in_python(keyed.select("_text"), run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, dtype=np.uint16)
    out[counts["bucket"].to_numpy()] = np.round(1000 * np.log2(1 + counts["n"].to_numpy())).astype(np.uint16)
    return out


def _prefixes(keyed: DataFrame, size: int) -> DataFrame:
    """The keys, node, n (of shingles), the prefix in order, the sketch and the SimHash fingerprint."""
    common = commonness(keyed, size)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(found, "_text"):
            texts = batch["_text"].to_pylist()
            which, codes = shingle_sets(texts, size)
            n = np.bincount(which, minlength=batch.num_rows)
            node = mixed(_sums(mixed(codes ^ np.uint64(0x5851F42D4C957F2D)), n) + n.astype(np.uint64))
            counters = np.bincount(which * SKETCH + (codes % np.uint64(SKETCH)).astype(np.int64), minlength=batch.num_rows * SKETCH)
            sketches = np.minimum(counters, 255).astype(np.uint8).reshape(-1, SKETCH)
            codes = codes[np.lexsort((codes, common[_bucket(codes)], which))]
            place = np.arange(len(codes)) - np.repeat(np.cumsum(n) - n, n)
            kept = np.where(n > 0, n - (4 * n + 4) // 5 + 1, 0)
            prefix = _lists(codes[place < np.repeat(kept, n)], kept)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[c] for c in _KEYS), pa.array(node.view(np.int64)), pa.array(n.astype(np.int32)), prefix,
                    pa.array([x.tobytes() for x in sketches], pa.binary()),
                    pa.array([simhash.fingerprint(t, size) for t in texts], pa.int64()),
                ],
                [*_KEYS, "node", "n", "prefix", "sketch", "fp"],
            )

    kinds = dict(keyed.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in _KEYS)
    return in_python(keyed.select(*_KEYS, "_text"), run, f"{schema}, node long, n int, prefix array<long>, sketch binary, fp long")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """node and its whole set."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(found, "_text"):
            which, codes = shingle_sets(batch["_text"].to_pylist(), size)
            n = np.bincount(which, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["node"], _lists(codes, n)], ["node", "codes"])

    return in_python(texts.select("node", "_text"), run, "node long, codes array<long>")


def _several(rows: DataFrame) -> DataFrame:
    """Rows of the shingles whose holders lie in several classes."""
    held = rows.groupBy("h").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    return rows.join(held.select("h"), "h")


_CAN_BE = "x.class != y.class AND 9 * least(x.n - x.i, y.n - y.i) >= 4 * (x.n + y.n)"


def near_prints(nodes: DataFrame) -> DataFrame:
    """(a, b) nodes that SimHash calls near: of one fingerprint, or of two that the BK-trees link."""
    prints = staged(nodes.groupBy("fp").agg(F.min("node").alias("center")), "prints")
    same = nodes.join(prints, "fp").where("node != center").select(F.col("node").alias("a"), F.col("center").alias("b"))
    near = simhash.links(prints.select("fp"))
    for end in ("a", "b"):
        near = near.join(prints.select(F.col("fp").alias(end), F.col("center").alias(f"center_{end}")), end)
    return same.union(near.select("center_a", "center_b"))


def _star(rows: DataFrame, turn: int) -> DataFrame:
    """Every holder of a shingle with the least of them by a hash."""
    least = F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("o"), "node", "n", "i", "class")).alias("y")
    centers = rows.groupBy("h").agg(least).select("h", "y.*").alias("y")
    return rows.alias("x").join(centers, F.col("x.h") == F.col("y.h")).where(_CAN_BE)


def _crossed(rows: DataFrame) -> DataFrame:
    """All pairs of holders of different classes."""
    x, y = rows.alias("x"), rows.alias("y")
    return x.join(y, F.col("x.h") == F.col("y.h")).where(f"{_CAN_BE} AND x.node < y.node")


def _possible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose sketches leave room for enough common shingles.

    Two sets have no more in common than the sum of the smaller counters, so none of the pairs
    that go could have passed; chance neighbours nearly all go, and their texts stay where they are."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            x, y = (np.frombuffer(b"".join(batch[c].to_pylist()), dtype=np.uint8).reshape(-1, SKETCH) for c in ("sketch_a", "sketch_b"))
            least = np.minimum(x, y).astype(np.int64)
            least[least == 255] = np.iinfo(np.int32).max  # both counters are full
            enough = 9 * least.sum(axis=1) >= 4 * (batch["n_a"].to_numpy().astype(np.int64) + batch["n_b"].to_numpy())
            yield batch.select(["a", "b"]).filter(pa.array(enough))

    for end in ("a", "b"):
        sketches = nodes.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("sketch").alias(f"sketch_{end}"))
        pairs = pairs.join(sketches, end)
    return in_python(pairs, run, "a long, b long")


def _alike(candidates: DataFrame, nodes: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Those of the candidate pairs (a, b) whose whole sets have a similarity of 4/5."""
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    pairs = staged(_possible(candidates.select(low, high).distinct(), nodes).select("a", "b"), "pairs")
    # Written, so that its size is known: if it is small, no text moves for it.
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = staged(nodes.select("node", "least.*").join(asked, "node", "left_semi"), "wanted")
    sets = staged(_sets(texts.join(wanted, list(_KEYS)), size).dropDuplicates(["node"]), "sets")
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("codes").alias("of_a")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("codes").alias("of_b")), "b")
    alike = 9 * F.size(F.array_intersect("of_a", "of_b")) >= 4 * (F.size("of_a") + F.size("of_b"))
    found = staged(both.where(alike).select("a", "b"), "alike")
    unstaged(pairs, wanted, sets)
    return found


def _classed(held: DataFrame, found: DataFrame) -> DataFrame:
    """The holders of shingles with the class that the links found so far put them in."""
    named = held.join(components(found), "node", "left")
    return named.select("node", "n", F.coalesce("component", "node").alias("class"), "i", "h")


def links(nodes: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(a, b) nodes that join all nodes of similarity 4/5; ``nodes`` has one row of each, with
    the keys of one of its texts."""
    held = nodes.select("node", "n", F.posexplode("prefix").alias("i", "h"))
    found = _alike(near_prints(nodes), nodes, texts, size)
    rows = staged(_several(_classed(held, found)), "shingles")
    for turn in range(STARS + 1):
        if rows.isEmpty():
            break
        candidates = _star(rows, turn) if turn < STARS else _crossed(rows)
        more = _alike(candidates.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")), nodes, texts, size)
        found = found.union(more)
        if turn < STARS:
            following = staged(_several(_classed(rows.drop("class"), found)), "shingles")
            unstaged(rows)
            rows = following
    unstaged(rows)
    return found


def one_of_each(docs: DataFrame, size: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document of the smallest doc_id of each class, with all its columns (of rows of
    one doc_id the one of the smallest text key; of equal rows one)."""
    names = free_names(docs, *_KEYS, "number")
    own, number = names[:3], names[3]
    values = (F.col(doc_id).isNull(), F.coalesce(F.col(doc_id).cast("long"), F.lit(0)), text_key(text))
    keyed = docs.withColumns(dict(zip(own, values, strict=True)))
    texts = keyed.select(*(F.col(name).alias(key) for name, key in zip(own, _KEYS, strict=True)), text_of(text).alias("_text"))
    of_node = F.min(F.struct(*_KEYS)).alias("least"), F.any_value("n").alias("n"), F.any_value("prefix").alias("prefix"), F.any_value("sketch").alias("sketch"), F.min_by("fp", F.struct(*_KEYS)).alias("fp")
    nodes = staged(_prefixes(texts, size).groupBy("node").agg(*of_node), "nodes")
    found = links(nodes, texts, size)
    by_class = nodes.select("node", "least").join(components(found), "node", "left").withColumn("class", F.coalesce("component", "node"))
    least = by_class.groupBy("class").agg(F.min("least").alias("least"))
    chosen = least.select(*(F.col(f"least.{key}").alias(name) for name, key in zip(own, _KEYS, strict=True)))
    nth = F.row_number().over(Window.partitionBy(*own).orderBy(own[1]))
    kept = keyed.join(chosen, own, "left_semi").withColumn(number, nth).where(F.col(number) == 1)
    return kept.select(*docs.columns)
