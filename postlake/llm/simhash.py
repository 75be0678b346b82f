"""Near-duplicates by SimHash, found in BK-trees.

A text's fingerprint has 64 bits: bit by bit the majority over the XXH64 values of its
word shingles.  Equal fingerprints are one node.  Two nodes are linked if at most
``RADIUS`` bits differ, and a document's class is everything reachable.

A tree of all fingerprints would have to be searched whole by every query, so the forest
is cut into *shards* that provably hold all partners of a query: with 64 bits in four
bands and two bits that may differ, at least two bands agree, so each fingerprint goes to
the six shards named by two of its bands.  A shard with more than ``SHARD`` members is cut
again by thirds of the bits that are still free (one third of them must agree, as at most
two bits differ), three shards for each, until it is small or only 14 free bits are left
(at most 16,384 members).  So a shard's tree is bounded, and it meets its queries, which
are its own members, in one task; whole trees are never sent to all tasks, as the number
of trees grows with the data.

In a shard's BK-tree the children of a node are keyed by their Hamming distance to it, and
a query at distance d from a node follows only the edges d - RADIUS ... d + RADIUS.  The
queries of a shard walk down together.  Each shard hands on a spanning forest of its links,
never all pairs.

Rows: null and empty texts (no words) have fingerprint zero and are linked like any other;
fewer words than a shingle make one shingle; a null doc_id is a member but never names a
class unless all members have none; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import batches, free_names, in_python, staged, text_key, text_of
from postlake.llm.components import components

RADIUS = 2
SHARD = 4096
_BANDS = tuple(range(0, 64, 16))


def fingerprint(text: bytes, size: int) -> int:
    """Majority bits over the shingles' XXH64 (seed 42), signed."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    count = max(1, len(words) - size + 1)
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), shingles), dtype="<u8", count=count)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, count, 1 << 16):
        piece = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(piece, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns with ``fp``."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(found, "_text"):
            fps = [fingerprint(t, size) for t in batch["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(fps, pa.int64())], [*keep, "fp"])

    rows = docs.select(*keep, text_of(text).alias("_text"))
    kinds = dict(rows.dtypes)
    return in_python(rows, run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", fp long")


def _bits(start: int, count: int) -> int:
    return ((1 << count) - 1) << start


def _routes() -> list[tuple[int, tuple[int, ...]]]:
    """Bits that name a shard, and the free bits."""
    out = []
    for a, b in combinations(_BANDS, 2):
        named = _bits(a, 16) | _bits(b, 16)
        out.append((named, tuple(i for i in range(64) if not named >> i & 1)))
    return out


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _masked(mask: int) -> Column:
    return F.col("fp").bitwiseAND(F.lit(_signed(mask)))


def shards(nodes: DataFrame) -> DataFrame:
    """(mask, value, fp): every fingerprint in all shards it belongs to, none above the bound
    while bits to cut by are left; shards of one member are left out."""
    routes = _routes()
    done, level = [], None
    while True:
        masks = F.array(*[F.lit(_signed(named)) for named, _ in routes])
        if level is None:
            rows = nodes.select("fp", F.explode(masks).alias("mask"))
        else:
            step = F.create_map(*[
                x for named, cuts in level.items() for x in (F.lit(_signed(named)), F.array(*[F.lit(_signed(c)) for c in cuts]))
            ])
            rows = rows.select("fp", F.explode(step[F.col("mask")]).alias("mask"))
        rows = rows.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        rows = staged(rows.join(sizes, ["mask", "value"]).select("mask", "value", "fp", "size"), "shards")
        free = len(routes[0][1])
        if free <= 14:
            done.append(rows)
            break
        done.append(rows.where(F.col("size") <= SHARD))
        rows = rows.where(F.col("size") > SHARD)
        if rows.isEmpty():
            break
        level, following = {}, []
        for named, left in routes:
            third = -(-len(left) // 3)
            cuts = []
            for i in range(0, len(left), third):
                more = named | sum(1 << b for b in left[i : i + third])
                cuts.append(more)
                following.append((more, tuple(b for b in left if not more >> b & 1)))
            level[named] = cuts
        routes = list(dict(following).items())
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.select("mask", "value", "fp")


class Tree:
    """A BK-tree over distinct fingerprints; child[node, distance] is a node or -1."""

    def __init__(self, values: np.ndarray):
        self.values = values
        n = len(values)
        self.child = np.full((n, 65), -1, dtype=np.int32)
        at = np.zeros(n, dtype=np.int64)  # where each value waits; the root is value 0
        waiting = np.arange(1, n)
        while len(waiting):
            edge = np.bitwise_count(values[waiting] ^ values[at[waiting]]).astype(np.int64)
            seat = at[waiting] * 65 + edge
            flat = self.child.reshape(-1)
            free, first = np.unique(seat, return_index=True)
            new = flat[free] < 0
            flat[free[new]] = waiting[first[new]]
            at[waiting] = flat[seat]
            waiting = waiting[at[waiting] != waiting]

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all nodes at most ``radius`` away."""
        query, node = np.arange(len(queries)), np.zeros(len(queries), dtype=np.int64)
        found_q, found_n = [], []
        while len(query):
            far = np.bitwise_count(queries[query] ^ self.values[node]).astype(np.int64)
            near = far <= radius
            found_q.append(query[near])
            found_n.append(node[near])
            edges = far[:, None] + np.arange(-radius, radius + 1)
            ok = (edges >= 1) & (edges <= 64)
            down = np.where(ok, self.child[node[:, None], np.clip(edges, 0, 64)], -1)
            row, col = np.nonzero(down >= 0)
            query, node = query[row], down[row, col].astype(np.int64)
        return np.concatenate(found_q), np.concatenate(found_n)


def forest(values: np.ndarray, radius: int = RADIUS, chunk: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is linked within ``radius``: each value with the least index it
    is joined to.  Queries go down in chunks, so what is held at once is bounded."""
    tree = Tree(values)
    label = np.arange(len(values))
    for start in range(0, len(values), chunk):
        q, n = tree.within(values[start : start + chunk], radius)
        a, b = q + start, n
        while True:
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label = up
            if np.array_equal(before, label):
                break
    joined = np.flatnonzero(label != np.arange(len(values)))
    return values[joined], values[label[joined]]


def links(nodes: DataFrame) -> DataFrame:
    """(a, b) fingerprints that join all nodes at most RADIUS bits apart, of distinct ``fp``."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        key = None

        def linked() -> Iterator[pa.RecordBatch]:
            values = np.concatenate(held)
            if len(values) > 1:
                a, b = forest(values)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in found:
            if not batch.num_rows:
                continue
            mask, value, fp = (batch[c].to_numpy() for c in ("mask", "value", "fp"))
            cut = np.flatnonzero((np.diff(mask) != 0) | (np.diff(value) != 0)) + 1
            edges = [0, *cut.tolist(), len(fp)]
            fp = fp.view(np.uint64)
            for start, end in zip(edges, edges[1:], strict=False):
                here = (mask[start], value[start])
                if key is not None and here != key:
                    yield from linked()
                    held = []
                key = here
                held.append(fp[start:end])
        if held:
            yield from linked()

    grouped = shards(nodes).repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
    return in_python(grouped, run, "a long, b long")


def classes(prints: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``prints`` (with fp), component (a fingerprint of the class) and component_id, the
    smallest doc_id of the class."""
    nodes = staged(prints.groupBy("fp").agg(F.min(doc_id).alias("least")), "fingerprints")
    members = components(links(nodes)).withColumnRenamed("node", "fp")
    named = nodes.join(members, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = named.join(least, "component").select("fp", "component", "component_id")
    return prints.join(by_fp, "fp")


def near_duplicates(docs: DataFrame, size: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp and component_id of every row; shingles of ``size`` words."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return classes(staged(fingerprints(rows, size), "simhash")).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, size: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document of the smallest doc_id of each class, with all its columns (of rows of
    one doc_id the one of the smallest text key; of equal rows one)."""
    names = free_names(docs, "none", "id", "key", "number")  # in this order null doc_ids come last
    keys, number = names[:3], names[3]
    values = (F.col(doc_id).isNull(), F.coalesce(F.col(doc_id).cast("long"), F.lit(0)), text_key(text))
    keyed = docs.withColumns(dict(zip(keys, values, strict=True)))
    prints = staged(fingerprints(keyed, size, tuple(keys), text), "simhash")
    chosen = classes(prints, keys[1]).groupBy("component").agg(F.min(F.struct(*keys)).alias("first")).select("first.*")
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(keys[1]))
    kept = keyed.join(chosen, keys, "left_semi").withColumn(number, nth).where(F.col(number) == 1)
    return kept.select(*docs.columns)


def as_hex(column: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
