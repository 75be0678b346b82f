"""Near-duplicate vectors by lattice hashing, verified by cosine.

Each of ``TABLES`` tables maps a unit vector by a random projection to eight dimensions and
decodes it to the nearest point of the E8 lattice, its *home* cell.  A vector also probes the
neighbouring cells (the 240 nearest lattice points of its home) whose point lies within
``REACH`` of it, about three on average.  Two vectors meet in a table if one's home is a cell
that the other probes; at cosine 0.98 that fails in about 5 % of all tables, so in one pair of
8,000 in all three.  Every pair that meets is compared in double precision.

Equal vectors of one label are one *node* with a weight, so copies are never paired.  A pair of
nodes may meet in several tables and from both sides; it counts only where it meets first, and
as projections travel with the rows, a task can tell that by itself: neither links nor pairs are
written anywhere.  A task hands on, for each node, how many vectors it is linked with there and
the least node of its class there.  A cell of more than ``BLOCK`` members or probes is cut into
blocks of both, and every two blocks meet in a group of their own.

Rows: vectors that are null, empty, zero or hold null or non-finite components, and those without
label, link with nothing and are classes of their own; vectors of different lengths never link;
repeated rows are links of each other; a null vec_id is counted but names no class unless all
members have none; an empty table gives no rows.  Other columns are left out.  Nodes are known by
64 hashed bits: among 100 million different vectors two share them with probability 3e-4.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import in_python, mixed, staged
from postlake.llm.components import components

TABLES = 3
SCALE = 0.75
"""A difference of length 0.2 (cosine 0.98) has a length of about 0.42 after projection."""
REACH = 1.0
"""The covering radius: every vector probes its home."""
BLOCK = 1024
AT_ONCE = 4096
_KEY = ("space", "turn", "cell", "i", "j")


def _neighbours() -> np.ndarray:
    """The origin and the 240 lattice points nearest to it."""
    out = [np.zeros(8)]
    for a, b in combinations(range(8), 2):
        for x, y in product((1, -1), repeat=2):
            point = np.zeros(8)
            point[[a, b]] = x, y
            out.append(point)
    out += [np.array(half) for half in product((0.5, -0.5), repeat=8) if sum(v < 0 for v in half) % 2 == 0]
    return np.array(out)


_NEAR = _neighbours()


def _nearest_even(y: np.ndarray) -> np.ndarray:
    """Nearest whole points of even sum."""
    out = np.rint(y)
    off = y - out
    rows = np.flatnonzero(out.sum(axis=1) % 2 != 0)
    worst = np.abs(off[rows]).argmax(axis=1)
    out[rows, worst] += np.where(off[rows, worst] >= 0, 1, -1)
    return out


def lattice_point(y: np.ndarray) -> np.ndarray:
    """The E8 point nearest to each row: whole coordinates of even sum, or the same half a step on."""
    whole, half = _nearest_even(y), _nearest_even(y - 0.5) + 0.5
    nearer = _squares(y - whole) <= _squares(y - half)
    return np.where(nearer[:, None], whole, half)


def _squares(d: np.ndarray) -> np.ndarray:
    """Row sums of squares, term by term: the same wherever a row stands."""
    out = d[..., 0] * d[..., 0]
    for k in range(1, d.shape[-1]):
        out = out + d[..., k] * d[..., k]
    return out


def projected(unit: np.ndarray, tables: int = TABLES) -> np.ndarray:
    """(row, table, 8): random projections with a random shift."""
    size = unit.shape[1]
    rng = np.random.default_rng(20_000 + size)
    ways, shift = rng.standard_normal((size, tables * 8)) * SCALE, rng.uniform(0, 2, tables * 8)
    out = np.zeros((len(unit), tables * 8)) + shift
    for k in range(size):  # term by term: no result depends on which rows come together
        out += unit[:, k : k + 1] * ways[k]
    return out.astype(np.float32).reshape(-1, tables, 8).astype(np.float64)


def _probed(y: np.ndarray, home_y: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Whether a vector at y with the given home probes the cell of ``point``."""
    return (_squares(home_y - point) <= 2.5) & (_squares(y - point) <= REACH * REACH)


def _cell(points: np.ndarray) -> np.ndarray:
    h = np.zeros(len(points), dtype=np.uint64)
    for k in range(8):
        h = mixed(h + (2 * points[:, k]).astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return h.view(np.int64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so no square is out of range."""
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt(_squares(x))[:, None]


def _nodes(rows: DataFrame) -> DataFrame:
    """node, space (label and length), vec, weight, least vec_id: one row of equal vectors."""
    found = rows.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.any_value("space").alias("space"), F.any_value("vec").alias("vec"),
        F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"),
    )
    return found


def _linkable(vec: Column) -> Column:
    """Not null, not empty, all components finite, one of them not zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def _cells(nodes: DataFrame, tables: int) -> DataFrame:
    """A row for each cell a node lives in or probes, with what comparing needs."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in found:
            for start in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(start, AT_ONCE)
                lists = batch["vec"]
                sizes = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                at = np.cumsum(sizes) - sizes
                for size in np.unique(sizes):
                    mine = np.flatnonzero(sizes == size)
                    vectors = flat[at[mine][:, None] + np.arange(size)]
                    y = projected(_unit(vectors), tables)
                    packed = pa.array([v.tobytes() for v in vectors], pa.binary())
                    places = pa.array([v.tobytes() for v in y.astype(np.float32)], pa.binary())
                    own = batch.take(pa.array(mine))
                    for turn in range(tables):
                        home = lattice_point(y[:, turn])
                        points = home[:, None, :] + _NEAR
                        near = _probed(y[:, turn][:, None, :], home[:, None, :], points)
                        near[:, 0] = True
                        row, which = np.nonzero(near)
                        take = pa.array(row)
                        yield pa.RecordBatch.from_arrays(
                            [
                                own["space"].take(take), pa.array(np.full(len(row), turn, dtype=np.int32)),
                                pa.array(_cell(points[row, which])), pa.array(which == 0),
                                own["node"].take(take), own["weight"].take(take), packed.take(take), places.take(take),
                            ],
                            ["space", "turn", "cell", "home", "node", "weight", "vec", "y"],
                        )

    schema = "space long, turn int, cell long, home boolean, node long, weight long, vec binary, y binary"
    return in_python(nodes.select("space", "node", "weight", "vec"), run, schema)


def _blocks(cells: DataFrame, block: int) -> DataFrame:
    """Cells with the block of members (i) and of probes (j) that a row takes part in.

    As a member a row stands in one block i and meets all blocks j; as a probe the other way
    round.  ``member`` and ``probe`` say as what it comes."""
    key = ["space", "turn", "cell"]
    sizes = cells.groupBy(*key).agg(F.count_if("home").alias("members"), F.count(F.lit(1)).alias("probes"))
    # Written, so that its size is known: a small list is broadcast, and nothing else moves for it.
    large = staged(sizes.where(F.col("probes") > block), "large-cells")
    cut = cells.join(large, key, "left").withColumns(
        {name: F.greatest(F.ceil(F.coalesce(F.col(size), F.lit(0)) / block), F.lit(1)).cast("int")
         for name, size in (("ni", "members"), ("nj", "probes"))}
    )
    own_i, own_j = F.pmod(F.xxhash64("node"), F.col("ni")).cast("int"), F.pmod(F.xxhash64("node"), F.col("nj")).cast("int")
    every_i, every_j = F.sequence(F.lit(0), F.col("ni") - 1), F.sequence(F.lit(0), F.col("nj") - 1)
    as_probe = F.transform(every_i, lambda i: F.struct(i.alias("i"), F.col("own_j").alias("j"), (F.col("home") & (i == F.col("own_i"))).alias("member"), F.lit(True).alias("probe")))
    others = F.filter(every_j, lambda j: j != F.col("own_j"))
    as_member = F.transform(others, lambda j: F.struct(F.col("own_i").alias("i"), j.alias("j"), F.lit(True).alias("member"), F.lit(False).alias("probe")))
    places = F.when(F.col("home"), F.concat(as_probe, as_member)).otherwise(as_probe)
    return cut.withColumns({"own_i": own_i, "own_j": own_j}).select(*key, "node", "weight", "vec", "y", F.explode(places).alias("p")).select(
        *key, "p.*", "node", "weight", "vec", "y"
    )


def _compared(rows: list[pa.RecordBatch], turn: int, at_least: float, tables: int, kind: str) -> pa.RecordBatch | None:
    """Links of one block of a cell: node, n (vectors it is linked with here), other (the least
    node of its class here)."""
    table = pa.Table.from_batches(rows)
    node, weight = table["node"].to_numpy(), table["weight"].to_numpy()
    member, probe = (np.flatnonzero(table[c].to_numpy(zero_copy_only=False)) for c in ("member", "probe"))
    if len(member) == 0 or len(node) < 2:
        return None
    vectors = np.frombuffer(b"".join(table["vec"].to_pylist()), dtype=kind).reshape(len(node), -1).astype(np.float64)
    y = np.frombuffer(b"".join(table["y"].to_pylist()), dtype=np.float32).reshape(len(node), tables, 8).astype(np.float64)
    home = np.stack([lattice_point(y[:, t]) for t in range(tables)], axis=1)
    x = vectors / np.abs(vectors).max(axis=1)[:, None]
    length = np.sqrt(_squares(x))

    def probes(a: np.ndarray, b: np.ndarray, t: int) -> np.ndarray:
        return _probed(y[a, t], home[a, t], home[b, t])

    n = np.zeros(len(node), dtype=np.int64)
    label = np.arange(len(node))
    for start in range(0, len(probe), BLOCK):
        part = probe[start : start + BLOCK]
        for low in range(0, len(member), BLOCK):
            other = member[low : low + BLOCK]
            cosine = (x[part] @ x[other].T) / (length[part][:, None] * length[other])
            q, h = np.nonzero(cosine >= at_least)
            q, h = part[q], other[h]
            first = (node[q] != node[h]) & probes(q, h, turn)  # cells may share their hash
            q, h = q[first], h[first]
            seen = (node[q] > node[h]) & probes(h, q, turn)
            for t in range(turn):
                seen |= probes(q, h, t) | probes(h, q, t)
            q, h = q[~seen], h[~seen]
            np.add.at(n, q, weight[h])
            np.add.at(n, h, weight[q])
            _join(label, q, h)
    found = np.flatnonzero(n)
    least = np.full(len(node), np.iinfo(np.int64).max)
    np.minimum.at(least, label, node)
    if not len(found):
        return None
    return pa.RecordBatch.from_arrays(
        [pa.array(node[found]), pa.array(n[found]), pa.array(least[label[found]])], ["node", "n", "other"]
    )


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Let label be the least row of each class after joining a with b."""
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(up := label[label], label):
            label[:] = up
        if np.array_equal(before, label):
            return


def _links(nodes: DataFrame, at_least: float, tables: int, block: int) -> DataFrame:
    """node, n and other of every block: see ``_compared``.

    The rows of one node that stand in a block as member and as probe are one row."""
    kind = "<f4" if dict(nodes.dtypes)["vec"] == "array<float>" else "<f8"

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in found:
            if not batch.num_rows:
                continue
            columns = [batch[c].to_numpy() for c in _KEY]
            new = np.zeros(batch.num_rows - 1, dtype=bool)
            for c in columns:
                new |= c[1:] != c[:-1]
            edges = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
            for start, end in zip(edges, edges[1:], strict=False):
                here = tuple(int(c[start]) for c in columns)
                if held and here != key:
                    if (out := _compared(held, key[1], at_least, tables, kind)) is not None:
                        yield out
                    held = []
                key = here
                held.append(batch.slice(start, end - start))
        if held and (out := _compared(held, key[1], at_least, tables, kind)) is not None:
            yield out

    rows = _blocks(_cells(nodes, tables), block)
    grouped = rows.repartition(*_KEY).sortWithinPartitions(*_KEY)
    return in_python(grouped, run, "node long, n long, other long")


def near_vectors(
    table: DataFrame, at_least: float = 0.98, *, vec_id: str = "vec_id", label: str = "label",
    embedding: str = "embedding", tables: int = TABLES, block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    vec = F.col(embedding)
    if dict(table.dtypes)[embedding] != "array<float>":
        vec = vec.cast("array<double>")
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), vec.alias("vec"))
    space = F.xxhash64("label", F.size("vec"))
    linkable = F.col("label").isNotNull() & _linkable(F.col("vec"))
    rows = rows.withColumn("space", space).withColumn("node", F.when(linkable, F.xxhash64("space", "vec")))
    nodes = staged(_nodes(rows), "vectors")
    links = staged(_links(nodes, at_least, tables, block), "lattice")
    members = components(links.select(F.col("node").alias("a"), F.col("other").alias("b")))
    counted = links.groupBy("node").agg(F.sum("n").alias("n"))
    named = nodes.select("node", "weight", "least").join(members, "node", "left").join(counted, "node", "left")
    named = named.withColumn("class", F.coalesce("component", "node"))
    least = named.groupBy("class").agg(F.min("least").alias("component_id"))
    by_node = named.join(least, "class").select(
        "node", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    out = rows.select("vec_id", "node").join(by_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def oracle(at_least: float = 0.98) -> str:
    """The same rows in SQL, by all pairs of a label."""
    return f"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
           label IS NOT NULL AND len(embedding) > 0
           AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS linkable
    FROM embeddings
), links AS (
    SELECT x.vec_id AS a, y.vec_id AS b
    FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
    WHERE x.linkable AND y.linkable AND list_cosine_similarity(x.e, y.e) >= {at_least}
), reached AS (
    SELECT vec_id AS a, vec_id AS b FROM v
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a),
counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, coalesce(c.n_links, 0) AS n_links, m.component_id, v.vec_id = m.component_id AS kept
FROM v JOIN least m ON m.a = v.vec_id LEFT JOIN counts c ON c.a = v.vec_id
"""
