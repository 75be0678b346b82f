"""Lattice hashing against all pairs."""

import duckdb
import numpy as np
import pytest

from postlake.llm import lattice, registry


def all_pairs(rows, at_least=0.98):
    """vec_id -> (n_links, component_id) of rows with distinct vec_ids."""
    def usable(label, vec):
        return label is not None and vec and all(x is not None and np.isfinite(x) for x in vec) and any(vec)

    ok = [(i, np.array(v, dtype=float), label) for i, v, label in rows if usable(label, v)]
    least = {i: i for i, *_ in rows}
    n = dict.fromkeys(least, 0)
    pairs = [
        (i, j) for k, (i, v, a) in enumerate(ok) for j, w, b in ok[:k]
        if a == b and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= at_least
    ]
    for i, j in pairs:
        n[i] += 1
        n[j] += 1
    for _ in rows:
        for i, j in pairs:
            least[i] = least[j] = min(least[i], least[j])
    return {i: (n[i], least[i]) for i in least}


def planted(size):
    rng = np.random.default_rng(4)
    rows = []

    def add(vec, label):
        rows.append((len(rows), [float(np.float32(x)) for x in vec], label))

    for k in range(12):
        base = rng.standard_normal(size)
        for noise in (0, 0, 0, 0.05, 0.1, 0.15, 0.19, 0.2, 0.21, 0.4):
            add(base * rng.choice([1, 3]) + noise * np.linalg.norm(base) * rng.standard_normal(size) / np.sqrt(size), k % 2)
    base = rng.standard_normal(size)
    for _ in range(60):  # one dense group, of two labels
        add(base + 0.1 * np.linalg.norm(base) * rng.standard_normal(size) / np.sqrt(size), 1 + len(rows) % 2)
    return rows


def found(spark, rows, **how):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    return lattice.near_vectors(table, **how).collect()


@pytest.mark.parametrize("size,block", [(64, 1024), (64, 7), (16, 1024), (256, 16)])
def test_equals_all_pairs(spark, size, block):
    rows = planted(size)
    want = all_pairs(rows)
    assert sum(n for n, _ in want.values()) > 500
    got = found(spark, rows, block=block)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_recall_near_the_threshold():
    """Pairs at exactly the threshold that meet in at least one table."""
    rng = np.random.default_rng(8)
    a, b = rng.standard_normal((2, 20_000, 64))
    a = lattice._unit(a)
    b = lattice._unit(b - (a * b).sum(axis=1)[:, None] * a)
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * b
    met = np.zeros(len(a), dtype=bool)
    ya, yb = lattice.projected(a), lattice.projected(b)
    for t in range(lattice.TABLES):
        home_a, home_b = lattice.lattice_point(ya[:, t]), lattice.lattice_point(yb[:, t])
        met |= lattice._probed(ya[:, t], home_a, home_b) | lattice._probed(yb[:, t], home_b, home_a)
    assert met.mean() > 0.999


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(1)
    y = rng.uniform(-3, 3, (500, 8))
    point = lattice.lattice_point(y)
    assert ((2 * point) % 1 == 0).all() and (point.sum(axis=1) % 2 == 0).all()
    distance = ((y - point) ** 2).sum(axis=1)
    around = ((y[:, None, :] - point[:, None, :] - lattice._NEAR) ** 2).sum(axis=2)
    assert (around.min(axis=1) >= distance - 1e-12).all() and (distance <= 1 + 1e-12).all()
    assert len(lattice._NEAR) == 241


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, [0.0, 0.0], 1), (5, None, 1), (6, [], 1),
        (7, [1.0, nan], 1), (8, [1.0, inf], 1), (9, [1.0, None], 1), (10, [1.0, 0.0, 0.0], 1), (11, [3e38, 1.0], 1),
        (12, [1e-44, 0.0], 1), (13, [-0.0, 1.0], 2), (14, [0.0, 1.0], 2),
    ]
    assert {r.vec_id: (r.n_links, r.component_id) for r in found(spark, rows)} == all_pairs(rows)
    twice = found(spark, [(None, [1.0, 2.0], 1), (7, [1.0, 2.0], 1), (7, [1.0, 2.0], 1), (None, None, None), (None, [0.0, 5.0], 3)])
    assert sorted(map(str, map(tuple, twice))) == sorted(
        ["(None, 2, 7, False)", "(7, 2, 7, True)", "(7, 2, 7, True)", "(None, 0, None, False)", "(None, 0, None, False)"]
    )
    assert found(spark, []) == []


def test_columns_of_other_names_and_clashes(spark):
    rows = spark.createDataFrame([(5, [1.0, 0.0], 1, 9, 8), (4, [1.0, 0.0], 1, 9, 8)], "node long, vec array<double>, space int, n long, cell long")
    out = lattice.near_vectors(rows, vec_id="node", embedding="vec", label="space").collect()
    assert sorted(map(tuple, out)) == [(4, 1, 4, True), (5, 1, 4, False)]


def test_query_against_sql(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = sorted(connection.execute(registry.ORACLES["op11_embedding_near_dedup"]).fetchall())
    assert sorted(map(tuple, registry.QUERIES["op11_embedding_near_dedup"](spark, sf_dir).collect())) == want


def test_sql_against_all_pairs():
    rows = planted(16)
    connection = duckdb.connect()
    connection.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INT)")
    connection.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    got = {r[0]: r[1:3] for r in connection.execute(lattice.oracle()).fetchall()}
    assert got == all_pairs(rows)
