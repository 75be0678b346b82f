"""The near-dedup stage against all pairs of shingle sets."""

import random

import pytest

import corpus_pipeline
from postlake.llm import set_join, simhash


def kept_by_all_pairs(rows):
    sets = []
    for _, text in rows:
        words = (text or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    least = list(range(len(rows)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    pairs = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 9 * len(a & b) >= 4 * (len(a) + len(b)):
                pairs += a != b
                least[max(root(i), root(j))] = min(root(i), root(j))
    return sorted(rows[i][0] for i in range(len(rows)) if root(i) == i), pairs


def planted():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    common = rng.choices(words, k=60)
    texts = ["", "Two words", "two  WORDS"]
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(20, 200)) + common * rng.randint(0, 1)
        for edits in (0, 1, 1, 2, 3, 5, 8):
            new = list(base)
            for at in rng.sample(range(len(new)), min(edits, len(new) // 12)):
                new[at] = rng.choice(words)
            texts.append(" ".join(new))
    chain = rng.choices(words, k=150)
    for _ in range(25):  # each near the one before, the ends far apart
        chain[rng.randrange(150)] = rng.choice(words)
        texts.append(" ".join(chain))
    return list(enumerate(texts))


@pytest.mark.parametrize("stars", [0, 2])
def test_near_dedup_finds_all_pairs_at_four_fifths(spark, monkeypatch, stars):
    monkeypatch.setattr(set_join, "STARS", stars)
    rows = planted()
    want, pairs = kept_by_all_pairs(rows)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert pairs > 50
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, table, "").collect()) == want


def test_near_dedup_of_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want, pairs = kept_by_all_pairs(sorted(map(tuple, table.collect())))
    assert pairs
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, table, "").collect()) == want


def test_near_dedup_compares_what_simhash_finds(spark, monkeypatch):
    """Fingerprints at most two bits apart are the first candidates, found by the BK-trees and held to 4/5."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    long = rng.choices(words, k=4000)
    texts = [" ".join(long), " ".join([*long, "end"]), " ".join(rng.choices(words, k=400)), "a b c d e f", "a b c d e f a b c d e f"]
    rows = [(i, t, simhash.fingerprint(t.encode(), 5)) for i, t in enumerate(texts)]
    near = {(i, j) for i, _, x in rows for j, _, y in rows if i < j and bin((x ^ y) & (2**64 - 1)).count("1") <= 2}
    assert (0, 1) in near
    nodes = spark.createDataFrame([(i, fp) for i, _, fp in rows], "node long, fp long")
    assert {(min(r), max(r)) for r in map(tuple, set_join.near_prints(nodes).collect())} == near

    found, inner = [], set_join.near_prints

    def seen(nodes):
        pairs = inner(nodes)
        found.append(pairs.count())
        return pairs

    monkeypatch.setattr(set_join, "near_prints", seen)
    table = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    want, _ = kept_by_all_pairs([(i, t) for i, t, _ in rows])
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, table, "").collect()) == want
    assert found == [len(near)]
