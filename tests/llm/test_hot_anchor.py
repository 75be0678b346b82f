"""Substring dedup with one short run in most texts, dealt out and right."""

import random
from collections import Counter

from postlake.llm import lz_dedup


def test_windows_of_a_hot_anchor_are_split(spark, monkeypatch):
    monkeypatch.setattr(lz_dedup, "HOT_WINDOWS", 500, raising=False)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    common = rng.choices(words, k=40)
    texts = []
    for _ in range(400):
        texts.append(" ".join(rng.choices(words, k=30) + common + rng.choices(words, k=30)))
    texts += [" ".join(rng.choices(words, k=20)) + " " + t for t in texts[:60]]
    rng.shuffle(texts)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)

    size = Counter()
    for row in lz_dedup.dealt(table).collect():
        size[row.block] += len(row.codes) // 6
    assert max(size.values()) < 3 * sum(size.values()) / len(size)

    seen, want = set(), {}
    for i, text in enumerate(texts):
        own = text.split()
        windows = [tuple(own[k : k + 50]) for k in range(len(own) - 49)]
        gone = {k + j for k, w in enumerate(windows) if w in seen for j in range(50)}
        seen |= set(windows)
        want[i] = " ".join(w for k, w in enumerate(own) if k not in gone)
    assert {r.doc_id: r.kept for r in lz_dedup.without_copies(table).collect()} == want
    unsplit = {(r.doc_id, r.start + k) for r in lz_dedup.factors(table).collect() for k in range(r.windows)}
    monkeypatch.setattr(lz_dedup, "HOT_WINDOWS", 10**9)
    assert unsplit == {(r.doc_id, r.start + k) for r in lz_dedup.factors(table).collect() for k in range(r.windows)}
