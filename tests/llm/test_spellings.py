"""Spelling variants against dictionaries of words with one letter taken out."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from postlake.llm import registry, spellings

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def counted(rows, slips=97):
    words = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % slips == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def near_of(words):
    near, holes = defaultdict(set), defaultdict(set)
    for word in words:
        for i in range(len(word)):
            holes[word[:i], word[i + 1 :]].add(word)
            shorter = word[:i] + word[i + 1 :]
            if shorter in words:
                near[word].add(shorter)
                near[shorter].add(word)
    for group in holes.values():
        for word in group:
            near[word] |= group - {word}
    return near


def brute(words):
    near, form = near_of(words), {}
    for word, n in words.items():
        best = min(near[word], key=lambda w: (-words[w], w), default=None)
        form[word] = best if best and words[best] >= 2 * n else None

    def root(word):
        while form[word]:
            word = form[word]
        return word

    return {w: (form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def rows_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_documents(spark, scale):
    folder = f"/root/testdata/{scale}"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(counted(rows))
    assert sum(f is not None for f, *_ in want.values()) > 50
    assert rows_of(registry.QUERIES["op13_spelling_variants"](spark, folder)) == want


@pytest.mark.parametrize("shard", [1, 20, 10_000])
def test_dense_neighbourhoods_in_small_shards(spark, shard):
    rng = random.Random(2)
    words = {"".join(rng.choices("abéÀ", k=rng.randint(5, 8))): rng.choice([3, 5, 8, 20, 90]) for _ in range(900)}
    words |= {"z" * 300: 4, "z" * 301: 8, "z" * 302: 16, "z" * 303: 50, "abcde": 3, "abced": 9, "edcba": 9}
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    want = brute(words)
    assert want["abcde"][3] == 0 and want["z" * 300][1] == "z" * 303
    assert rows_of(spellings.variants(table, shard=shard)) == want


def test_long_words_with_counts_beyond_a_byte(spark):
    words = {"a" * 4000 + "b" * 4000: 3, "a" * 4001 + "b" * 4000: 6, "a" * 4000 + "b" * 3999 + "c": 9, "ba" * 4000: 5}
    assert rows_of(spellings.variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == brute(words)


def test_odd_texts(spark):
    texts = [
        (None, "Hello hello HELLO hallo hallo hallo hallo hallo hallo"), (1, None), (2, ""), (3, "123 \n ?!"), (4, "ÄRGER Ärger ärger ×÷×÷× naïve"),
        (5, "hello " * 5000 + "x" * 200_000), (5, "hello"), (5, "hello"), (6, "日本語 hello＿hello"), (-7, "straße strasse straße"),
    ]
    table = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 AS n", "'w' AS word", "2 AS shard")
    words = spellings.vocabulary(table, slips=97)
    assert {r.word: r.n for r in words.collect()} == counted(texts)
    assert rows_of(spellings.variants(words)) == brute(counted(texts))
    assert {r.word: r.n for r in spellings.vocabulary(table, slips=1).collect()} == counted(texts, 1)
    assert spellings.variants(spellings.vocabulary(table.limit(0))).count() == 0
