"""Language ID, quality rules, SimHash and substring dedup against versions that share no code
with the operators."""

import re
import zlib
from collections import Counter

import duckdb
import pytest
import xxhash

from postlake.llm import registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LINES = "\n".join(["one two three four five six seven eight nine ten eleven twelve"] * 12)
PASSAGE = " ".join(f"w{i}" for i in range(70))
ROWS = [
    (1, PASSAGE), (2, f"before it {PASSAGE} after it"), (3, " ".join(PASSAGE.split()[:49])), (4, None), (5, ""),
    (6, " \n\t\r\x0b\x0c "), (7, LINES), (8, f"{LINES}\n\n{PASSAGE}"), (9, PASSAGE), (9, PASSAGE), (-3, f"x {PASSAGE}"),
    (10, "# $ | <a> naïve word　日本語 🎉🎉 end of the line here and there"), (11, "a b c d e f g h i j k l"),
    (12, "supercalifragilistic " * 12), (13, " ".join(f"l{i}\nsame" for i in range(20))),
]


@pytest.fixture(scope="module")
def docs(sf_dir):
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{sf_dir}/documents.parquet' ORDER BY 1").fetchall()


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    """The given documents, small awkward ones, and none."""
    root = tmp_path_factory.mktemp("independent")
    made = spark.createDataFrame(ROWS, "doc_id long, text string")
    for name, rows in (("few", made), ("none", made.limit(0))):
        rows.repartition(2).write.parquet(f"{root}/{name}/documents.parquet")
    return {"given": sf_dir, "few": f"{root}/few", "none": f"{root}/none"}


@pytest.mark.parametrize("table", ["given", "few", "none"])
@pytest.mark.parametrize("name", ["op9_substring_dedup", "op10_quality_rules"])
def test_equals_sql(spark, tables, name, table):
    path = f"{tables[table]}/documents.parquet"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{path if table == 'given' else path + '/*.parquet'}'")
    result = connection.execute(registry.ORACLES[name])
    columns = [c[0] for c in result.description]
    found = registry.QUERIES[name](spark, tables[table])
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, found.select(*columns).collect()))) == sorted(map(repr, result.fetchall()))


def grams_of(text):
    """Most frequent n-grams in order; shorter ones before longer ones, then by code points."""
    if not any(c.isalpha() for c in text.lower()):
        return Counter()
    bare = "".join(c if c.isalpha() else "\0" for c in f" {text.lower()} ")
    bare = re.sub("\0+", " ", bare)
    return Counter(bare[i : i + n] for n in (1, 2, 3) for i in range(len(bare) - n + 1))


def profile(counts):
    return sorted(counts, key=lambda g: (-counts[g], len(g), g))[:400]


def test_language_by_hand(spark, sf_dir, docs):
    held = {d: zlib.crc32(str(d).encode()) % 4 == 2 for d, _, _ in docs}
    learned = {}
    for doc_id, text, lang in docs:
        if lang is not None and text is not None and not held[doc_id]:
            learned.setdefault(lang, Counter()).update(grams_of(text))
    ranks = {lang: {g: i for i, g in enumerate(profile(counts))} for lang, counts in sorted(learned.items())}
    found = {r.doc_id: r for r in registry.QUERIES["op6_language_id"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for doc_id, text, _ in docs:
        own, row = profile(grams_of(text or "")), found[doc_id]
        assert row.held_out == held[doc_id]
        if not own:
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        far = {
            lang: sum(abs(known[g] - i) if g in known else 400 for i, g in enumerate(own)) for lang, known in ranks.items()
        }
        best = min(far, key=lambda lang: (far[lang], lang))
        assert row.lang_pred == best
        assert row.score == pytest.approx(1 - far[best] / (400 * len(own)), abs=1e-12)


def test_every_fingerprint(spark, sf_dir, docs):
    found = {r.doc_id: r.fingerprint for r in registry.QUERIES["op2_simhash_near_dedup"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for doc_id, text, _ in docs:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
        ones = Counter()
        for shingle in shingles if words else []:
            h = xxhash.xxh64_intdigest(shingle, seed=42)
            ones.update(b for b in range(64) if h >> b & 1)
        assert found[doc_id] == f"{sum(1 << b for b, n in ones.items() if 2 * n > len(shingles)):016x}"


def test_kept_by_hand(spark, tables):
    """The six rules of the latest policy, in words and lines of Python."""
    for table in ("given", "few"):
        texts = spark.read.parquet(f"{tables[table]}/documents.parquet").select("doc_id", "text").collect()
        want = Counter()
        for doc_id, text in texts:
            words, text = WORD.findall(text or ""), text or ""
            windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
            again = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
            lines = [line for line in text.split("\n") if WORD.search(line)]
            n, chars = len(words), sum(map(len, words))
            bad = n < 10 or 5 * len(again) > n or chars < 2 * n or chars > 15 * n
            bad = bad or 10 * len(re.findall(r"[#*$%&|<>]", text)) > n
            want[doc_id, not (bad or 10 * (len(lines) - len(set(lines))) > 3 * len(lines))] += 1
        found = registry.QUERIES["op10_quality_rules"](spark, tables[table]).collect()
        assert Counter((r.doc_id, r.kept) for r in found) == want
        assert len({kept for _, kept in want}) == 2
