"""Quality rules as a ledger of bits.

Every rule is evaluated once for every document and leaves one bit, beside the
measurements it was drawn from.  Bits are only ever appended, so a *policy* is a version
number with a mask over them: applying another policy, or asking what each rule of it
contributes (``ablation``), reads the stored bits and never a text again.

Rows: null and empty texts have no words and fail ``few_words``; every row keeps a row of
its own, whatever its doc_id; an empty table gives an empty ledger.  Columns other than
the id and the text are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import batches, in_python, span_hashes, text_of, word_hashes

#: Name and condition of each rule over the measurements; the place in the list is the bit.
#: The conditions are whole-number arithmetic, so they hold alike in any engine.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("short_words", "n_words > 0 AND word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
)
BASE = ("few_words", "repeated_windows")
#: Version of the policy: the rules that reject.
POLICIES = {
    1: BASE,
    2: (*BASE, "short_words", "long_words", "symbols", "repeated_lines"),
}
LATEST = max(POLICIES)
WINDOW = 5

_SPACES = b" \t\n\r\x0b\x0c"
_MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def mask(rules: tuple[str, ...]) -> int:
    bits = {name: i for i, (name, _) in enumerate(RULES)}
    return sum(1 << bits[name] for name in rules)


def _repeated(words: np.ndarray) -> int:
    """Words in windows that occur twice or more in one text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    at = np.arange(n)
    hashes = span_hashes(words, at, at + WINDOW)
    _, which, times = np.unique(hashes, return_inverse=True, return_counts=True)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    twice = at[times[which] > 1]
    edge[twice] = 1
    np.subtract.at(edge, twice + WINDOW, 1)
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(_SPACES)]
    return len(lines), len(lines) - len(set(lines))


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the measurements of every text."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(found):
            texts = batch["text"].to_pylist()
            words, first = word_hashes(texts)
            rows = []
            for i, raw in enumerate(texts):
                bare = raw.translate(None, _SPACES)
                rows.append((
                    int(first[i + 1] - first[i]),
                    len(bare.decode()),
                    len(bare) - len(bare.translate(None, b"#*$%&|<>")),
                    *_lines(raw),
                    _repeated(words[first[i] : first[i + 1]]),
                ))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", *_MEASURES])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return in_python(rows, run, "doc_id long, " + ", ".join(f"{m} long" for m in _MEASURES))


def ledger(measures: DataFrame) -> DataFrame:
    """Measurements with ``failed``: bit i is set where rule i fails."""
    bits = [F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, condition) in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measures.withColumn("failed", failed.cast("long"))


def judged(rows: DataFrame, policy: int = LATEST) -> DataFrame:
    """A ledger with ``kept``: no rule of the policy failed."""
    return rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0)


def ablation(rows: DataFrame, policy: int = LATEST) -> DataFrame:
    """For each rule of a policy: documents it fails, those that it alone rejects, and
    documents the policy keeps without it.  Only counts of distinct bit sets travel."""
    sets = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    whole = mask(POLICIES[policy])
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask((r,))).alias("bit")) for r in POLICIES[policy]])
    each = sets.select("failed", "n", F.explode(rules).alias("r")).select("failed", "n", "r.*")
    fails = F.col("failed").bitwiseAND(F.col("bit")) != 0
    others = F.col("failed").bitwiseAND(F.lit(whole) - F.col("bit")) == 0
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return each.groupBy("rule").agg(
        count(fails).alias("failed_docs"),
        count(fails & others).alias("only_this"),
        count(others).alias("kept_without"),
    )


def oracle() -> str:
    """DuckDB SQL of the ledger under the latest policy, from the texts themselves."""
    bits = " + ".join(f"CASE WHEN {condition} THEN {1 << i} ELSE 0 END" for i, (_, condition) in enumerate(RULES))
    fails = {version: " OR ".join(c for name, c in RULES if name in names) for version, names in {0: BASE, 1: POLICIES[LATEST]}.items()}
    return rf"""WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
    starts AS (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM words),
    windows AS (SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS win FROM starts),
    twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
    repeated AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS k FROM twice) GROUP BY r),
    measures AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
        FROM words LEFT JOIN repeated USING (r))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({fails[0]}) AS base_failed,
        NOT ({fails[1]}) AS kept, CAST({bits} AS BIGINT) AS failed FROM measures"""
