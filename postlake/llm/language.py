"""Language by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams (one to three characters, letters in lower case,
every other run of characters one space) in order of frequency.  A text is compared with
each language by the *out-of-place* distance: how far each of its n-grams stands from its
rank in the language's profile, the most if it is not there.  The nearest language wins,
ties by name; the score is one minus the distance as a share of the largest possible.

Profiles are learned from a bounded sample, ``SAMPLE`` documents of each language, taken
by the hash of their doc_id from all rows for training.  Labels outside the ``LANGUAGES``
most frequent ones are not learned.

Rows: a text that is null or has no letter is ``und`` with score 0, as is every text if
nothing could be learned; null labels and null doc_ids do not train; repeated rows are
predicted alike.  Columns other than the id, text and label are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import batches, in_python

SAMPLE = 2000
LANGUAGES = 500
PROFILE = 400
UNKNOWN = "und"
_BITS = 21  # a code point


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of a text, each packed into 63 bits, and their counts; none without a letter."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    letter = _is_letter()[points]
    if not letter.any():
        return points[:0], points[:0]
    points[~letter] = 32
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    points = points[keep]
    pairs = points[:-1] << _BITS | points[1:]
    triples = pairs[:-1] << _BITS | points[2:]
    return np.unique(np.concatenate([points, pairs, triples]), return_counts=True)


def ranked(grams: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, ties by code."""
    return grams[np.lexsort((grams, -counts))[:size]]


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """The profile of each language, from the bounded sample described above."""
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
    )
    labels = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    langs = [r.lang for r in labels.collect()]
    if not langs:
        return {}
    # Ids first: the texts of the sample alone are gathered, at most LANGUAGES * SAMPLE.
    by_hash = F.struct(F.xxhash64("doc_id").alias("h"), F.col("doc_id"))
    ranks = known.where(F.col("lang").isin(langs)).select("lang", "doc_id", by_hash.alias("order"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    chosen = ranks.withColumn("place", place).where(F.col("place") <= SAMPLE).select("doc_id").distinct()
    sample = known.join(F.broadcast(chosen), "doc_id", "left_semi").where(F.col("lang").isin(langs))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(found):
            own: dict[str, list] = {}
            for name, body in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                own.setdefault(name, []).append(gram_counts(body))
            for name, parts in own.items():
                grams, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                counts = np.bincount(which, weights=np.concatenate([p[1] for p in parts]), minlength=len(grams))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(grams)), pa.array(grams), pa.array(counts.astype(np.int64))],
                    ["lang", "gram", "n"],
                )

    counted = in_python(sample.select("lang", "text"), run, "lang string, gram long, n long")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = totals.withColumn("place", place).where(F.col("place") <= PROFILE).collect()
    profiles = {name: np.zeros(0, dtype=np.int64) for name in langs}
    for row in sorted(rows, key=lambda r: (r.lang, r.place)):
        profiles[row.lang] = np.append(profiles[row.lang], row.gram)
    return {name: grams for name, grams in profiles.items() if len(grams)}


class Judge:
    def __init__(self, profiles: dict[str, np.ndarray]):
        self.names = sorted(profiles)
        self.grams = np.unique(np.concatenate([np.zeros(0, np.int64), *profiles.values()]))
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, dtype=np.int64)
        for j, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.grams, profiles[name]), j] = np.arange(len(profiles[name]))

    def __call__(self, text: str | None) -> tuple[str, float]:
        grams, counts = gram_counts(text or "")
        if not len(grams) or not self.names:
            return UNKNOWN, 0.0
        own = ranked(grams, counts)
        at = np.searchsorted(self.grams, own)
        at[self.grams[np.minimum(at, len(self.grams) - 1)] != own] = len(self.grams)
        ranks = self.ranks[at]
        far = np.where(ranks < 0, PROFILE, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(far))
        return self.names[best], 1.0 - float(far[best]) / (PROFILE * len(own))


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns with lang_pred and score, from the text alone."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(profiles)
        for batch in batches(found, text):
            names, scores = zip(*map(judge, batch[text].to_pylist()), strict=True)
            columns = [batch[c] for c in keep] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score"])

    rows = docs.select(*dict.fromkeys([*keep, text]))
    kinds = dict(rows.dtypes)
    return in_python(rows, run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", lang_pred string, score double")
