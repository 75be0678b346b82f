"""A training corpus from ``documents``: five stages, each written and read again.  A stage keeps
its intermediate tables in a folder of its own, which the next one deletes.

Language ID lets documents of a recognised language through; line dedup deletes later
copies of lines and of runs of lines, and documents of which no word is left; near-dedup keeps one
document of each class; mixing repeats or leaves out documents by the weight of their
source and puts them in training order; BPE encodes and decodes what is left.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import chunked_bpe, curriculum, language, line_runs, registry, set_join
from postlake.llm.common import begin_stage, documents, free_names, staged

log = logging.getLogger(__name__)

MIN_SCORE = 0.2
"""Documents at least this near to a language's profile are kept; n-grams of no known
language give nearly 0, the poorest text of a known one about 0.45."""


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or far from all languages go.  Where no row could teach a
    language, nothing is known to be far from one, and only those without a letter go."""
    begin_stage(docs)
    profiles = language.learn(docs)
    if not profiles:
        log.warning("no labelled document to learn from: languages are not told apart")
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = language.predict(docs, profiles, tuple(docs.columns))
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_SCORE)
    return judged.where(known).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of lines that have a word and of runs of lines go, and documents of which
    they leave no word."""
    begin_stage(docs)
    (lines,) = free_names(docs, "lines")
    done = line_runs.without_copied_runs(docs, out=lines, worded=True)
    found = F.col(lines)
    left = done.where((found["n_removed"] == 0) | line_runs.has_word(found["kept"]))
    text = found["kept"]
    return left.withColumns({"text": text, "n_chars": F.char_length(text).cast("long")}).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, the smallest doc_id; texts whose sets of five-word
    shingles have a similarity of 0.8 or more are linked."""
    begin_stage(docs)
    return set_join.one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as their source's target asks for them."""
    begin_stage(docs)
    return curriculum.mixed_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, and digests of ids and decoded text."""
    begin_stage(docs, last=True)
    return chunked_bpe.round_trip(docs, registry.WORD_BPE)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("bpe", bpe),
]

#: Language profiles, set joins and tokenizers are beyond SQL; the tests hold line dedup,
#: near-dedup and BPE against brute-force versions, language ID against labels, and mixing
#: only against the operator's own plan.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
