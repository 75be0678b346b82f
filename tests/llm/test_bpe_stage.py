"""The last stage against the tokenizers library, repeated rows included."""

import hashlib

from tokenizers import Tokenizer

import corpus_pipeline
from postlake.llm import registry


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_bpe_stage_as_the_library(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    table = table.union(table.where("doc_id % 3 = 0"))
    library, want = Tokenizer.from_file(registry.WORD_BPE), []
    for row in table.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((row.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(decoded)))
    assert sorted(map(tuple, corpus_pipeline.bpe(spark, table, sf_dir).collect())) == sorted(want)
