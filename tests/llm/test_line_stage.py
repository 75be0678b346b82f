"""The line stage against plain Python, single lines included."""

import re

import corpus_pipeline

WORD = re.compile(r"[^\x20\x09-\x0D]")


def kept_lines(rows):
    seen, pairs, out = set(), set(), {}
    for doc_id, text in rows:
        lines = text.split("\n")
        gone = set()
        for i, line in enumerate(lines):
            if line in seen and WORD.search(line):
                gone.add(i)
            seen.add(line)
            pair = tuple(lines[i : i + 2])
            if len(pair) == 2:
                if pair in pairs:
                    gone |= {i, i + 1}
                pairs.add(pair)
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        if not gone or WORD.search(kept):
            out[doc_id] = kept
    return out


def test_single_lines_go_and_blank_lines_stay(spark):
    texts = ["licence line\n\na\nb", "x\nlicence line\n\ny", "a", "p\n\nq\nlicence line\nr", "", " ", "licence line\n ", "a\n\nb"]
    rows = list(enumerate(texts))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    table = table.selectExpr("*", "cast(null as string) lang", "'s' source", "length(text) n_chars")
    found = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, table, "").collect()}
    assert found == kept_lines(rows)
    assert found[1] == "x\ny" and found[3] == "p\n\nq\nr" and not {2, 6, 7} & set(found)


def test_line_stage_of_documents(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in table.where("text is not null").collect())
    found = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, table, sf_dir).where("text is not null").collect()}
    assert found == kept_lines(rows)
