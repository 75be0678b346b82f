"""The language stage where nothing can be learnt."""

import corpus_pipeline


def test_without_labels_only_texts_without_a_letter_go(spark):
    texts = ["A clean text.", "日本語", "123 !?", "", None, "é 1"]
    table = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    kept = corpus_pipeline.language_id(spark, table, "")
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 5]
