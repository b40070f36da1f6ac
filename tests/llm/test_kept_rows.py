"""The pipeline keeps one row of a group, also where identifiers repeat."""

import corpus_pipeline


def test_one_row_of_a_group(spark):
    long = " ".join(f"w{i}" for i in range(80))
    other = " ".join(f"v{i}" for i in range(80))
    rows = [(1, long, "en"), (2, long, "en"), (2, other, "en"), (None, long, "en"), (None, "one more text", "en"), (3, "twice", "en"), (3, "twice", "de"), (4, None, None), (4, "", None)]
    docs = spark.createDataFrame([(i, t, lang, None, None) for i, t, lang in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    out = [(r.doc_id, r.text or "") for r in corpus_pipeline.remove_near_duplicates(spark, docs, "").collect()]
    assert sorted(out, key=str) == sorted([(1, long), (2, other), (None, "one more text"), (3, "twice"), (4, "")], key=str)
