"""Stages of the pipeline on rows with null and repeated ids."""

import corpus_pipeline
from tests.conftest import SMOKE

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_rows_stand_or_fall_by_their_own_text(spark):
    words = " ".join(f"w{i}" for i in range(60))
    item = spark.read.parquet(f"{SMOKE}/benchmark.parquet").where("length(text) > 80").first().text
    texts = [(None, item), (None, "clean text of its own"), (5, item), (5, "a second text under id five"),
             (None, words), (3, words + " x"), (7, words + " y"), (7, words + " z"),
             (None, "only under null ids"), (None, "only under null ids"), (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], SCHEMA)
    left = corpus_pipeline.one_of_each_group(spark, docs, SMOKE)
    got = sorted((r.doc_id or 0, r.text or "") for r in left.collect())
    want = [(0, ""), (0, "clean text of its own"), (0, "only under null ids"), (3, words + " x"),
            (5, "a second text under id five"), (5, item)]
    assert got == sorted(want)
    left = corpus_pipeline.drop_leaks(spark, docs, SMOKE)
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        ((i, t) for i, t in texts if t != item), key=str)
