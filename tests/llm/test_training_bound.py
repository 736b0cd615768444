"""The training sample is bounded in rows, whatever ids repeat."""

from cardlake.llm import toxicity


def test_repeated_ids_do_not_lift_the_bound(spark):
    docs = [(1, f"text number {i}") for i in range(50)] + [(k, f"own words {k}") for k in range(2, 12)] + [(2, None)]
    labels = [(k, k % 2) for k in range(1, 12)]
    rows = toxicity.training_rows(spark.createDataFrame(docs, "doc_id long, text string"),
                                  spark.createDataFrame(labels, "doc_id long, toxic int"), max_rows=6)
    assert rows.count() <= 6
    rows = toxicity.training_rows(spark.createDataFrame(docs[:50] + docs[50:55] * 4, "doc_id long, text string"),
                                  spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert rows.count() <= 6
