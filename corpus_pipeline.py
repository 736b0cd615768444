"""Corpus pipeline: documents in, documents ready for training out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All stages but the
last return the columns of ``documents``.

Rows with null or repeated ids are allowed: decisions hold for an id (or none)
with its text, so every row stands or falls by its own text; rows that repeat
an id and its text are one document after the join stage.  Further columns of
any name pass through the first four stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm import decontaminate, jaccard, line_templates, pieces, toxicity
from cardlake.llm.common import free, small, written


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with one more column, and its name: hash of the text and, unless null, the id."""
    key = free(docs, "__key")
    return docs.withColumn(key, F.concat_ws(":", F.xxhash64("text").cast("string"), F.col("doc_id").cast("string"))), key


def _without(docs: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Keyed ``docs`` but for the rows with these keys (a written table of them)."""
    return docs.join(small(keys, 64), key, "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    score = free(docs, "__score")
    return toxicity.with_score(docs, model, score=score).where(F.col(score) < 0.5).drop(score)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines whose template recurs; ``n_chars`` follows the text."""
    kept = line_templates.drop_recurring(docs)
    return kept.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                           .otherwise(F.char_length("text").cast("long")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by 5-word shingle similarity the one with the smallest id."""
    keyed, key = _keyed(docs)
    groups = written(jaccard.similar_groups(keyed, key=key), "groups")
    kind = dict(docs.dtypes)["doc_id"]
    at = F.instr(key, ":")
    number = F.when(at > 0, F.col(key).substr(at + 1, F.length(key))).cast(kind)
    # null ids last, then by id
    first = groups.groupBy("component_id").agg(F.min(F.struct(
        number.isNull().alias("none"), number.alias("id"), F.col(key).alias("key")))["key"].alias("first"))
    copies = (groups.join(written(first, "firsts"), "component_id").where(F.col(key) != F.col("first"))
              .select(key).distinct())
    kept = _without(keyed, key, written(copies, "copies"))
    twice = written(groups.groupBy(key).count().where("count > 1").select(key), "twice")
    if twice.isEmpty():
        return kept.drop(key)
    once = _without(kept, key, twice)
    again = kept.join(small(twice, 64), key, "left_semi").dropDuplicates([key, "text"])
    return once.unionByName(again).drop(key)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed, key = _keyed(docs)
    leaks = decontaminate.leaks(keyed, items, key=key)
    return _without(keyed, key, written(leaks.select(key).distinct(), "leaks")).drop(key)


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the ids of their texts, and whether decoding gives the text back."""
    return pieces.with_ids(docs, pieces.load_vocabulary(), same="same_text")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", drop_leaks),
    ("SentencePiece encoding and decoding", to_ids),
]

#: A learned score and a chain of groups and templates: tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
