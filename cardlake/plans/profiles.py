"""A profile that grows by loads: each load is read once, history not at all.

A load leaves its part (rows and nulls of each column, a sketch of its values, its
repeated keys against the index of known ids) in a folder of its own; a load that
is profiled again replaces it.  The profile adds the parts up, a few rows a load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.operators import quality
from cardlake.plans.key_index import KeyIndex
from cardlake.streaming.card_batches import replace_load

PART = "column_name string, row_count long, null_count long, sketch binary, duplicates long, load_id string"


def profile_load(load: DataFrame, load_id: str, path: str, index: KeyIndex) -> None:
    """Write the part of a load and enter its keys into the index."""
    repeated = index.duplicates(load, load_id)
    replace_load(quality.profile_parts(load).withColumn("duplicates", F.lit(repeated).cast("long")), path, load_id)
    index.add(load, load_id)


def read_profile(spark: SparkSession, path: str, distinct: bool = True) -> DataFrame:
    """The profile of all loads so far; see ``quality.profile_of``."""
    parts = spark.read.schema(PART).parquet(path)
    # every column's rows of a load carry the load's number
    total = parts.groupBy("load_id").agg(F.max("duplicates").alias("d")).agg(F.sum("d")).scalar()
    return quality.profile_of(parts, total, distinct)
