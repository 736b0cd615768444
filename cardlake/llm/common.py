"""Helpers that several operators share: written tables, size-checked broadcasts, components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.session import shared_path

SMALL_BYTES = 16 << 20  # a side is only ever broadcast below this, as counted


def free(df: DataFrame, name: str) -> str:
    """``name``, or with as many underscores after it as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, and a
    lost executor costs no recomputation of what came before."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(df: DataFrame) -> None:
    """Removes the files of a written table that nothing reads any more."""
    session = df.sparkSession
    jvm, conf = session._jvm, session._jsparkSession.sessionState().newHadoopConf()
    for file in df.inputFiles()[:1]:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)).getParent()
        path.getFileSystem(conf).delete(path, True)


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` (a written table), marked for broadcast if its counted rows are few
    enough; beyond that the join shuffles both sides as usual."""
    return F.broadcast(df) if df.count() * row_bytes <= SMALL_BYTES else df


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id that each linked id reaches.

    Large-star and small-star steps alternate until every link is one between
    a node and the smallest of its component.  Each step is a map-side
    combined ``min`` per node and a join on the node, so a node that holds a
    third of all links is split like any skewed join key.  Nulls and links of
    an id with itself are left out; an empty table gives an empty one.
    """
    links = written(links.where(F.col(a) != F.col(b))
                    .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
                    .distinct(), "links")
    state = _state(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        lowest = both.groupBy("hi").agg(F.least(F.min("lo"), F.col("hi")).alias("m"))
        # large star: neighbours above a node move to the smallest around it
        large = (both.join(lowest, "hi").where(F.col("lo") > F.col("hi"))
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct())
        large = written(large, "large")
        # small star: a node and its neighbours below move to the smallest below
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(lowest, "hi")
        links = written(moved.select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                        .unionByName(lowest.select("hi", F.col("m").alias("lo")))
                        .where("hi <> lo").distinct(), "links")
        before, state = state, _state(links)
        if before == state:
            break
    stars = links.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return stars.unionByName(links.select(F.col("lo").alias("id"), F.col("lo").alias("component"))
                             .distinct())


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return row[0], row[1]
