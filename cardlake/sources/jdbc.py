"""JDBC table scan and append (warehouse database).

A plain ``spark.read.jdbc`` is one task over one connection.  Give either a
numeric / date / timestamp ``partition_column`` with bounds, or a list of
``predicates`` (one task each, e.g. one per day), so the scan spreads over
executors.  Filters on the result (e.g. ``date = as_of``) reach the database.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               partition_column: str | None = None, lower_bound=None, upper_bound=None,
               num_partitions: int | None = None, predicates: Sequence[str] | None = None,
               fetch_size: int = 10000) -> DataFrame:
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetch_size))
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    if partition_column:
        r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
             .option("partitionColumn", partition_column)
             .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
             .option("numPartitions", int(num_partitions or 8)))
        for k, v in props.items():
            r = r.option(k, v)
        return r.load()
    return spark.read.jdbc(url, table, properties=props)


def append_table(df: DataFrame, url: str, table: str, properties: dict | None = None,
                 writers: int = 2, batch_rows: int = 10000) -> None:
    """Append with at most ``writers`` connections and ``batch_rows`` per insert.

    For PostgreSQL, pass ``{"reWriteBatchedInserts": "true"}`` in
    ``properties`` (the driver's documented spelling) so a batch becomes
    multi-row inserts.
    """
    (df.write.mode("append").option("numPartitions", int(writers))
     .option("batchsize", int(batch_rows)).jdbc(url, table, properties=properties or {}))


def execute(spark: SparkSession, url: str, statement: str, properties: dict | None = None) -> int:
    """Run one statement on the database from the driver (e.g. a delete).

    One connection, one statement; used for the batch-scoped delete of
    the idempotent warehouse load.  Returns the update count.
    """
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, str(v))
    driver = (properties or {}).get("driver")
    if driver:
        jvm.java.lang.Class.forName(driver)
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        stmt = conn.createStatement()
        try:
            return stmt.executeUpdate(statement)
        finally:
            stmt.close()
    finally:
        conn.close()
