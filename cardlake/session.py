"""Session helpers for tests, the bench and the query registry.

The library never creates a session by itself; these helpers are for callers
that run on a bare machine (tests, bench).  On a cluster, pass the cluster's
own session to every function instead.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for the plans in this library.  AQE re-plans joins
# (broadcast when a side is measured small, skew split of hot partitions)
# and coalesces shuffle partitions at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # state store: Spark's default (in-memory maps + delta files) suits the
    # small state of local runs; stream_conf switches to RocksDB.
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "cardlake",
                  checkpoint_dir: str | None = None) -> SparkSession:
    """A local session with the library's settings (tests and bench only).

    ``checkpoint_dir``: the folder that a cluster would name in
    ``spark.checkpoint.dir``; the caller owns it and removes it.
    """
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores)))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if checkpoint_dir:
        b = b.config("spark.checkpoint.dir", checkpoint_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder the cluster names for checkpoints.

    Reads the session's checkpoint directory (``spark.checkpoint.dir`` or one
    set through ``setCheckpointDir``).  Only when none is configured and the
    master is local (tests, bench) a private one is created; on a cluster a
    missing setting is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a local JVM context (Spark Connect)
        sc = None
    if sc is not None:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    else:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if sc is not None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not str(master).startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                           "(a machine-local folder would be lost with its executor)")
    local = tempfile.mkdtemp(prefix="cardlake-chk-")
    if sc is not None:
        sc.setCheckpointDir(local)
    return local


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh location under the shared checkpoint folder for one run.

    Used for stream checkpoints, sink folders and lineage cuts, so that every
    executor (and a restarted driver) sees the same files.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "cardlake-runs", uuid.uuid4().hex, *parts])


MB = 1024 * 1024


def cluster_conf(input_bytes: int, total_cores: int, partition_mb: int = 256,
                 broadcast_mb: int = 64) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of columnar input.

    Apply them when building the session (``SparkSession.builder.config``);
    the library itself never changes session settings.

    * scan splits of ``partition_mb`` (``maxPartitionBytes``), so a task reads
      a bounded slice however large the files are;
    * shuffle width = input / ``partition_mb`` (at least 3 waves of the
      cluster), as AQE's initial width; AQE then coalesces small partitions
      to the advisory size and splits skewed ones in joins;
    * broadcast only below ``broadcast_mb`` as measured at run time.

    Streaming jobs take their width from ``stream_conf``.
    """
    width = max(3 * total_cores, -(-int(input_bytes) // (partition_mb * MB)))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_mb * MB),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_mb * MB),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_mb * MB),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_mb * MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_mb * MB),
        "spark.sql.session.timeZone": "UTC",
    }


def stream_conf(batch_bytes: int, state_bytes: int, total_cores: int, partition_mb: int = 64) -> dict[str, str]:
    """Settings for a session that runs the streaming jobs.

    The shuffle width of a stateful query is fixed in its checkpoint and AQE
    doesn't coalesce it, and each partition is a state store of its own; so it
    follows the rows of one batch and the state kept between batches, never
    the size of the corpus.  Apply over ``cluster_conf`` where one session
    does both.
    """
    width = max(total_cores, -(-max(int(batch_bytes), int(state_bytes)) // (partition_mb * MB)))
    return {
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
