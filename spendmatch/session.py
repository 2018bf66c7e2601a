"""Session helpers.

The library never creates a global session on import.  ``get_spark`` is for
scripts and tests; library operators take the session (or a DataFrame) they
are given and only read settings from it.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on.  AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is small), coalesces small shuffle
# partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # broadcast bounds: the static planner broadcasts a side whose size
    # estimate is under 10 MB.  A file's estimate is its compressed size times
    # fileCompressionFactor, set so that it covers the rows in memory; AQE
    # re-plans with measured shuffle sizes up to 32 MB.
    # (Static broadcast off was measured 1.8x slower: every small-dimension
    # join then shuffles its large side first.)
    "spark.sql.sources.fileCompressionFactor": "5.0",
    "spark.sql.autoBroadcastJoinThreshold": str(10 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 << 20),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.driver.memory": "8g",
    # small inputs still split into one partition per core (no effect on
    # large files, which split at maxPartitionBytes anyway)
    "spark.sql.files.openCostInBytes": str(1 << 20),
}


def get_spark(master: str | None = None, app: str = "spendmatch", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder: ``spark.checkpoint.dir``, or the context's.

    On a cluster one of them must name a shared, durable location so a lost
    executor never loses cut lineage; without one this raises.  Only on a local
    master (tests) is a scratch folder made.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="spendmatch-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a written table on whatever file system holds it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def materialize(df, name: str | None = None, made: list | None = None):
    """Cut the lineage of a reused intermediate by writing it as a table.

    The table goes to ``<spark.checkpoint.dir>/tables/<name>-<uuid>`` — the
    shared, durable folder the cluster names — as Parquet, and is read back.
    Unlike ``localCheckpoint`` the data survives executor loss; unlike an RDD
    checkpoint (row-serialised objects) the copy is columnar, so later reads
    prune columns and push filters down, and its size is known to AQE.
    ``made`` collects the path, for :func:`drop_table`.
    """
    import uuid
    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name or 'm'}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)   # read a few times at most, so size counts
    if made is not None:
        made.append(path)
    return spark.read.parquet(path)


def materialize_bucketed(df, keys: list[str], buckets: int, made: list | None = None):
    """:func:`materialize` in hash buckets of ``keys``: joins and groupings by them then shuffle nothing.

    Rows go straight to their bucket's file (each task holds one open file per
    bucket), so the write neither shuffles nor sorts.  Tables that are joined
    need the same number of buckets.
    """
    import uuid
    spark = df.sparkSession
    name = f"buckets_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}"
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(writers)
    spark.conf.set(writers, str(buckets))
    try:
        df.write.bucketBy(buckets, *keys).option("path", path).option("compression", "zstd").saveAsTable(name, format="parquet")
    finally:
        spark.conf.set(writers, old)
    if made is not None:
        made.append(path)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")   # the name only; the files stay
    return table


BROADCAST_ROWS = 1_000_000


def bounded_broadcast(df, most: int = BROADCAST_ROWS):
    """``df`` with a broadcast hint if it has at most ``most`` rows, counted first; as it is otherwise.

    For narrow dimensions that a wide table meets: the planner's estimate of a
    dimension behind projections and aggregates is too coarse to see that it is small.
    """
    from pyspark.sql import functions as F
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def env_cpus(default: int = 8) -> int:
    try:
        return int(os.environ.get("BENCH_CPUS", default))
    except ValueError:
        return default
