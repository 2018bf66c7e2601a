"""Work tables of one operator run, kept in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Frees a query's shuffle files when it ends, so a chain of written tables
# never holds more than one step's shuffle on disk.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or set on the context.

    A scratch folder is made only on a local master with nothing set (tests).
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    d = tempfile.mkdtemp(prefix="spendmatch-llm-")
    spark.sparkContext.setCheckpointDir(d)
    return d


@contextmanager
def session_conf(spark: SparkSession, **conf: str):
    """Set session settings for the duration of a block (``__`` stands for a dot)."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Work:
    """Writes intermediates as Parquet tables, which cuts lineage and outlives lost executors.

    ``table`` writes and rereads; ``drop`` removes tables that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"

    def table(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        path = f"{self.base}/{name}"
        with session_conf(self.spark, **{SHUFFLE_CLEANUP: "true"}):
            df.write.mode("errorifexists").option("compression", "zstd").partitionBy(*(partition_by or [])).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        for n in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{n}")
            path.getFileSystem(conf).delete(path, True)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
