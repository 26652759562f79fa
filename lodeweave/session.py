"""Session builder, table reader and scratch tables in the shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster passes its own."""
    builder = SparkSession.builder.master(master).appName("lodeweave")
    for key, value in {**DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_spread(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The table for work that is heavy a row: dealt to all cores where it lies in fewer pieces than there are cores, else as it is."""
    df = read(spark, sf_dir, name, *columns)
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a folder of our own only on a local master where the session names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        root = "file://" + folder
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there, and a lost executor costs no recompute."""
    path = f"{scratch_root(df.sparkSession)}/lodeweave/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(table: DataFrame) -> None:
    """Removes a scratch table that nothing reads any more: rounds of a loop do not pile up in the shared folder."""
    if path := getattr(table, "_scratch", None):
        spark = table.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
