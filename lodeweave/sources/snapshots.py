"""Keyed tables that batches are merged into, and sinks of samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lodeweave.session import materialize


class KeyedTable:
    """A Parquet folder partitioned by the hash of its key; a merge rewrites the partitions that a batch touches and no others.

    A merge must give the same when it is run again on its own result, for a batch may be delivered twice.
    """

    def __init__(self, spark: SparkSession, path: str, key: str | list[str], schema: str | StructType, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.keys = [key] if isinstance(key, str) else key
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _stored(self) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
            return self._bucketed(self.spark.createDataFrame([], self.schema))
        return self.spark.read.schema(StructType([*self.schema.fields]).add("_bucket", "integer")).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop("_bucket")

    def merge(self, batch: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """combine(stored rows of the touched partitions, batch) -> the rows that stand there afterwards."""
        touched = [r[0] for r in self._bucketed(batch).select("_bucket").distinct().collect()]  # at most so many as buckets
        if not touched:
            return
        stored = self._stored().where(F.col("_bucket").isin(touched)).drop("_bucket")
        after = materialize(combine(stored, batch).select(*self.schema.fieldNames()), "merged")  # a folder is not read while it is written
        self._bucketed(after).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("_bucket").parquet(self.path)


    def remove(self, keys: DataFrame) -> None:
        """Drops the rows of some keys. A partition that is left without rows keeps an empty file, so that it is overwritten."""
        touched = [r[0] for r in self._bucketed(keys).select("_bucket").distinct().collect()]
        if touched:
            stored = self._stored().where(F.col("_bucket").isin(touched))
            after = materialize(stored.join(keys.select(*self.keys).distinct(), self.keys, "left_anti"), "removed")
            left = {r[0] for r in after.select("_bucket").distinct().collect()}
            after.select(*self.schema.fieldNames(), "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("_bucket").parquet(self.path)
            for bucket in set(touched) - left:
                self.spark.createDataFrame([], self.schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_bucket={bucket}")


def write_report(tasks: DataFrame, path: str, **summary) -> None:
    """Evaluation rows as JSON lines beside one line of figures; the text of responses is not stored."""
    tasks.drop("response").write.mode("overwrite").option("ignoreNullFields", "true").json(f"{path}/tasks")
    tasks.sparkSession.createDataFrame([summary]).coalesce(1).write.mode("overwrite").json(f"{path}/summary")


def write_samples(samples: DataFrame, path: str) -> None:
    """JSON lines in one folder per split; null fields are left out."""
    samples.write.partitionBy("split").option("ignoreNullFields", "true").json(path)


def read_text_only(spark: SparkSession, path: str) -> DataFrame:
    """Only the text of JSON lines, whatever else the lines hold; blank lines are skipped."""
    return spark.read.schema("text string").json(path).where("text is not null")


def manifest(samples: DataFrame, **about) -> dict:
    """Counts per split beside what is told about the build."""
    totals = {r["split"]: r["n"] for r in samples.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {**about, "totals": totals}
