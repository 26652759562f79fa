"""Incremental indexing: bounded streams that fold new rows into keyed tables, once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodeweave.operators import references as R
from lodeweave.operators.history import upsert_links
from lodeweave.operators.linking import current
from lodeweave.session import materialize
from lodeweave.sources.snapshots import KeyedTable


def run_available(stream: DataFrame, checkpoint: str, each) -> None:
    """Processes all that is there in micro-batches and stops; a restart goes on after the last committed batch."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def upsert_newest(table: KeyedTable, key: str, *tie: str, time: str = "indexed_at"):
    """Batch function: the newest row per key of stored and new rows stays. A batch delivered again changes nothing; late rows lose."""
    return lambda batch, number: table.merge(batch, lambda stored, new: current(stored.unionByName(new), key, *tie, time=time))


def watermark_of(table: KeyedTable, time: str = "indexed_at"):
    """The time up to which a table is filled: the greatest of all batches, so a late batch never moves it back; null before the first."""
    return table.read().agg(F.max(time)).first()[0]


def upgrade_links(table: KeyedTable):
    """Batch function over links: a pair keeps its strongest confidence, and a late link of a better source takes a weaker one's place."""
    return lambda batch, number: table.merge(batch, upsert_links)


def replace_children(table: KeyedTable, parent: str, version: str = "indexed_at"):
    """Batch function over the parts of whole records: the parts of the newest version of a parent replace all its older ones."""

    def combine(stored: DataFrame, new: DataFrame) -> DataFrame:
        both = stored.unionByName(new)
        newest = both.groupBy(parent).agg(F.max(version).alias("_newest"))
        return both.join(newest, parent).where(F.col(version).eqNullSafe(F.col("_newest"))).drop("_newest").distinct()

    return lambda batch, number: table.merge(batch, combine)


def fold_references(keys: KeyedTable, seen: KeyedTable, number_column: str, kinds: Callable[[DataFrame], tuple[DataFrame, DataFrame]]):
    """Batch function: kinds(batch) -> (references, rows of records); keys holds the signed counts, seen the references counted.

    A row of keys remembers the batch that last changed it and a reference the batch that brought it, so a batch that was
    interrupted between the two writes, or is delivered again, is counted once.
    """

    def each(batch: DataFrame, number: int) -> None:
        refs, records = kinds(batch)
        before = seen.read().where(F.col("batch") < number)
        fresh = R.unseen(refs, before.select("ref_table", "ref_key", "target_key"))
        state = keys.read()
        deltas = R.batch_deltas(state.drop("batch"), fresh, records, number_column)
        done = state.where(F.col("batch") >= number).select("target_key")

        def add(stored: DataFrame, new: DataFrame) -> DataFrame:
            touched = new.select("target_key").distinct().withColumn("batch_now", F.lit(number))
            marks = stored.select("target_key", "batch").join(touched, "target_key", "full").select("target_key", F.greatest("batch", "batch_now").alias("batch"))
            return R.add_deltas(stored.drop("batch"), new).join(marks, "target_key")

        keys.merge(deltas.join(done, "target_key", "left_anti"), add)
        seen.merge(fresh.withColumn("batch", F.lit(number)), lambda stored, new: stored.unionByName(new).groupBy("ref_table", "ref_key", "target_key").agg(F.min("first_at").alias("first_at"), F.min("batch").alias("batch")))

    return each


def refresh_all(table: KeyedTable, rows: DataFrame) -> None:
    """The table is what the source holds now: every row comes in, and keys that are gone from the source go."""
    rows = rows.select(*table.schema.fieldNames())
    gone = materialize(table.read().select(*table.keys).distinct().join(rows.select(*table.keys).distinct(), table.keys, "left_anti"), "gone")
    table.merge(rows, lambda stored, new: new.distinct())
    table.remove(gone)


def refresh_if_moved(table: KeyedTable, rows: DataFrame, time: str = "indexed_at", *tie: str) -> bool:
    """Takes in rows newer than the watermark, if there are any; whether there were. A second call does nothing."""
    mark = watermark_of(table, time)
    fresh = rows if mark is None else rows.where(F.col(time) > mark)
    if fresh.isEmpty():
        return False
    upsert_newest(table, table.keys[0], *tie, time=time)(fresh.select(*table.schema.fieldNames()), 0)
    return True


def refresh_one(table: KeyedTable, rows: DataFrame, value) -> None:
    """Takes one key from the source as it is there now: its rows replace the stored ones."""
    key = table.keys[0]
    table.merge(rows.where(F.col(key) == value).select(*table.schema.fieldNames()), lambda stored, new: stored.where(F.col(key) != value).unionByName(new))
