"""References to records that do not exist, from signed counts per key.

Every source of references and of records is turned into change deltas: +1 when a
reference is first stored, +1 when a record appears, -1 when it is withdrawn, nothing
when it is only delivered again. Sums of the deltas per key are the state; a key with
positive references and zero existence is an orphan. Sums are pre-aggregated before
the shuffle, so one key with a tenth of the rows is one row a task.

The state of a key also keeps its last row (time, and whether it withdraws), so the
deltas of a further batch are taken against what is stored: a record delivered again
adds nothing, a withdrawal takes its one away, a late row changes only the first time.
References are counted once, when they are first seen.

Null targets are no reference; null numbers are no record. Repeated rows are one
reference at their earliest time; a record's rows at the same latest time count as
withdrawn if one of them is. Missing times never make a reference early or late.
Other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def references(source: DataFrame, table: str, key: Column, target: str, time: str) -> DataFrame:
    """Distinct references of one table: (ref_table, ref_key, target_key, first_at)."""
    return (
        source.where(F.col(target).isNotNull())
        .select(F.lit(table).alias("ref_table"), F.coalesce(key.cast("string"), F.lit("")).alias("ref_key"), F.col(target).cast("bigint").alias("target_key"), F.col(time).alias("at"))
        .groupBy("ref_table", "ref_key", "target_key")
        .agg(F.min("at").alias("first_at"))
    )


def reference_deltas(refs: DataFrame) -> DataFrame:
    return refs.select("target_key", F.lit(1).alias("refs"), F.lit(0).alias("present"), F.col("first_at").alias("at"))


def existence_deltas(records: DataFrame, number: str) -> DataFrame:
    """Rows of records in order of storing -> (target_key, refs, present, at) with present +1, -1 or 0."""
    state = F.when(F.col("deleted_at").isNull(), 1).otherwise(0)
    per_time = (
        records.where(F.col(number).isNotNull())
        .select(F.col(number).cast("bigint").alias("target_key"), F.col("indexed_at").alias("at"), state.alias("state"))
        .groupBy("target_key", "at")
        .agg(F.min("state").alias("state"))
    )
    before = F.lag("state", 1, 0).over(Window.partitionBy("target_key").orderBy("at"))
    return per_time.select("target_key", F.lit(0).alias("refs"), (F.col("state") - before).alias("present"), "at")


def key_state(deltas: DataFrame) -> DataFrame:
    """Deltas -> state per key: (target_key, refs, present, first_row) with first_row the earliest row of the record."""
    return deltas.groupBy("target_key").agg(
        F.sum("refs").cast("bigint").alias("refs"),
        F.sum("present").cast("bigint").alias("present"),
        F.min(F.when(F.col("refs") == 0, F.col("at"))).alias("first_row"),
        F.max(F.when(F.col("refs") == 0, 1).otherwise(0)).alias("known"),
    )


STATE = "target_key bigint, refs bigint, present bigint, first_row timestamp, last struct<at: timestamp, gone: int>"


def batch_deltas(state: DataFrame, new_refs: DataFrame, records: DataFrame, number: str) -> DataFrame:
    """Signed deltas per key of a batch against the stored state: new references, and rows of records in any order."""
    gone = F.when(F.col("deleted_at").isNull(), 0).otherwise(1)
    rows = (
        records.where(F.col(number).isNotNull())
        .select(F.col(number).cast("bigint").alias("target_key"), F.struct(F.col("indexed_at").alias("at"), gone.alias("gone")).alias("row"))
        .groupBy("target_key").agg(F.min("row.at").alias("first_row"), F.max("row").alias("last"))
    )
    stored = state.select("target_key", F.col("present").alias("was"), F.col("last").alias("stored"))
    last = F.greatest("last", "stored")
    existence = rows.join(stored, "target_key", "left").select(
        "target_key", F.lit(0).cast("bigint").alias("refs"), (1 - last["gone"] - F.coalesce("was", F.lit(0))).cast("bigint").alias("present"), "first_row", last.alias("last")
    )
    nothing = F.lit(None)
    counted = new_refs.groupBy("target_key").agg(F.count(F.lit(1)).alias("refs")).select(
        "target_key", "refs", F.lit(0).cast("bigint").alias("present"), nothing.cast("timestamp").alias("first_row"), nothing.cast("struct<at: timestamp, gone: int>").alias("last")
    )
    return existence.unionByName(counted)


def add_deltas(state: DataFrame, deltas: DataFrame) -> DataFrame:
    """The state after a batch of deltas: sums of the signed counts, the earliest and the last row."""
    return state.unionByName(deltas).groupBy("target_key").agg(
        F.sum("refs").alias("refs"), F.sum("present").alias("present"), F.min("first_row").alias("first_row"), F.max("last").alias("last")
    )


def unseen(refs: DataFrame, seen: DataFrame) -> DataFrame:
    """References of a batch that no batch before it has brought."""
    return refs.join(seen, ["ref_table", "ref_key", "target_key"], "left_anti")


def orphans_of_state(state: DataFrame) -> DataFrame:
    """Keys with positive references and zero existence: (target_key, refs, reason)."""
    return state.where("refs > 0 and present = 0").select("target_key", "refs", F.when(F.col("last").isNotNull(), "withdrawn").otherwise("missing").alias("reason"))


def orphan_keys(state: DataFrame) -> DataFrame:
    return state.where("refs > 0 and present = 0").select("target_key", "refs", F.when(F.col("known") == 1, "withdrawn").otherwise("missing").alias("reason"))


def orphan_references(refs: DataFrame, records: DataFrame, number: str) -> DataFrame:
    """(ref_table, ref_key, target_key, first_at, reason): missing, withdrawn or arrived later than the reference."""
    state = key_state(reference_deltas(refs).unionByName(existence_deltas(records, number)))
    doubtful = state.where("refs > 0").select("target_key", "present", "known", "first_row")
    reason = (
        F.when(F.col("known") == 0, "missing")
        .when(F.col("present") == 0, "withdrawn")
        .when(F.col("first_row") > F.col("first_at"), "later")
    )
    return refs.join(doubtful, "target_key").select("ref_table", "ref_key", "target_key", "first_at", reason.alias("reason")).where("reason is not null")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
