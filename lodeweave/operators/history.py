"""Versioned state: newest rows, slowly changing facts, as-of lookups, stale entries, manifests, islands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def changes_only(rows: DataFrame, keys: list[str], value: str, time: str, *tie: str) -> DataFrame:
    """Rows whose value differs from the one before, null-safe; the first row of a key always counts."""
    w = Window.partitionBy(*keys).orderBy(time, *tie)
    first = F.row_number().over(w) == 1
    return rows.withColumn("_new", first | ~F.col(value).eqNullSafe(F.lag(value).over(w))).where("_new").drop("_new")


def intervals(rows: DataFrame, keys: list[str], time: str, *tie: str) -> DataFrame:
    """valid_from and valid_to for each row: it ends where the next row of its key begins; the current one is open."""
    w = Window.partitionBy(*keys).orderBy(time, *tie)
    return rows.withColumn("valid_from", F.col(time)).withColumn("valid_to", F.lead(time).over(w))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, values: list[str]) -> DataFrame:
    """For each left row the values of the newest right row at or before its time: one union and one window, no range join."""
    columns = [c for c in left.columns if c not in keys]
    l = left.select(*keys, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.struct(*columns).alias("_l"), F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType).alias("_r"))
    r = right.where(F.col(right_time).isNotNull()).select(*keys, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(l.schema["_l"].dataType).alias("_l"), F.struct(*values).alias("_r"))
    w = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    out = l.unionByName(r).withColumn("_last", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
    return out.select(*keys, "_l.*", *[F.col(f"_last.{v}").alias(v) for v in values])


def upsert(stored: DataFrame, incoming: DataFrame, keys: list[str], keep: list[str] | None = None) -> DataFrame:
    """Incoming rows replace stored ones of their key, but for the `keep` columns, which stay as first stored."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    w = Window.partitionBy(*keys).orderBy(F.desc("_new"))
    out = both.withColumn("_rank", F.row_number().over(w))
    old = Window.partitionBy(*keys).orderBy("_new").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    for c in keep or []:
        out = out.withColumn(c, F.first(c, ignorenulls=True).over(old))
    return out.where("_rank = 1").drop("_rank", "_new")


def upsert_links(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """A link is overwritten only by strictly higher confidence; stored links win ties."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    w = Window.partitionBy("issue_number", "pr_number").orderBy(F.desc("confidence"), "_new")
    return both.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank", "_new")


def archived(facts: DataFrame, present: DataFrame, keys: list[str], at: Column) -> DataFrame:
    """Open facts whose source has vanished get an end; keys keep the pruning within their repository."""
    seen = present.select(*keys).distinct().withColumn("_seen", F.lit(1))
    return facts.join(seen, keys, "left").withColumn("valid_to", F.coalesce("valid_to", F.when(F.col("_seen").isNull(), at))).drop("_seen")


def checksum(df: DataFrame, columns: list[str]) -> Column:
    """Order-insensitive checksum of rows: sum of the first 8 hex digits of the MD5 of the columns joined by |."""
    joined = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    return F.sum(F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint"))


def runs(rows: DataFrame, keys: list[str], flag: Column, order: list[str]) -> DataFrame:
    """Unbroken runs of rows where the flag holds: (keys, first, length), by the difference of row numbers."""
    by = rows.withColumn("_f", flag)
    a = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    b = F.row_number().over(Window.partitionBy(*keys, "_f").orderBy(*order))
    return by.withColumn("_g", a - b).where("_f").groupBy(*keys, "_g").agg(F.min(order[0]).alias("first"), F.count(F.lit(1)).alias("length")).drop("_g")


def decayed(confidence: Column, age_days: Column, half_life: float = 60.0) -> Column:
    return confidence * F.pow(F.lit(0.5), age_days / F.lit(half_life))
