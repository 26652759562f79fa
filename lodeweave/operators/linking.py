"""Linking issues to changes: membership and interval joins, signals, merging, best link per key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodeweave.functions.text import closing_references


def current(df: DataFrame, key: str, *tie: str, time: str = "indexed_at") -> DataFrame:
    """The newest row per key; null keys are dropped, ties fall to the greatest of the tie columns."""
    order = Window.partitionBy(key).orderBy(F.desc_nulls_last(time), *[F.desc_nulls_last(t) for t in tie])
    return df.where(F.col(key).isNotNull()).withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def top_per_key(df: DataFrame, keys: list[str], order: Iterable[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first n rows per key; Spark cuts every group down before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(rank or "_rank", F.row_number().over(w)).where(F.col(rank or "_rank") <= n)
    return out if rank else out.drop("_rank")


def within_days(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, days: int) -> DataFrame:
    """Equal keys and times at most `days` apart, inclusive: an equi-join on key and time bucket, rechecked exactly.

    A left row falls into one bucket, a right row is offered to three, so a hot key is spread over the time axis.
    """
    width = days * 86400
    bucket = lambda c: F.floor(F.unix_timestamp(c) / width)
    a = left.where(F.col(left_time).isNotNull()).withColumn("_bucket", bucket(left_time))
    b = right.where(F.col(right_time).isNotNull()).withColumn("_bucket", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: bucket(right_time) + d)))
    apart = F.abs(F.unix_micros(left_time) - F.unix_micros(right_time)) <= width * 1_000_000
    return a.join(b, [*keys, "_bucket"]).where(apart).drop("_bucket")


def temporal_links(issues: DataFrame, pulls: DataFrame, days: int = 7, confidence: float = 0.5) -> DataFrame:
    """Issues and pulls where the author of the pull is assigned and merge and close are at most `days` apart."""
    i = issues.select("issue_number", "closed_at", F.explode("assignees").alias("author")).where("author is not null and author <> ''")
    p = pulls.where(~F.coalesce("draft", F.lit(False))).select("pr_number", "merged_at", "author")
    return (
        within_days(i, p, ["author"], "closed_at", "merged_at", days)
        .select("issue_number", "pr_number").distinct()
        .withColumn("confidence", F.lit(confidence)).withColumn("source", F.lit("temporal_author"))
    )


def body_links(pulls: DataFrame, confidence: float = 0.85) -> DataFrame:
    p = pulls.where(~F.coalesce("draft", F.lit(False)))
    return (
        p.select(F.explode(closing_references(F.col("body"))).alias("issue_number"), "pr_number").distinct()
        .withColumn("confidence", F.lit(confidence)).withColumn("source", F.lit("body_closes_keyword"))
    )


def merge_links(links: DataFrame) -> DataFrame:
    """One row per pair: the best confidence, the sorted distinct sources joined by comma, and the best confidence per source."""
    single = links.withColumn("source", F.explode(F.split("source", ",")))
    per_source = single.groupBy("issue_number", "pr_number", "source").agg(F.max("confidence").alias("confidence"))
    return per_source.groupBy("issue_number", "pr_number").agg(
        F.max("confidence").alias("confidence"),
        F.array_join(F.array_sort(F.collect_set("source")), ",").alias("source"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "confidence")))).alias("signals"),
    )


def score(signals: dict[str, tuple[Column, str]]) -> Column:
    """Sum of the weights of the signals that fired, at most 1, in exact decimals."""
    total = None
    for fired, weight in signals.values():
        part = F.when(fired, F.lit(weight).cast("decimal(3,2)")).otherwise(F.lit("0").cast("decimal(3,2)"))
        total = part if total is None else total + part
    return F.least(F.lit("1.00").cast("decimal(5,2)"), total.cast("decimal(5,2)"))


def corroborated(links: DataFrame, cap: float = 0.99) -> DataFrame:
    """Independent sources raise confidence: 1 - product(1 - c), below 1 unless a source is certain."""
    per_source = links.groupBy("issue_number", "pr_number", "source").agg(F.max("confidence").alias("c"))
    doubt = F.exp(F.sum(F.when(F.col("c") < 1, F.log(1 - F.col("c"))).otherwise(F.lit(0.0))))
    certain = F.max(F.when(F.col("c") >= 1, 1).otherwise(0))
    return per_source.groupBy("issue_number", "pr_number").agg(
        F.count(F.lit(1)).alias("sources"),
        F.round(F.when(certain == 1, F.lit(1.0)).otherwise(F.least(F.lit(cap), 1 - doubt)), 6).alias("confidence"),
    )


def co_changed(events: DataFrame, event: str, item: str, most: int = 12, support: int = 2) -> DataFrame:
    """Pairs of items that change together: events of more than `most` items are left out before any pair is made."""
    pairs = events.where(F.col(event).isNotNull() & F.col(item).isNotNull()).select(F.col(event).alias("e"), F.col(item).alias("i")).distinct()
    small = pairs.groupBy("e").agg(F.count(F.lit(1)).alias("n")).where(F.col("n").between(2, most)).select("e")
    kept = pairs.join(small, "e")
    both = kept.alias("x").join(kept.alias("y"), (F.col("x.e") == F.col("y.e")) & (F.col("x.i") != F.col("y.i")))
    return (
        both.groupBy(F.col("x.i").alias("a"), F.col("y.i").alias("b")).agg(F.count(F.lit(1)).alias("support"))
        .where(F.col("support") >= support)
        .withColumn("confidence", F.least(F.lit(0.95), F.round(F.col("support") / (F.col("support") + 2), 6)))
    )
