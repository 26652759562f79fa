"""Event-time windows over monitoring records, the same for tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def tumbling(events: DataFrame, time: str, width: str, *keys: str) -> DataFrame:
    w = F.window(time, width)
    return _measures(events.groupBy(w.alias("w"), *keys)).select(F.col("w.start").alias("window_start"), *keys, "n", "total", "highest")


def sliding(events: DataFrame, time: str, width: str, slide: str, *keys: str) -> DataFrame:
    w = F.window(time, width, slide)
    return _measures(events.groupBy(w.alias("w"), *keys)).select(F.col("w.start").alias("window_start"), *keys, "n", "total", "highest")


def sessions(events: DataFrame, time: str, gap: str, *keys: str) -> DataFrame:
    w = F.session_window(time, gap)
    return _measures(events.groupBy(w.alias("w"), *keys)).select(F.col("w.start").alias("window_start"), *keys, "n", "total", "highest")


def _measures(grouped) -> DataFrame:
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"), F.max("value").alias("highest"))
