"""Monitoring streams: event-time windows behind a watermark, duplicates dropped within it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lodeweave.operators import monitoring as M


def windowed(stream: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    """Tumbling measures per key; rows later than `late` behind the newest are left out."""
    return M.tumbling(stream.withWatermark(time, late), time, width, *keys)


def distinct_within(stream: DataFrame, time: str, late: str, *keys: str) -> DataFrame:
    """Rows read twice by overlapping polls count once."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))
