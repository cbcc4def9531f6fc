"""Seasonal and tumbling windows, the same in batch and in a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Months of the seasons.
SEASONS = {"pre_monsoon": (4, 5), "monsoon": (6, 7, 8, 9), "post_monsoon": (10, 11)}


def season_of(ts: Column) -> Column:
    """The season's name, else NULL."""
    out = F.lit(None).cast("string")
    for name, months in SEASONS.items():
        out = F.when(F.month(ts).isin(*months), F.lit(name)).otherwise(out)
    return out


def windowed(events: DataFrame, width: str = "6 hours", late: str = "1 hour") -> DataFrame:
    """Count and sum per window and type; on a stream, rows later than ``late`` are dropped and state is freed."""
    timely = events.withWatermark("ts", late) if events.isStreaming else events
    per = timely.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return per.select(F.col("window.start").alias("start"), "event_type", "n", "total")
