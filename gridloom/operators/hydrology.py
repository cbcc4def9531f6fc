"""Pit filling, flow accumulation, and the indices made from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.focal import disk, offsets_join
from gridloom.operators.terrain import flow_direction, slope_aspect
from gridloom.plans.lineage import dropped, stored

# The eight neighbours, by row, then column.
STEPS = [(-1, -1), (-1, 0), (-1, 1), (0, -1), (0, 1), (1, -1), (1, 0), (1, 1)]


def fill_pits(df: DataFrame, value: str, radius: int, rows: int, cols: int) -> DataFrame:
    """The higher of a cell and its grey closing: the lowest of the highest values around."""
    out = df.select("row", "col", F.col(value).alias("closed"))
    for pick in (F.max, F.min):
        out = offsets_join(out, "closed", disk(radius), rows, cols).groupBy("row", "col").agg(pick("value").alias("closed"))
    return df.join(out, ["row", "col"]).withColumn("filled", F.greatest(value, "closed")).drop("closed")


def flow_accumulation(df: DataFrame, value: str = "elevation") -> DataFrame:
    """Cells that drain through each cell, itself included, and their log10.

    Path doubling: with the sums over upstream paths shorter than d and each cell's d-th cell
    downstream, one join gives both for 2 d. Rounds follow the log of the longest path, to its end:
    each step falls strictly, so no path meets itself.
    """
    fall = flow_direction(df, value)
    move = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in STEPS])
    step = move[F.col("direction")]
    state = stored(fall.select(
        "row", "col", F.lit(1).cast("long").alias("cells"),
        F.when(F.col("direction") >= 0, F.struct((F.col("row") + step["r"]).alias("row"), (F.col("col") + step["c"]).alias("col"))).alias("to"),
    ))
    while not state.filter(F.col("to").isNotNull()).isEmpty():
        arriving = state.filter(F.col("to").isNotNull()).groupBy(F.col("to.row").alias("row"), F.col("to.col").alias("col")).agg(F.sum("cells").alias("more"))
        ahead = state.select(F.struct("row", "col").alias("to"), F.col("to").alias("next"))
        after = stored(
            state.join(arriving, ["row", "col"], "left").join(ahead, "to", "left")
            .select("row", "col", (F.col("cells") + F.coalesce("more", F.lit(0))).alias("cells"), F.col("next").alias("to"))
        )
        dropped(state)
        state = after
    return state.select("row", "col", "cells", F.log10(F.col("cells") + 1.0).alias("accumulation"))


def wetness(df: DataFrame, value: str = "elevation") -> DataFrame:
    """Stream power and topographic wetness; 0 where the logarithm has none."""
    tangent = F.tan(F.radians("slope"))
    both = slope_aspect(df, value).join(flow_accumulation(df, value), ["row", "col"])
    log = lambda x: F.coalesce(F.when(x > 0, F.ln(x)), F.lit(0.0))
    return both.withColumns({"spi": log(F.col("accumulation") * tangent), "twi": log(F.try_divide(F.col("accumulation"), tangent))})
