"""Probability surfaces: grids, interpolation, zones, confidence, uncertainty."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators import interpolate
from gridloom.plans.quantiles import exact_quantiles

# Zone thresholds by kind of map.
ZONES = {"landslide": [0.2, 0.4, 0.6, 0.8], "mineral": [0.25, 0.5, 0.75], "generic": [0.33, 0.67]}


def regular_grid(points: DataFrame, cells: int, buffer: float = 0.1) -> DataFrame:
    """cells x cells nodes over the points' bounds and a buffer."""
    b = points.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    steps = F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))
    node = lambda i, lo, hi: F.col(lo) - buffer * (F.col(hi) - F.col(lo)) + F.col(i) * ((1 + 2 * buffer) * (F.col(hi) - F.col(lo)) / (cells - 1))
    return b.withColumn("i", steps).withColumn("j", steps).select("i", "j", node("j", "x0", "x1").alias("gx"), node("i", "y0", "y1").alias("gy"))


def near_pairs(grid: DataFrame, points: DataFrame, reach: float) -> DataFrame:
    """Nodes with all points within reach: an equi-join on squares of that size and their
    neighbours, so a node meets only what is around it."""
    square = lambda c: F.floor(F.col(c) / reach).cast("long")
    around = F.explode(F.expr("flatten(transform(sequence(-1, 1), a -> transform(sequence(-1, 1), b -> named_struct('a', a, 'b', b))))"))
    asked = grid.withColumn("o", around).withColumn("sx", square("gx") + F.col("o.a")).withColumn("sy", square("gy") + F.col("o.b")).drop("o")
    held = points.withColumn("sx", square("x")).withColumn("sy", square("y"))
    d = F.sqrt((F.col("gx") - F.col("x")) * (F.col("gx") - F.col("x")) + (F.col("gy") - F.col("y")) * (F.col("gy") - F.col("y")))
    return asked.join(held, ["sx", "sy"]).withColumn("d", d).filter(F.col("d") <= reach)


def all_pairs(grid: DataFrame, points: DataFrame) -> DataFrame:
    """Nodes with all points. The nodes are a bounded set that is broadcast; the points stream past them into sums."""
    d = F.sqrt((F.col("gx") - F.col("x")) * (F.col("gx") - F.col("x")) + (F.col("gy") - F.col("y")) * (F.col("gy") - F.col("y")))
    return points.crossJoin(F.broadcast(grid)).withColumn("d", d)


def inverse_distance(grid: DataFrame, points: DataFrame, value: str, power: float, reach: float | None = None) -> DataFrame:
    """Weighted mean of all points, or of those within reach; 0 where there is none."""
    w = 1 / F.pow(F.greatest("d", F.lit(1e-10)), F.lit(power))
    pairs = all_pairs(grid, points) if reach is None else near_pairs(grid, points, reach)
    means = pairs.groupBy("i", "j").agg((F.sum(w * F.col(value)) / F.sum(w)).alias("value"))
    return grid.join(means, ["i", "j"], "left").select("i", "j", F.coalesce("value", F.lit(0.0)).alias("value"))


def nearest_distance(grid: DataFrame, points: DataFrame) -> DataFrame:
    """Distance to the nearest point, however far; NULL without points. Nodes meet the points of their tile, and of
    larger ones until none nearer is left out."""
    near = interpolate.nearest(grid, points.withColumn("__one", F.lit(0.0)), "__one")
    return near.select(*[F.col(c).cast(grid.schema[c].dataType) for c in ("i", "j")], "distance")


def zone(score: Column, thresholds: list[float]) -> Column:
    """How many thresholds the score has reached."""
    return reduce(lambda a, t: a + (score >= t).cast("int"), sorted(thresholds), F.lit(0))


def zone_stats(df: DataFrame, score: str, thresholds: list[float]) -> DataFrame:
    per = df.groupBy(zone(F.col(score), thresholds).alias("zone")).agg(F.count("*").alias("n"), F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"))
    return per.withColumn("area_pct", F.col("n") * 100 / F.sum("n").over(Window.partitionBy()))


def surface_stats(df: DataFrame, score: str) -> DataFrame:
    quartiles = exact_quantiles(df, {"q25": (score, 0.25), "median": (score, 0.5), "q75": (score, 0.75)})
    one = df.agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"), F.min(score).alias("min"), F.max(score).alias("max"))
    return one.withColumns({n: F.lit(x).cast("double") for n, x in quartiles.items()})


def confidence(probabilities: Column) -> dict[str, Column]:
    """Largest probability, one less the relative entropy, and the margin of the two largest."""
    best = F.sort_array(probabilities, asc=False)
    entropy = F.aggregate(probabilities, F.lit(0.0), lambda a, p: a - p * F.ln(p + 1e-10))
    return {"max_probability": F.array_max(probabilities), "entropy_confidence": 1 - entropy / F.ln(F.size(probabilities)), "margin": best[0] - best[1]}


def combine_uncertainty(parts: list[Column], means: list[Column], method: str) -> Column:
    """mean, max, or weighted by the inverse of each source's mean."""
    if method == "max":
        return F.greatest(*parts)
    weights = [F.lit(1.0)] * len(parts) if method == "mean" else [1 / m for m in means]
    return sum((w * p for w, p in zip(weights, parts)), F.lit(0.0)) / sum(weights, F.lit(0.0))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b, dp, dl = F.radians(lat1), F.radians(lat2), F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    h = F.sin(dp / 2) * F.sin(dp / 2) + F.cos(a) * F.cos(b) * F.sin(dl / 2) * F.sin(dl / 2)
    return 2 * 6371.0 * F.asin(F.sqrt(h))


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")
