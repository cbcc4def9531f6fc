"""Distances, areas and zones on the ground."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.surface import haversine_km, utm_zone

# Metres of a degree, as pixel sizes and displacements take it.
PIXEL_DEGREE, SHIFT_DEGREE = 111_320.0, 111_000.0


def euclidean(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))


def box_area_km2(west: Column, south: Column, east: Column, north: Column, geographic: bool = True) -> Column:
    """Width along the south side times height; of projected boxes in metres the plain product."""
    if not geographic:
        return F.abs(east - west) * F.abs(north - south) / 1e6
    return haversine_km(south, west, south, east) * haversine_km(south, west, north, west)


def utm_epsg(lon: Column, lat: Column) -> Column:
    return F.when(lat >= 0, 32600).otherwise(32700) + utm_zone(lon)


def pixel_metres(size: Column, geographic: bool = True) -> Column:
    return size * PIXEL_DEGREE if geographic else size


def within(points: DataFrame, centres: DataFrame, distance: float) -> DataFrame:
    """Points (x, y) in the buffer of a centre (cx, cy): an equi-join on squares of that size, then the distance."""
    square = lambda c: F.floor(F.col(c) / distance).cast("long")
    steps = F.explode(F.expr("sequence(-1, 1)"))
    around = centres.withColumn("__i", steps).withColumn("__j", steps).withColumn("__sx", square("cx") + F.col("__i")).withColumn("__sy", square("cy") + F.col("__j"))
    held = points.withColumn("__sx", square("x")).withColumn("__sy", square("y"))
    near = euclidean(F.col("x"), F.col("y"), F.col("cx"), F.col("cy")) <= distance
    return held.join(around.drop("__i", "__j"), ["__sx", "__sy"]).filter(near).drop("__sx", "__sy")


def displacement(dx: Column, dy: Column, geographic: bool = False) -> dict[str, Column]:
    """Error of a shifted scene: RMSE, and the 90 % circular error of a normal distribution."""
    factor = SHIFT_DEGREE if geographic else 1.0
    rmse = F.sqrt(dx * dx + dy * dy) * factor
    return {"rmse": rmse, "ce90": rmse * 1.645}


def reference_scene(scenes: DataFrame, rule: str = "auto", target: float | None = None) -> DataFrame:
    """The one scene (resolution, width, height) that others are aligned to: of the closest resolution to the target (or
    the mean), of the finest, or of the largest extent; of equals the first by name."""
    if rule == "highest":
        key = F.col("resolution")
    elif rule == "largest":
        key = -F.col("width") * F.col("height")
    else:
        mean = scenes.agg(F.avg("resolution").alias("__mean"))
        scenes = scenes.crossJoin(F.broadcast(mean))
        key = F.abs(F.col("resolution") - (F.col("__mean") if target is None else F.lit(target)))
    columns = [c for c in scenes.columns if c != "__mean"]
    return scenes.agg(F.min_by(F.struct(*columns), F.struct(key.alias("k"), F.col("name").alias("n"))).alias("s")).select("s.*")


def snapped(value: Column, step: float, origin: float = 0.0, up: bool = False) -> Column:
    """The grid line at or below (or above) a coordinate."""
    f = F.ceil if up else F.floor
    return f((value - origin) / step) * step + origin
