"""Grids of unlike resolution, extent and projection.

A grid's cell (row, col) covers a square of its step; an origin is the upper left corner, rows go down.
Resampling by kernels is separable and runs over square tiles of the target with the source
cells that their kernels reach; alignment by areas deals each source cell to the target cells it
overlaps, and sums meet in partial aggregates; reprojection maps target cells back to the source
and joins them with the source cells around, an equi-join on the cell.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.plans.lineage import stored

#: Target cells of a tile's side.
TILE = 256


class Grid(NamedTuple):
    """The x of its left side, the y of its upper side, a cell's side, and how many rows and columns there are."""

    left: float
    top: float
    step: float
    rows: int
    cols: int


def cubic(x: np.ndarray) -> np.ndarray:
    """Keys' convolution with a = -1/2."""
    x = np.abs(x)
    return np.where(x < 1, (1.5 * x - 2.5) * x * x + 1, np.where(x < 2, ((-0.5 * x + 2.5) * x - 4) * x + 2, 0.0))


def spline(x: np.ndarray) -> np.ndarray:
    """The cubic B-spline."""
    x = np.abs(x)
    return np.where(x < 1, (3 * x - 6) * x * x + 4, np.where(x < 2, (2 - x) ** 3, 0.0)) / 6


def lanczos(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)


def triangle(x: np.ndarray) -> np.ndarray:
    return np.maximum(1 - np.abs(x), 0.0)


#: By name a kernel and its radius in cells.
KERNELS: dict[str, tuple[Callable[[np.ndarray], np.ndarray], int]] = {"bilinear": (triangle, 1), "cubic": (cubic, 2), "cubic_spline": (spline, 2), "lanczos": (lanczos, 3)}


def weights(kernel: str, targets: np.ndarray, sources: np.ndarray, ratio: float, shift: float) -> np.ndarray:
    """Of each target cell and source cell along an axis; ratio is the target's step in source cells, shift where the
    target begins. Kernels widen where the target is coarser, so that every source cell counts."""
    f, radius = KERNELS[kernel]
    wide = max(1.0, ratio)
    apart = ((targets + 0.5) * ratio + shift - 0.5)[:, None] - sources[None, :]
    return np.where(np.abs(apart) < radius * wide, f(apart / wide), 0.0)


def resampled(df: DataFrame, value: str, source: Grid, target: Grid, kernel: str) -> DataFrame:
    """(row, col, value) of the target's cells. Missing cells have no weight, and the others' weights are brought to a
    sum of one; where they sum to less than a millionth the cell is NULL."""
    ratio, reach = target.step / source.step, KERNELS[kernel][1] * max(1.0, target.step / source.step)
    down, right = (source.top - target.top) / source.step, (target.left - source.left) / source.step

    def tiles(c: str, n: int, shift: float) -> Column:
        """The tiles whose kernels may reach a source cell."""
        at = lambda x: F.floor(((x - shift + 0.5) / ratio - 0.5) / TILE).cast("int")
        last = (n - 1) // TILE
        low, high = F.greatest(at(F.col(c) - reach - ratio), F.lit(0)), F.least(at(F.col(c) + reach + ratio), F.lit(last))
        return F.explode(F.when(low <= high, F.sequence(low, high)))

    def run(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        rows, cols = (np.arange(k * TILE, min((k + 1) * TILE, n)) for k, n in zip(key, (target.rows, target.cols)))
        top, left = cells["row"].min(), cells["col"].min()
        held = np.full((cells["row"].max() - top + 1, cells["col"].max() - left + 1), np.nan)
        held[cells["row"] - top, cells["col"] - left] = cells["v"]
        there = ~np.isnan(held)
        by_row = weights(kernel, rows, top + np.arange(held.shape[0]), ratio, down)
        by_col = weights(kernel, cols, left + np.arange(held.shape[1]), ratio, right).T
        total = by_row @ there @ by_col
        found = by_row @ np.where(there, held, 0.0) @ by_col
        r, c = np.meshgrid(rows, cols, indexing="ij")
        kept = np.abs(total) > 1e-6
        return pd.DataFrame({"row": r[kept], "col": c[kept], "value": (found / np.where(kept, total, 1.0))[kept]})

    cells = df.select("row", "col", F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    dealt = cells.withColumn("__tr", tiles("row", target.rows, down)).withColumn("__tc", tiles("col", target.cols, right))
    return dealt.groupBy("__tr", "__tc").applyInPandas(run, "row int, col int, value double")


def overlaps(df: DataFrame, value: str, source: Grid, target: Grid) -> DataFrame:
    """(row, col, v, area) of target cells: a source cell's value, and the part of the target cell that it covers."""

    def along(c: str, shift: float, n: int) -> tuple[Column, Callable[[Column], Column]]:
        low, high = (F.col(c) * source.step + shift) / target.step, ((F.col(c) + 1) * source.step + shift) / target.step
        first, last = F.greatest(F.floor(low + 1e-9), F.lit(0)), F.least(F.ceil(high - 1e-9) - 1, F.lit(n - 1))
        cells = F.explode(F.when(first <= last, F.sequence(first.cast("int"), last.cast("int"))))
        return cells, lambda t: F.greatest(F.least(high, t + 1) - F.greatest(low, t.cast("double")), F.lit(0.0))

    rows, down = along("row", target.top - source.top, target.rows)
    cols, right = along("col", source.left - target.left, target.cols)
    held = df.select("row", "col", F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    met = held.withColumn("__r", rows).withColumn("__c", cols)
    return met.select(F.col("__r").alias("row"), F.col("__c").alias("col"), "v", (down(F.col("__r")) * right(F.col("__c"))).alias("area"))


def aligned_by_area(df: DataFrame, value: str, source: Grid, target: Grid, total: bool = False) -> DataFrame:
    """(row, col, value, covered): the mean of the source over each target cell, weighted by overlap, and the share of the
    cell that has values; with ``total`` values are amounts, shared out by area, so that their sum stays."""
    met = overlaps(df, value, source, target)
    share = (target.step / source.step) ** 2
    taken = F.sum(F.col("v") * F.col("area") * F.lit(share)) if total else F.sum(F.col("v") * F.col("area")) / F.sum("area")
    return met.filter("area > 1e-12").groupBy("row", "col").agg(taken.alias("value"), F.sum("area").alias("covered"))


def target_grid(scenes: list[Grid], resolution: float, reference: int = 0, union: bool = True, snap: bool = True) -> Grid:
    """The grid that scenes are brought to: over all of them or over the reference, its lines at multiples of the step."""
    over = scenes if union else [scenes[reference]]
    left, right = min(s.left for s in over), max(s.left + s.cols * s.step for s in over)
    top, bottom = max(s.top for s in over), min(s.top - s.rows * s.step for s in over)
    if snap:
        left, bottom = math.floor(left / resolution) * resolution, math.floor(bottom / resolution) * resolution
        right, top = math.ceil(right / resolution) * resolution, math.ceil(top / resolution) * resolution
    return Grid(left, top, resolution, round((top - bottom) / resolution), round((right - left) / resolution))


# Projections


# WGS 84, the scale of a UTM zone's middle, its false easting and that of the south's northing.
AXIS, FLATTENING = 6378137.0, 1 / 298.257223563
SCALE, EAST, SOUTH = 0.9996, 500_000.0, 10_000_000.0
THIRD = FLATTENING / (2 - FLATTENING)
#: The radius of the sphere whose meridian is as long, and Krueger's series to the fourth power of the third flattening.
RADIUS = AXIS / (1 + THIRD) * (1 + THIRD**2 / 4 + THIRD**4 / 64)
FORWARD = (
    THIRD / 2 - 2 * THIRD**2 / 3 + 5 * THIRD**3 / 16 + 41 * THIRD**4 / 180,
    13 * THIRD**2 / 48 - 3 * THIRD**3 / 5 + 557 * THIRD**4 / 1440,
    61 * THIRD**3 / 240 - 103 * THIRD**4 / 140,
    49561 * THIRD**4 / 161280,
)
INVERSE = (
    THIRD / 2 - 2 * THIRD**2 / 3 + 37 * THIRD**3 / 96 - THIRD**4 / 360,
    THIRD**2 / 48 + THIRD**3 / 15 - 437 * THIRD**4 / 1440,
    17 * THIRD**3 / 480 - 37 * THIRD**4 / 840,
    4397 * THIRD**4 / 161280,
)
#: From the conformal latitude to the latitude.
LATITUDE = (
    2 * THIRD - 2 * THIRD**2 / 3 - 2 * THIRD**3 + 116 * THIRD**4 / 45,
    7 * THIRD**2 / 3 - 8 * THIRD**3 / 5 - 227 * THIRD**4 / 45,
    56 * THIRD**3 / 15 - 136 * THIRD**4 / 35,
    4279 * THIRD**4 / 630,
)
ECCENTRIC = math.sqrt(FLATTENING * (2 - FLATTENING))


def meridian(zone: int) -> float:
    return 6.0 * zone - 183.0


def atanh(x: Column) -> Column:
    return F.log((1 + x) / (1 - x)) / 2


def utm_forward(df: DataFrame, lon: str, lat: str, east: str, north: str, zone: int, south: bool = False) -> DataFrame:
    """Adds easting and northing in metres on WGS 84 (Krueger's series; errors below a micrometre in a zone). In steps,
    so that none of the repeated terms is computed twice."""
    d = df.withColumns({"__p": F.sin(F.radians(lat)), "__l": F.radians(F.col(lon) - meridian(zone))})
    d = d.withColumn("__t", F.sinh(atanh(F.col("__p")) - ECCENTRIC * atanh(ECCENTRIC * F.col("__p"))))
    d = d.withColumns({"__x": F.atan2("__t", F.cos("__l")), "__e": atanh(F.sin("__l") / F.sqrt(1 + F.col("__t") * F.col("__t")))})
    x, e = F.col("__x"), F.col("__e")
    up = x + sum((a * F.sin(2 * j * x) * F.cosh(2 * j * e) for j, a in enumerate(FORWARD, 1)), F.lit(0.0))
    right = e + sum((a * F.cos(2 * j * x) * F.sinh(2 * j * e) for j, a in enumerate(FORWARD, 1)), F.lit(0.0))
    return d.withColumns({east: EAST + SCALE * RADIUS * right, north: (SOUTH if south else 0.0) + SCALE * RADIUS * up}).drop("__p", "__l", "__t", "__x", "__e")


def utm_inverse(df: DataFrame, east: str, north: str, lon: str, lat: str, zone: int, south: bool = False) -> DataFrame:
    """Adds longitude and latitude in degrees."""
    d = df.withColumns({"__x": (F.col(north) - (SOUTH if south else 0.0)) / (SCALE * RADIUS), "__e": (F.col(east) - EAST) / (SCALE * RADIUS)})
    x, e = F.col("__x"), F.col("__e")
    d = d.withColumns({
        "__a": x - sum((b * F.sin(2 * j * x) * F.cosh(2 * j * e) for j, b in enumerate(INVERSE, 1)), F.lit(0.0)),
        "__b": e - sum((b * F.cos(2 * j * x) * F.sinh(2 * j * e) for j, b in enumerate(INVERSE, 1)), F.lit(0.0)),
    })
    d = d.withColumn("__c", F.asin(F.sin("__a") / F.cosh("__b")))
    up = F.col("__c") + sum((c * F.sin(2 * j * F.col("__c")) for j, c in enumerate(LATITUDE, 1)), F.lit(0.0))
    # What the series leaves is put right by the conformal latitude of its result.
    d = d.withColumn("__u", up)
    d = d.withColumn("__p", F.sin("__u"))
    bent = F.atan(F.sinh(atanh(F.col("__p")) - ECCENTRIC * atanh(ECCENTRIC * F.col("__p"))))
    right = meridian(zone) + F.degrees(F.atan2(F.sinh("__b"), F.cos("__a")))
    return d.withColumns({lon: right, lat: F.degrees(F.col("__u") + F.col("__c") - bent)}).drop("__x", "__e", "__a", "__b", "__c", "__u", "__p")


def mercator_forward(df: DataFrame, lon: str, lat: str, east: str, north: str) -> DataFrame:
    """Adds the web's spherical Mercator in metres."""
    return df.withColumns({east: F.radians(lon) * AXIS, north: F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * AXIS})


def mercator_inverse(df: DataFrame, east: str, north: str, lon: str, lat: str) -> DataFrame:
    return df.withColumns({lon: F.degrees(F.col(east) / AXIS), lat: F.degrees(2 * F.atan(F.exp(F.col(north) / AXIS)) - math.pi / 2)})


#: From two columns of a table to two more of given names.
Projection = Callable[[DataFrame, str, str, str, str], DataFrame]


def covering(df: DataFrame, source: Grid, forward: Projection, resolution: float) -> Grid:
    """The snapped grid over the projected corners of all cells of a grid in degrees."""
    corner = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)]))
    corners = df.select("row", "col", corner.alias("o"))
    placed = corners.select((source.left + (F.col("col") + F.col("o.b")) * source.step).alias("lon"), (source.top - (F.col("row") + F.col("o.a")) * source.step).alias("lat"))
    b = forward(placed, "lon", "lat", "x", "y").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first()
    left, bottom = math.floor(b["x0"] / resolution) * resolution, math.floor(b["y0"] / resolution) * resolution
    right, top = math.ceil(b["x1"] / resolution) * resolution, math.ceil(b["y1"] / resolution) * resolution
    return Grid(left, top, resolution, round((top - bottom) / resolution), round((right - left) / resolution))


def reprojected(df: DataFrame, value: str, source: Grid, target: Grid, inverse: Projection, method: str = "nearest") -> DataFrame:
    """(row, col, value) of the target's cells whose middles lie on the source grid: the cell there, or of the four
    around, weighted; missing ones have no weight."""
    spark = df.sparkSession
    cells = spark.range(target.rows * target.cols).select(F.floor(F.col("id") / target.cols).cast("int").alias("row"), (F.col("id") % target.cols).cast("int").alias("col"))
    placed = cells.withColumns({"__gx": target.left + (F.col("col") + 0.5) * target.step, "__gy": target.top - (F.col("row") + 0.5) * target.step})
    found = inverse(placed, "__gx", "__gy", "__lon", "__lat")
    # Written, as a filter would else be pushed below the projection's steps, each of which it would repeat.
    at = stored(found.select("row", "col", ((F.col("__lon") - source.left) / source.step).alias("__c"), ((source.top - F.col("__lat")) / source.step).alias("__r")))
    at = at.filter((F.col("__r") >= 0) & (F.col("__r") < source.rows) & (F.col("__c") >= 0) & (F.col("__c") < source.cols))
    held = df.select(F.col("row").cast("long").alias("__sr"), F.col("col").cast("long").alias("__sc"), F.col(value).cast("double").alias("__v")).filter(F.col("__v").isNotNull() & ~F.isnan("__v"))
    if method == "nearest":
        near = at.withColumns({"__sr": F.floor("__r"), "__sc": F.floor("__c")})
        return near.join(held, ["__sr", "__sc"]).select("row", "col", F.col("__v").alias("value"))
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)]))
    four = at.withColumn("o", around).withColumns({"__sr": F.floor(F.col("__r") - 0.5) + F.col("o.a"), "__sc": F.floor(F.col("__c") - 0.5) + F.col("o.b")})
    weight = (1 - F.abs(F.col("__r") - 0.5 - F.col("__sr"))) * (1 - F.abs(F.col("__c") - 0.5 - F.col("__sc")))
    met = four.withColumn("__w", weight).join(held, ["__sr", "__sc"]).filter("__w > 1e-12")
    return met.groupBy("row", "col").agg((F.sum(F.col("__w") * F.col("__v")) / F.sum("__w")).alias("value"))
