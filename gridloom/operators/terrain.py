"""Terrain derivatives of an elevation grid."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.focal import gaussian, gradient, mean, neighbours9, std


def slope_aspect(df: DataFrame, value: str = "elevation", spacing: float = 1.0) -> DataFrame:
    """Slope in degrees and percent, aspect in degrees (0 to 360)."""
    g = gradient(df, value, "gx", "gy", spacing)
    steep = F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy"))
    angle = F.atan2(-F.col("gx"), F.col("gy"))
    return g.withColumns({
        "slope": F.degrees(F.atan(steep)), "slope_percent": steep * 100,
        "aspect": F.degrees(F.when(angle < 0, angle + 2 * math.pi).otherwise(angle)),
    })


def curvatures(df: DataFrame, value: str = "elevation", spacing: float = 1.0) -> DataFrame:
    """Plan, profile and general curvature; flat cells have 0."""
    g = gradient(df, value, "gx", "gy", spacing)
    g = gradient(gradient(g, "gx", "zxx", "zxy", spacing), "gy", "zyx", "zyy", spacing)
    x, y, xx, xy, yy = (F.col(c) for c in ("gx", "gy", "zxx", "zxy", "zyy"))
    p = x * x + y * y
    zero = lambda v: F.coalesce(v, F.lit(0.0))
    return g.withColumns({
        "plan": zero(-F.try_divide(xx * y * y - 2 * xy * x * y + yy * x * x, F.pow(p, F.lit(1.5)))),
        "profile": zero(-F.try_divide(xx * x * x + 2 * xy * x * y + yy * y * y, p * F.pow(1 + p, F.lit(1.5)))),
        "general": -(xx + yy),
    }).drop("zxx", "zxy", "zyx", "zyy")


def dem_curvatures(df: DataFrame, value: str = "elevation") -> DataFrame:
    """Profile, plan and mean curvature of the elevation step, in unit cells; flat cells have 0."""
    g = gradient(df, value, "gx", "gy")
    g = gradient(gradient(g, "gx", "zxx", "zxy"), "gy", "zyx", "zyy")
    x, y, xx, xy, yy = (F.col(c) for c in ("gx", "gy", "zxx", "zxy", "zyy"))
    bend, p = x * x * yy - 2 * x * y * xy + y * y * xx, x * x + y * y
    zero = lambda v: F.coalesce(v, F.lit(0.0))
    out = g.withColumns({"profile": zero(F.try_divide(bend, F.pow(p, F.lit(1.5)))), "plan": zero(F.try_divide(bend, p))})
    return out.withColumn("mean", (F.col("profile") + F.col("plan")) / 2).drop("gx", "gy", "zxx", "zxy", "zyx", "zyy")


def multiscale(df: DataFrame, value: str, scale: int, rows: int, cols: int, pixel: float = 1.0) -> DataFrame:
    """Slope and curvatures after smoothing with a deviation of ``scale`` pixels."""
    smooth = gaussian(df, value, scale * pixel, rows, cols).withColumnRenamed("value", "elevation")
    return curvatures(slope_aspect(smooth, spacing=pixel).drop("gx", "gy"), spacing=pixel)


def ruggedness(df: DataFrame, value: str = "elevation") -> DataFrame:
    """Mean difference to the 8 neighbours (edges repeat), and over 9 cells without what is outside."""
    near = neighbours9(df, value, "near")
    both = neighbours9(near, value, "inner", nearest=False)
    far = lambda c: F.transform(c, lambda x: F.abs(x - F.col(value)))
    total = F.aggregate(far("near"), F.lit(0.0), lambda a, x: a + x)
    return both.withColumns({"tri": total / 8, "tri_dem": mean(far("inner")), "roughness_dem": std(F.col("inner"))}).drop("near", "inner")


def roughness(df: DataFrame, value: str = "elevation") -> DataFrame:
    """3 x 3 deviation of the gradient's size."""
    g = gradient(df, value, "gx", "gy").withColumn("g", F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy")))
    return neighbours9(g, "g", "v").withColumn("roughness", std(F.col("v"))).drop("v", "g", "gx", "gy")


def illumination(df: DataFrame, bands: list[str], zenith: float = 45.0, azimuth: float = 135.0) -> DataFrame:
    """Bands divided by the cosine of incidence, held between 0.1 and 1."""
    s, a, z, az = F.radians("slope"), F.radians("aspect"), math.radians(zenith), math.radians(azimuth)
    lit = F.cos(s) * math.cos(z) + F.sin(s) * math.sin(z) * F.cos(F.lit(az) - a)
    return df.withColumns({b: F.col(b) / F.greatest(F.least(lit, F.lit(1.0)), F.lit(0.1)) for b in bands})


def flow_direction(df: DataFrame, value: str = "elevation") -> DataFrame:
    """The steepest of 8 directions (0 to 7, by row then column), -1 in pits; of equals the first."""
    near = neighbours9(df, value, "v", nearest=False)
    order = [0, 1, 2, 3, 5, 6, 7, 8]
    fall = [F.struct(((F.col(value) - F.col("v")[k]) / (math.sqrt(2) if k in (0, 2, 6, 8) else 1.0)).alias("fall"), F.lit(-i).alias("i")) for i, k in enumerate(order)]
    best = F.array_max(F.filter(F.array(*fall), lambda x: x["fall"] > 0))
    return near.withColumn("direction", F.coalesce(-best["i"], F.lit(-1))).drop("v")
