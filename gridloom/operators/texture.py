"""Co-occurrence texture, resampling and mosaics."""

from __future__ import annotations

import math
import warnings
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.focal import Kernel, moments_kernel, shifted, tiled


def quantise(df: DataFrame, value: str, levels: int, out: str = "level") -> DataFrame:
    """Global minimum to maximum in equal steps, 0 to levels - 1."""
    d = df.crossJoin(F.broadcast(df.agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))))
    step = F.floor(F.try_divide(F.col(value) - F.col("__lo"), F.col("__hi") - F.col("__lo")) * levels)
    return d.withColumn(out, F.coalesce(F.least(step, F.lit(levels - 1)), F.lit(0)).cast("int")).drop("__lo", "__hi")


def co_occurrence(df: DataFrame, level: str, dr: int, dc: int) -> DataFrame:
    """Symmetric, normalised (i, j, p) of levels at an offset: an equi-join on the shifted cell."""
    a = df.select("row", "col", F.col(level).alias("i"))
    b = df.select((F.col("row") - dr).alias("row"), (F.col("col") - dc).alias("col"), F.col(level).alias("j"))
    pairs = a.join(b, ["row", "col"]).groupBy("i", "j").count()
    both = pairs.select("i", "j", "count").unionAll(pairs.select(F.col("j").alias("i"), F.col("i").alias("j"), "count"))
    sums = both.groupBy("i", "j").agg(F.sum("count").alias("n"))
    return sums.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy()))


def texture_features(matrix: DataFrame) -> DataFrame:
    """Contrast, dissimilarity, homogeneity, energy, ASM and correlation of a co-occurrence matrix."""
    d, p = F.col("i") - F.col("j"), F.col("p")
    sums = matrix.agg(
        F.sum(p * d * d).alias("contrast"), F.sum(p * F.abs(d)).alias("dissimilarity"), F.sum(p / (1 + d * d)).alias("homogeneity"),
        F.sum(p * p).alias("asm"), F.sum(p * F.col("i")).alias("mi"), F.sum(p * F.col("j")).alias("mj"),
        F.sum(p * F.col("i") * F.col("i")).alias("ii"), F.sum(p * F.col("j") * F.col("j")).alias("jj"), F.sum(p * F.col("i") * F.col("j")).alias("ij"),
    )
    spread = F.sqrt(F.col("ii") - F.col("mi") * F.col("mi")) * F.sqrt(F.col("jj") - F.col("mj") * F.col("mj"))
    corr = F.coalesce(F.try_divide(F.col("ij") - F.col("mi") * F.col("mj"), spread), F.lit(1.0))
    return sums.select("contrast", "dissimilarity", "homogeneity", "asm", F.sqrt("asm").alias("energy"), corr.alias("correlation"))


def statistics_kernel(window: int) -> Kernel:
    """Mean, deviation, variance, skewness, excess kurtosis and entropy (10 bins between the window's least and greatest
    value) of the values around each cell; skewness is 0 for 2 values or fewer, kurtosis for 3, and both for equal ones."""
    r = window // 2

    def kernel(padded: np.ndarray, halo: int) -> dict[str, np.ndarray]:
        out = {f: [] for f in STATISTICS}
        for i in range(padded.shape[0] - 2 * halo):  # a line of cells at a time: window x window values each
            lines = padded[i + halo - r : i + halo + r + 1]
            values = np.lib.stride_tricks.sliding_window_view(lines, (window, window))[0][halo - r : padded.shape[1] - halo - r]
            v = values.reshape(len(values), -1)
            n = (~np.isnan(v)).sum(1)
            with np.errstate(invalid="ignore", divide="ignore"), warnings.catch_warnings():
                warnings.simplefilter("ignore", RuntimeWarning)  # windows without a value
                mean, low, high = np.nanmean(v, 1), np.nanmin(v, 1), np.nanmax(v, 1)
                d = v - mean[:, None]
                m2, m3, m4 = (np.nanmean(d**k, 1) for k in (2, 3, 4))
                bins = np.minimum(np.floor((v - low[:, None]) / (high - low)[:, None] * 10), 9)
                shares = np.stack([(bins == k).sum(1) for k in range(10)], 1) / n[:, None]
                entropy = -np.where(shares > 0, shares * np.log(np.where(shares > 0, shares, 1)), 0).sum(1)
                spread = high > low
                row = (mean, np.sqrt(m2), m2, np.where(spread & (n > 2), m3 / m2**1.5, 0), np.where(spread & (n > 3), m4 / m2**2 - 3, 0), np.where(spread & (n > 1), entropy, 0))
            for f, x in zip(STATISTICS, row):
                out[f].append(np.where(n > 0, x, np.nan))
        return {f: np.stack(x) for f, x in out.items()}

    return kernel


STATISTICS = ["mean", "std", "variance", "skewness", "kurtosis", "entropy"]


def statistical_texture(df: DataFrame, value: str, rows: int, cols: int, window: int = 9) -> DataFrame:
    """(row, col, STATISTICS) over a square window, mirrored at the edges."""
    return tiled(df, value, window // 2, rows, cols, statistics_kernel(window), STATISTICS, edge="symmetric")


def local_variance(df: DataFrame, value: str, rows: int, cols: int, radius: int = 3) -> DataFrame:
    """(row, col, variance) over a square window."""
    size = [(r, c) for r in range(-radius, radius + 1) for c in range(-radius, radius + 1)]
    spread = tiled(df, value, radius, rows, cols, moments_kernel(size), ["std"], edge="symmetric")
    return spread.select("row", "col", (F.col("std") * F.col("std")).alias("variance"))


def windowed_contrast(df: DataFrame, level: str, rows: int, cols: int, window: int = 9) -> DataFrame:
    """(row, col, contrast): of neighbours along a row within the window, the mean squared difference of levels."""
    r = window // 2

    def kernel(padded: np.ndarray, halo: int) -> dict[str, np.ndarray]:
        d = padded[:, 1:] - padded[:, :-1]
        square = np.pad(d * d, ((0, 0), (0, 1)), constant_values=np.nan)
        held = ~np.isnan(square)
        offsets = [(a, b) for a in range(-r, r + 1) for b in range(-r, r)]
        total, n = (sum(shifted(x, halo, *o) for o in offsets) for x in (np.where(held, square, 0.0), held.astype(float)))
        return {"contrast": np.where(n > 0, total / np.maximum(n, 1), 0.0)}

    return tiled(df, level, r, rows, cols, kernel, ["contrast"], edge="symmetric")


def multiscale_contrast(df: DataFrame, value: str, scales: list[int], levels: int = 64) -> DataFrame:
    """(scale, contrast): co-occurrence contrast of row neighbours after averaging blocks of scale x scale cells."""
    parts = []
    for scale in scales:
        coarse = downsample(df, value, scale, "average") if scale > 1 else df.select("row", "col", F.col(value).alias("value"))
        matrix = co_occurrence(quantise(coarse, "value", levels), "level", 0, 1)
        parts.append(texture_features(matrix).select(F.lit(scale).alias("scale"), "contrast"))
    return reduce(DataFrame.unionByName, parts)


def circle(points: int, radius: float) -> list[list[tuple[int, int, float]]]:
    """Of each place on a circle around a cell, the cells around it (row, column) with their bilinear weights."""
    out = []
    for k in range(points):
        r, c = round(-radius * math.sin(2 * math.pi * k / points), 5), round(radius * math.cos(2 * math.pi * k / points), 5)
        top, left = math.floor(r), math.floor(c)
        corners = [(top + a, left + b, abs(1 - a - (r - top)) * abs(1 - b - (c - left))) for a in (0, 1) for b in (0, 1)]
        out.append([x for x in corners if x[2] > 0])
    return out


def binary_patterns(df: DataFrame, value: str, rows: int, cols: int, points: int = 24, radius: int = 3) -> DataFrame:
    """(row, col, code): uniform, rotation-invariant local binary patterns of a band of 0 to 1, as bytes.

    Places on the circle are interpolated; those at least as bright as the middle are ones. Around a
    circle with at most two changes the code is the number of ones, else one more than places. Missing
    cells and those outside the grid are 0.
    """
    places, halo = circle(points, radius), math.ceil(radius)

    def kernel(padded: np.ndarray, halo: int) -> dict[str, np.ndarray]:
        level = np.floor(np.clip(np.nan_to_num(padded), 0, 1) * 255 + 0.5)
        middle = shifted(level, halo, 0, 0)
        ones = np.stack([sum(w * shifted(level, halo, r, c) for r, c, w in place) >= middle - 1e-6 for place in places])
        changes = (ones != np.roll(ones, 1, 0)).sum(0)
        return {"code": np.where(changes <= 2, ones.sum(0), points + 1).astype(float)}

    found = tiled(df, value, halo, rows, cols, kernel, ["code"], edge="constant")
    return found.withColumn("code", F.col("code").cast("int"))


def pattern_variance(df: DataFrame, value: str, rows: int, cols: int, window: int = 9, points: int = 24, radius: int = 3) -> DataFrame:
    """(row, col, variance) of the binary patterns in a square window."""
    return local_variance(binary_patterns(df, value, rows, cols, points, radius), "code", rows, cols, window // 2)


def gabor_kernel(frequency: float, theta: float) -> dict[tuple[int, int], float]:
    """The real part of a Gabor filter of one octave, by offset (row, column), out to three deviations."""
    sigma = math.sqrt(math.log(2) / 2) / math.pi * 3 / frequency
    reach = max(1, math.ceil(3 * sigma))
    out = {}
    for y in range(-reach, reach + 1):
        for x in range(-reach, reach + 1):
            along = x * math.cos(theta) + y * math.sin(theta)
            out[(y, x)] = math.exp(-0.5 * (x * x + y * y) / sigma**2) / (2 * math.pi * sigma**2) * math.cos(2 * math.pi * frequency * along)
    return out


def gabor(df: DataFrame, value: str, frequency: float, theta: float, rows: int, cols: int) -> DataFrame:
    """(row, col, response): the size of a Gabor filter's answer on the standardised band, mirrored at the edges."""
    weights = gabor_kernel(frequency, theta)
    halo = max(y for y, _ in weights)
    one = df.agg(F.avg(value).alias("__m"), F.stddev_pop(value).alias("__s"))
    z = df.crossJoin(F.broadcast(one)).withColumn("__z", (F.col(value) - F.col("__m")) / F.when(F.col("__s") > 0, F.col("__s")).otherwise(1.0))

    def kernel(padded: np.ndarray, halo: int) -> dict[str, np.ndarray]:
        filled = np.nan_to_num(padded)
        return {"response": np.abs(sum(w * shifted(filled, halo, -y, -x) for (y, x), w in weights.items()))}

    return tiled(z, "__z", halo, rows, cols, kernel, ["response"], edge="symmetric")


def gabor_bank(df: DataFrame, value: str, frequencies: list[float], orientations: int, rows: int, cols: int) -> DataFrame:
    """(row, col, f<k>_o<j>): the answers of filters of all frequencies and evenly turned orientations, from one pass over
    the tiles of the standardised band."""
    bank = {f"f{k}_o{j}": gabor_kernel(f, math.pi * j / orientations) for k, f in enumerate(frequencies) for j in range(orientations)}
    reach = max(y for weights in bank.values() for y, _ in weights)
    one = df.agg(F.avg(value).alias("__m"), F.stddev_pop(value).alias("__s"))
    z = df.crossJoin(F.broadcast(one)).withColumn("__z", (F.col(value) - F.col("__m")) / F.when(F.col("__s") > 0, F.col("__s")).otherwise(1.0))

    def kernel(padded: np.ndarray, halo: int) -> dict[str, np.ndarray]:
        filled = np.nan_to_num(padded)
        return {name: np.abs(sum(w * shifted(filled, halo, -y, -x) for (y, x), w in weights.items())) for name, weights in bank.items()}

    return tiled(z, "__z", reach, rows, cols, kernel, list(bank), edge="symmetric")


AGGREGATES = {
    "average": F.avg, "min": F.min, "max": F.max, "median": lambda c: F.percentile(c, 0.5), "q1": lambda c: F.percentile(c, 0.25),
    "q3": lambda c: F.percentile(c, 0.75), "sum": F.sum, "rms": lambda c: F.sqrt(F.avg(F.col(c) * F.col(c))),
    "mode": lambda c: F.mode(c, True),
}


def downsample(df: DataFrame, value: str, factor: int, method: str) -> DataFrame:
    """Blocks of factor x factor cells become one; ``nearest`` takes the block's middle cell."""
    block = [F.floor(F.col(c) / factor).cast("int").alias(c) for c in ("row", "col")]
    if method == "nearest":
        middle = (F.col("row") % factor == factor // 2) & (F.col("col") % factor == factor // 2)
        return df.filter(middle).select(*block, F.col(value).alias("value"))
    return df.groupBy(*block).agg(AGGREGATES[method](value).alias("value"))


def upsample_bilinear(df: DataFrame, value: str, factor: int) -> DataFrame:
    """Each cell becomes factor x factor cells, weighted over its right, lower and diagonal neighbours."""
    w, h = Window.partitionBy("row").orderBy("col"), Window.partitionBy("col").orderBy("row")
    here = F.col(value)
    d = df.withColumn("__r", F.coalesce(F.lead(value).over(w), here))
    d = d.withColumn("__d", F.coalesce(F.lead(value).over(h), here)).withColumn("__x", F.coalesce(F.lead("__r").over(h), F.col("__r")))
    steps = F.explode(F.sequence(F.lit(0), F.lit(factor - 1)))
    d = d.withColumn("__i", steps).withColumn("__j", steps)
    u, v = F.col("__i") / factor, F.col("__j") / factor
    mixed = (here * (1 - v) + F.col("__r") * v) * (1 - u) + (F.col("__d") * (1 - v) + F.col("__x") * v) * u
    return d.select((F.col("row") * factor + F.col("__i")).alias("row"), (F.col("col") * factor + F.col("__j")).alias("col"), mixed.alias("value"))


def mosaic(scenes: list[DataFrame], value: str, method: str) -> DataFrame:
    """Overlapping grids as one: first, last, min or max."""
    layers = [s.select("row", "col", F.col(value), F.lit(k).alias("__k")) for k, s in enumerate(scenes)]
    all_rows = layers[0]
    for layer in layers[1:]:
        all_rows = all_rows.unionByName(layer)
    pick = {"first": F.min_by(value, "__k"), "last": F.max_by(value, "__k"), "min": F.min(value), "max": F.max(value)}[method]
    return all_rows.groupBy("row", "col").agg(pick.alias("value"))
