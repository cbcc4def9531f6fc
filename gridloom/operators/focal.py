"""Neighbourhood operators over (row, col) grids."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of a tile's side.
TILE = 256


def lines() -> tuple[Window, Window]:
    """Along a row, and across the rows of a column."""
    return Window.partitionBy("row").orderBy("col"), Window.partitionBy("col").orderBy("row")


def gradient(df: DataFrame, value: str, gx: str, gy: str, spacing: float = 1.0) -> DataFrame:
    """Central differences inside, one-sided at the edges; gx along columns, gy along rows."""

    def along(w: Window) -> Column:
        before, after, here = F.lag(value).over(w), F.lead(value).over(w), F.col(value)
        return (
            F.when(before.isNull(), (after - here) / spacing)
            .when(after.isNull(), (here - before) / spacing)
            .otherwise((after - before) / (2 * spacing))
        )

    by_row, by_col = lines()
    return df.withColumn(gx, along(by_row)).withColumn(gy, along(by_col))


def neighbours9(df: DataFrame, value: str, out: str, nearest: bool = True) -> DataFrame:
    """The 3 x 3 values around each cell, row by row; outside is the nearest cell's value or NULL.

    Two windows, along and across, instead of nine copies of every cell.
    """

    def three(w: Window, c: str) -> Column:
        back = F.row_number().over(w) == 1
        ahead = F.lead(F.lit(1)).over(w).isNull()
        here = F.col(c)
        gone = here if nearest else (F.lit(None) if c == value else F.transform(here, lambda _: F.lit(None).cast("double")))
        return F.array(F.when(back, gone).otherwise(F.lag(c).over(w)), here, F.when(ahead, gone).otherwise(F.lead(c).over(w)))

    by_row, by_col = lines()
    return df.withColumn("__r", three(by_row, value)).withColumn(out, F.flatten(three(by_col, "__r"))).drop("__r")


def mean(values: Column) -> Column:
    kept = F.filter(values, lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(kept, F.lit(0.0), lambda a, x: a + x), F.size(kept))


def std(values: Column) -> Column:
    """Population deviation; NULL if any value is."""
    m = mean(values)
    return F.when(~F.exists(values, lambda x: x.isNull()), F.sqrt(mean(F.transform(values, lambda x: (x - m) * (x - m)))))


def offsets_join(df: DataFrame, value: str, offsets: list[tuple[int, int]], rows: int, cols: int, reflect: bool = False, weights: list[float] | None = None) -> DataFrame:
    """(row, col, value, weight) of each cell's neighbourhood; one copy of a cell per offset.

    Beyond the edge is the nearest cell, or with ``reflect`` the grid's mirror image.
    """
    weights = weights or [1.0] * len(offsets)
    spread = F.explode(F.array(*[F.struct(F.lit(r).alias("dr"), F.lit(c).alias("dc"), F.lit(w).alias("w")) for (r, c), w in zip(offsets, weights)]))

    def held_in(x: Column, n: int) -> Column:
        if reflect:
            x = F.when(x < 0, -x - 1).when(x >= n, 2 * n - 1 - x).otherwise(x)
        return F.greatest(F.least(x, F.lit(n - 1)), F.lit(0))

    wanted = df.select("row", "col", spread.alias("o")).select(
        "row", "col", held_in(F.col("row") + F.col("o.dr"), rows).alias("nr"), held_in(F.col("col") + F.col("o.dc"), cols).alias("nc"), F.col("o.w").alias("weight")
    )
    held = df.select(F.col("row").alias("nr"), F.col("col").alias("nc"), F.col(value).alias("value"))
    return wanted.join(held, ["nr", "nc"]).select("row", "col", "value", "weight")


Kernel = Callable[[np.ndarray, int], dict[str, np.ndarray]]


def tiled(df: DataFrame, value: str, halo: int, rows: int, cols: int, kernel: Kernel, fields: list[str], edge: str = "edge", tile: int = TILE) -> DataFrame:
    """(row, col, fields) from windows of up to ``halo`` cells around each cell.

    Cells are dealt to square tiles, and those near a border to the tiles across it, too: a wide
    window so costs a copy for the cells near borders, not one for each of its offsets. A tile is
    bounded by its sides. ``kernel`` gets a tile with its halo (missing cells are NaN) and returns
    an array for each field; outside the grid are its edge cells, its mirror image (``symmetric``), or nothing (``constant``).
    """

    def tiles_of(x: Column, n: int) -> Column:
        last = (n - 1) // tile
        at = lambda v: F.greatest(F.least(F.floor(v / tile), F.lit(last)), F.lit(0)).cast("int")
        return F.explode(F.sequence(at(x - halo), at(x + halo)))

    def run(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = key[0] * tile, key[1] * tile
        r1, c1 = min(r0 + tile, rows), min(c0 + tile, cols)
        top, left = max(r0 - halo, 0), max(c0 - halo, 0)
        inner = np.full((min(r1 + halo, rows) - top, min(c1 + halo, cols) - left), np.nan)
        inner[cells["row"] - top, cells["col"] - left] = cells["v"]
        pad = ((top - r0 + halo, r1 + halo - top - inner.shape[0]), (left - c0 + halo, c1 + halo - left - inner.shape[1]))
        padded = np.pad(inner, pad, constant_values=np.nan) if edge == "constant" else np.pad(inner, pad, mode=edge)
        found = kernel(padded, halo)
        own = cells[(cells["row"] >= r0) & (cells["row"] < r1) & (cells["col"] >= c0) & (cells["col"] < c1)]
        at = (own["row"].to_numpy() - r0, own["col"].to_numpy() - c0)
        return pd.DataFrame({"row": own["row"], "col": own["col"], **{f: found[f][at] for f in fields}})

    cells = df.select("row", "col", F.coalesce(F.col(value).cast("double"), F.lit(float("nan"))).alias("v"))
    dealt = cells.withColumn("__tr", tiles_of(F.col("row"), rows)).withColumn("__tc", tiles_of(F.col("col"), cols))
    schema = ", ".join(["row int", "col int", *[f"{f} double" for f in fields]])
    out = dealt.groupBy("__tr", "__tc").applyInPandas(run, schema)
    return out.withColumns({f: F.nanvl(F.col(f), F.lit(None).cast("double")) for f in fields})


def shifted(padded: np.ndarray, halo: int, dr: int, dc: int) -> np.ndarray:
    """The tile's cells at an offset."""
    h, w = padded.shape[0] - 2 * halo, padded.shape[1] - 2 * halo
    return padded[halo + dr : halo + dr + h, halo + dc : halo + dc + w]


def moments_kernel(offsets: list[tuple[int, int]]) -> Kernel:
    """Mean and population deviation over the cells at some offsets; missing ones don't count."""

    def kernel(padded: np.ndarray, halo: int) -> dict[str, np.ndarray]:
        held = ~np.isnan(padded)
        centre = np.nanmean(padded) if held.any() else 0.0
        filled = np.where(held, padded - centre, 0.0)
        n, s, q = (sum(shifted(x, halo, *o) for o in offsets) for x in (held.astype(float), filled, filled * filled))
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = s / n
            return {"mean": mean + centre, "std": np.sqrt(np.maximum(q / n - mean * mean, 0))}

    return kernel


def gaussian(df: DataFrame, value: str, sigma: float, rows: int, cols: int) -> DataFrame:
    """(row, col, value) smoothed, first along rows and then across, to four deviations."""
    reach = int(4 * sigma + 0.5)
    raw = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-reach, reach + 1)]
    weights = [w / sum(raw) for w in raw]

    def kernel(padded: np.ndarray, halo: int) -> dict[str, np.ndarray]:
        h, w = padded.shape[0] - 2 * halo, padded.shape[1] - 2 * halo
        along = sum(x * padded[:, k : k + w] for k, x in enumerate(weights))
        return {"value": sum(x * along[k : k + h] for k, x in enumerate(weights))}

    return tiled(df, value, reach, rows, cols, kernel, ["value"], edge="symmetric")


def uniform(df: DataFrame, value: str, size: int, rows: int, cols: int) -> DataFrame:
    """(row, col, value): the mean of a square window, mirrored at the edges; missing cells don't count."""
    before = size // 2
    offsets = [(r, c) for r in range(-before, size - before) for c in range(-before, size - before)]
    found = tiled(df, value, before, rows, cols, moments_kernel(offsets), ["mean"], edge="symmetric")
    return found.withColumnRenamed("mean", "value")


#: Doubles of a strip of windows that is sorted at a time.
STRIP = 1 << 22


def median(df: DataFrame, value: str, size: int, rows: int, cols: int) -> DataFrame:
    """(row, col, value): the median of a square window of an odd size, mirrored at the edges; missing cells don't count.

    A tile's windows are views of its cells; they are partially sorted some rows at a time.
    """
    if size % 2 == 0:
        raise ValueError("a median needs an odd window")

    def kernel(padded: np.ndarray, halo: int) -> dict[str, np.ndarray]:
        views = np.lib.stride_tricks.sliding_window_view(padded, (size, size))
        out = np.full(views.shape[:2], np.nan)
        step = max(1, STRIP // (views.shape[1] * size * size))
        for start in range(0, len(views), step):
            some = views[start : start + step].reshape(-1, size * size)
            n = (~np.isnan(some)).sum(1)
            ordered = np.sort(some, axis=1)  # missing ones come last
            low, high = (np.take_along_axis(ordered, np.maximum(at, 0)[:, None], 1)[:, 0] for at in ((n - 1) // 2, n // 2))
            out[start : start + step] = np.where(n > 0, low + (high - low) / 2, np.nan).reshape(-1, views.shape[1])
        return {"value": out}

    return tiled(df, value, size // 2, rows, cols, kernel, ["value"], edge="symmetric")


SMOOTHING = {"gaussian": gaussian, "uniform": lambda df, value, sigma, rows, cols: uniform(df, value, int(sigma * 2 + 1), rows, cols), "median": lambda df, value, sigma, rows, cols: median(df, value, int(sigma * 2 + 1), rows, cols)}


def smoothed(df: DataFrame, value: str, method: str, sigma: float, rows: int, cols: int) -> DataFrame:
    """(row, col, value) of a surface of shares, smoothed and kept between 0 and 1."""
    found = SMOOTHING[method](df, value, sigma, rows, cols)
    return found.withColumn("value", F.greatest(F.least("value", F.lit(1.0)), F.lit(0.0)))


def disk(radius: int) -> list[tuple[int, int]]:
    span = range(-radius, radius + 1)
    return [(r, c) for r in span for c in span if r * r + c * c <= radius * radius]


def topographic_position(df: DataFrame, value: str, radius: int, rows: int, cols: int, standardise: bool = False) -> DataFrame:
    """Height above the mean of the disk around it; if asked over the disk's deviation, 0 where that is 0."""
    around = tiled(df, value, radius, rows, cols, moments_kernel(disk(radius)), ["mean", "std"])
    above = F.col(value) - F.col("mean")
    tpi = F.when(F.col("std") > 1e-9, above / F.col("std")).otherwise(0.0) if standardise else above
    return df.join(around, ["row", "col"]).withColumn("tpi", tpi).drop("mean", "std")


def ellipse(size: int) -> list[tuple[int, int]]:
    """Offsets of the elliptic structuring element of an odd size."""
    r = size // 2
    reach = lambda dy: round(r * math.sqrt(max(0.0, (r * r - dy * dy) / (r * r)))) if r else 0
    return [(dy, dx) for dy in range(-r, r + 1) for dx in range(-reach(dy), reach(dy) + 1)]


def shaped(df: DataFrame, mask: str, out: str, size: int, erode: bool, rows: int, cols: int) -> DataFrame:
    """Erosion or dilation of a 0/1 mask by an ellipse; what is outside the grid counts for neither."""
    outside = 1.0 if erode else 0.0

    def kernel(padded: np.ndarray, halo: int) -> dict[str, np.ndarray]:
        inside = np.where(np.isnan(padded), outside, padded)
        pick = np.minimum if erode else np.maximum
        return {"v": reduce(pick, [shifted(inside, halo, *o) for o in ellipse(size)])}

    found = tiled(df, mask, size // 2, rows, cols, kernel, ["v"], edge="constant")
    return df.join(found, ["row", "col"]).withColumn(out, F.col("v").cast("int")).drop("v")


def cleaned_mask(df: DataFrame, mask: str, rows: int, cols: int, erosion: int = 3, dilation: int = 5, gaps: int = 5) -> DataFrame:
    """A 0/1 mask without small specks, widened, with small gaps closed."""
    out = df
    for size, erode in ((erosion, True), (dilation, False), (gaps, False), (gaps, True)):
        if size:
            out = shaped(out, mask, mask, size, erode, rows, cols)
    return out


def buffered_mask(df: DataFrame, mask: str, metres: float, rows: int, cols: int, pixel: float = 10.0) -> DataFrame:
    """A 0/1 mask widened by a distance."""
    return shaped(df, mask, mask, 2 * max(1, int(metres / pixel)) + 1, False, rows, cols)


def morphology(df: DataFrame, mask: str, out: str, erode: bool) -> DataFrame:
    """3 x 3 erosion or dilation of a 0/1 mask."""
    pick = F.array_min if erode else F.array_max
    return neighbours9(df.withColumn("__m", F.col(mask).cast("double")), "__m", "__v").withColumn(out, pick("__v").cast("int")).drop("__m", "__v")
