"""Spectra: band depth, derivatives over wavelength, continuum removal."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio_depth(left: str, centre: str, right: str) -> Column:
    """One less the centre over the mean of the shoulders; NULL where these aren't positive."""
    shoulder = (F.col(left) + F.col(right)) / 2
    return F.when(shoulder > 0, 1 - F.try_divide(F.col(centre), shoulder))


def derivative(spectrum: Column, wavelengths: list[float]) -> Column:
    """Central differences at the inner wavelengths."""
    inner = range(1, len(wavelengths) - 1)
    return F.array(*[(spectrum[i + 1] - spectrum[i - 1]) / (wavelengths[i + 1] - wavelengths[i - 1]) for i in inner])


def second_derivative(spectrum: Column, wavelengths: list[float]) -> Column:
    """The derivative of the derivative at the inner wavelengths; the first derivative is 0 at both ends."""
    first = F.concat(F.array(F.lit(0.0)), derivative(spectrum, wavelengths), F.array(F.lit(0.0)))
    return derivative(first, wavelengths)


# By mineral, centres and ranges of its absorption features, in nanometres.
MINERALS = {
    "kaolinite": ((2206, 2190, 2220), (2165, 2150, 2180)),
    "muscovite": ((2200, 2180, 2220), (2345, 2320, 2360)),
    "alunite": ((2165, 2150, 2180), (2315, 2300, 2330)),
    "calcite": ((2340, 2320, 2360),),
    "dolomite": ((2325, 2310, 2340),),
    "goethite": ((480, 460, 500), (650, 630, 670), (900, 880, 920)),
    "hematite": ((565, 550, 580), (860, 840, 880)),
    "jarosite": ((430, 410, 450), (2265, 2250, 2280)),
    "chlorite": ((2255, 2240, 2270), (2330, 2315, 2345)),
    "epidote": ((2338, 2320, 2356),),
}


def mineral_bands(name: str, wavelengths: list[float]) -> list[tuple[int, int, int]]:
    """(left, centre, right) bands of a mineral's features; a range with fewer than three bands has none."""
    out = []
    for centre, low, high in MINERALS[name]:
        inside = [k for k, w in enumerate(wavelengths) if low <= w <= high]
        if len(inside) >= 3:
            out.append((inside[0], min(range(len(wavelengths)), key=lambda k: abs(wavelengths[k] - centre)), inside[-1]))
    return out


def mineral(name: str, spectrum: Column, wavelengths: list[float]) -> Column:
    """Mean depth of a mineral's features; a feature without a positive continuum counts as 0, no feature gives NULL."""
    depths = []
    for left, centre, right in mineral_bands(name, wavelengths):
        around = (spectrum[left] + spectrum[right]) / 2.0
        depths.append(F.coalesce(F.when(around > 0, 1 - F.try_divide(spectrum[centre], around)), F.lit(0.0)))
    return sum(depths, F.lit(0.0)) / len(depths) if depths else F.lit(None).cast("double")


def mineral_sql(name: str, wavelengths: list[float], spectrum: str) -> str:
    """The same in SQL, over a list."""
    around = lambda a, b: f"(({spectrum}[{a + 1}] + {spectrum}[{b + 1}]) / 2.0)"
    depths = [f"coalesce(CASE WHEN {around(a, b)} > 0 THEN 1 - {spectrum}[{c + 1}] / {around(a, b)} END, 0)" for a, c, b in mineral_bands(name, wavelengths)]
    return f"({' + '.join(depths)}) / {len(depths)}" if depths else "NULL::double"


def mineral_index(depths: list[Column]) -> Column:
    """Mean depth; missing ones count as 0."""
    return sum((F.coalesce(d, F.lit(0.0)) for d in depths), F.lit(0.0)) / len(depths)


def smoothing(n: int, window: int = 5, order: int = 2) -> list[list[float]]:
    """By band the weights of all bands in a running polynomial fit; at the ends the first and last fit count."""
    out = []
    for i in range(n):
        first = min(max(i - window // 2, 0), n - window)
        powers = np.vander(np.arange(window, dtype=float), order + 1)
        weights = np.vander([float(i - first)], order + 1)[0] @ np.linalg.pinv(powers)
        out.append([float(weights[k - first]) if first <= k < first + window else 0.0 for k in range(n)])
    return out


def continuum_terms(wavelengths: list[float], smooth: bool = True) -> tuple[list[list[float]], list[list[tuple[int, int, float]]]]:
    """What a continuum is made of: by band its smoothing weights, and the chords (left, right, part) over it, of which
    the highest is the upper convex hull."""
    n = len(wavelengths)
    weights = smoothing(n) if smooth and n >= 5 else [[float(i == k) for k in range(n)] for i in range(n)]
    chords = []
    for i, w in enumerate(wavelengths):
        over = [(a, b, (w - wavelengths[a]) / (wavelengths[b] - wavelengths[a])) for a in range(i) for b in range(i + 1, n)]
        chords.append([(i, i, 0.0), *over])
    return weights, chords


def continuum_removed(df: DataFrame, bands: list[str], wavelengths: list[float], smooth: bool = True) -> DataFrame:
    """(row, col, mean, depth, position): the smoothed spectrum over its upper hull, its deepest point and where that is.

    Rows with a missing band are left out; without a positive hull all three are NULL. For a handful of bands the hull is
    the highest of the chords over each band, so it needs no loop over pixels.
    """
    weights, chords = continuum_terms(wavelengths, smooth)
    complete = df.dropna(subset=bands)
    even = [f"__s{i}" for i in range(len(bands))]
    d = complete.withColumns({c: sum((F.col(b) * w for b, w in zip(bands, row) if w), F.lit(0.0)) for c, row in zip(even, weights)})
    chord = lambda a, b, part: F.col(even[a]) + (F.col(even[b]) - F.col(even[a])) * part
    hulls = [F.greatest(*[chord(*c) for c in over]) if len(over) > 1 else F.col(even[k]) for k, over in enumerate(chords)]
    positive = reduce(lambda a, b: a & b, [h > 0 for h in hulls])
    ratio = F.when(positive, F.array(*[F.try_divide(F.col(c), h) for c, h in zip(even, hulls)]))
    at = F.array_position("__r", F.array_min("__r"))
    return d.withColumn("__r", ratio).select(
        "row", "col", (F.aggregate("__r", F.lit(0.0), lambda a, x: a + x) / len(bands)).alias("mean"), (1 - F.array_min("__r")).alias("depth"),
        F.element_at(F.array(*map(F.lit, wavelengths)), at.cast("int")).alias("position"),
    )


def continuum_sql(bands: list[str], wavelengths: list[float], source: str) -> str:
    """The same in SQL."""
    weights, chords = continuum_terms(wavelengths)
    even = ", ".join("0.0::double" + "".join(f" + {b} * {w!r}::double" for b, w in zip(bands, row) if w) + f" AS s{i}" for i, row in enumerate(weights))
    hulls = ["greatest(" + ", ".join(f"s{a} + (s{b} - s{a}) * {part!r}::double" for a, b, part in over) + ")" if len(over) > 1 else f"s{k}" for k, over in enumerate(chords)]
    n = len(bands)
    return f"""smooth AS (SELECT "row", col, {even} FROM {source}), hulls AS (SELECT *, {", ".join(f"{h} AS h{k}" for k, h in enumerate(hulls))} FROM smooth),
ratios AS (SELECT "row", col, CASE WHEN {" AND ".join(f"h{k} > 0" for k in range(n))} THEN [{", ".join(f"s{k} / h{k}" for k in range(n))}] END AS r FROM hulls)"""
