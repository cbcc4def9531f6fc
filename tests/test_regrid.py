"""Resampling, alignment, projections, outlines, smoothing and patterns against plain versions."""

import json
import math
from functools import partial

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.operators import focal, predictions, regrid, rings, texture
from gridloom.operators.regrid import Grid


def grid(spark, a):
    r, c = np.indices(a.shape)
    rows = [(int(x), int(y), None if np.isnan(v) else float(v)) for x, y, v in zip(r.ravel(), c.ravel(), a.ravel())]
    return spark.createDataFrame(rows, "row int, col int, v double")


def array(df, shape, column="value"):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["row"], r["col"]] = np.nan if r[column] is None else r[column]
    return out


def plane(n=12, m=9):
    r, c = np.indices((n, m))
    return 2.0 * r + 3.0 * c + 1


@pytest.mark.parametrize("kernel", ["bilinear", "cubic", "cubic_spline", "lanczos"])
def test_resampling_keeps_constants_and_itself(spark, monkeypatch, kernel):
    monkeypatch.setattr(regrid, "TILE", 5)  # many tiles
    source = Grid(0.0, 12.0, 1.0, 12, 9)
    finer = Grid(-0.5, 12.0, 0.4, 30, 24)
    got = array(regrid.resampled(grid(spark, np.full((12, 9), 7.0)), "v", source, finer, kernel), (30, 24))
    assert np.allclose(got, 7.0)
    same = array(regrid.resampled(grid(spark, plane()), "v", source, source, kernel), (12, 9))
    assert np.allclose(same, plane()) or kernel == "cubic_spline"  # which smooths
    if kernel != "lanczos":  # planes stay planes inside
        got = array(regrid.resampled(grid(spark, plane()), "v", source, Grid(0.0, 12.0, 0.5, 24, 18), kernel), (24, 18))
        r, c = np.indices((24, 18))
        assert np.allclose(got[5:-5, 5:-5], (2.0 * ((r + 0.5) / 2 - 0.5) + 3.0 * ((c + 0.5) / 2 - 0.5) + 1)[5:-5, 5:-5])


def test_resampling_missing_cells(spark):
    a = plane()
    a[3:9, 2:7] = np.nan
    source, target = Grid(0.0, 12.0, 1.0, 12, 9), Grid(0.0, 12.0, 0.5, 24, 18)
    got = array(regrid.resampled(grid(spark, a), "v", source, target, "bilinear"), (24, 18))
    assert np.isnan(got[10, 9]) and not np.isnan(got[0]).any()
    assert regrid.resampled(grid(spark, a).limit(0), "v", source, target, "cubic").count() == 0
    assert regrid.resampled(grid(spark, np.full((3, 3), np.nan)), "v", source, target, "cubic").count() == 0


@pytest.mark.parametrize(("step", "left", "top"), [(2.5, 0.0, 12.0), (0.4, 0.3, 11.7), (1.0, -0.25, 12.5), (3.0, -4.0, 20.0)])
def test_alignment_keeps_sums(spark, step, left, top):
    a = np.random.default_rng(1).uniform(0, 9, (12, 9))
    target = Grid(left, top, step, math.ceil(22 / step), math.ceil(14 / step))
    met = regrid.aligned_by_area(grid(spark, a), "v", Grid(0.0, 12.0, 1.0, 12, 9), target, total=True).collect()
    inside = sum(
        a[r, c] * max(0, min(c + 1, left + target.cols * step) - max(c, left)) * max(0, min(12 - r, top) - max(11 - r, top - target.rows * step))
        for r in range(12) for c in range(9)
    )
    assert sum(x["value"] for x in met) == pytest.approx(inside)
    mean = regrid.aligned_by_area(grid(spark, np.full((12, 9), 3.0)), "v", Grid(0.0, 12.0, 1.0, 12, 9), target).collect()
    assert {round(x["value"], 9) for x in mean} == {3.0} and max(x["covered"] for x in mean) <= 1 + 1e-9


def test_target_grid():
    scenes = [Grid(3.2, 50.1, 1.0, 10, 10), Grid(-1.0, 49.0, 0.5, 8, 30)]
    assert regrid.target_grid(scenes, 2.0) == Grid(-2.0, 52.0, 2.0, 6, 8)
    assert regrid.target_grid(scenes, 2.0, union=False) == Grid(2.0, 52.0, 2.0, 6, 6)
    assert regrid.target_grid(scenes, 0.5, reference=1, union=False, snap=False) == Grid(-1.0, 49.0, 0.5, 8, 30)


def test_projections(spark):
    # Published places: the middle of a zone, the equator's edge, and a tower in a northern and one in a southern zone.
    rows = [(3.0, 0.0, 31, False), (2.294481, 48.858370, 31, False), (151.215297, -33.856784, 56, True), (-177.5, 71.0, 1, False)]
    for lon, lat, zone, south in rows:
        df = spark.createDataFrame([(lon, lat)], "lon double, lat double")
        there = regrid.utm_forward(df, "lon", "lat", "e", "n", zone, south)
        back = regrid.utm_inverse(there, "e", "n", "lon2", "lat2", zone, south).first()
        assert abs(back["lon2"] - lon) * 111_000 < 1e-6 and abs(back["lat2"] - lat) * 111_000 < 1e-6
        # An independent measure: the meridian's arc by numbers.
        if lon == 3.0 * 1.0 and lat == 0.0:
            assert (back["e"], back["n"]) == (500_000.0, 0.0)
    e2 = regrid.ECCENTRIC**2
    t = np.linspace(0, math.radians(48.0), 200_001)
    arc = np.trapezoid(regrid.AXIS * (1 - e2) / (1 - e2 * np.sin(t) ** 2) ** 1.5, t)
    middle = regrid.utm_forward(spark.createDataFrame([(3.0, 48.0)], "lon double, lat double"), "lon", "lat", "e", "n", 31).first()
    assert middle["n"] == pytest.approx(0.9996 * arc, abs=1e-3) and middle["e"] == pytest.approx(500_000.0, abs=1e-9)
    web = regrid.mercator_inverse(regrid.mercator_forward(spark.createDataFrame([(11.0, 47.0)], "lon double, lat double"), "lon", "lat", "x", "y"), "x", "y", "a", "b").first()
    assert (web["a"], web["b"]) == pytest.approx((11.0, 47.0)) and web["x"] == pytest.approx(1224514.3987, abs=1e-3)


def test_reprojection_of_a_plane(spark):
    source = Grid(85.0, 28.0, 0.01, 12, 9)
    target = regrid.covering(grid(spark, plane()), source, partial(regrid.utm_forward, zone=45), 500.0)
    found = regrid.reprojected(grid(spark, plane()), "v", source, target, partial(regrid.utm_inverse, zone=45), "bilinear")
    near = regrid.reprojected(grid(spark, plane()), "v", source, target, partial(regrid.utm_inverse, zone=45))
    assert near.count() == found.count() > 400
    inner = found.join(near.withColumnRenamed("value", "n"), ["row", "col"])
    assert inner.filter(F.abs(F.col("value") - F.col("n")) > 2.5 + 1e-6).isEmpty()


def shoelace(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def test_outlines(spark):
    r = np.random.default_rng(4)
    a = (r.uniform(size=(14, 11)) < 0.6).astype(float)
    a[2:9, 2:9], a[4:7, 4:7], a[5, 5] = 1, 0, 1  # a ring around a hole with an island
    cells = grid(spark, a).filter("v = 1").withColumn("zone", F.lit(1))
    regions = predictions.regions(cells, "zone", 11)
    owner = array(regions, a.shape, "region")
    shapes = rings.polygons(regions, ["zone"]).collect()
    assert len(shapes) == len(np.unique(owner[a == 1]))
    for s in shapes:
        found = json.loads(s["geometry"])["coordinates"]
        assert all(x[0] == x[-1] and len({tuple(p) for p in x}) == len(x) - 1 for x in found) or s["holes"]
        assert all((p[0] != q[0]) != (p[1] != q[1]) for x in found for p, q in zip(x, x[1:]))  # sides turn at each corner
        assert all(not (p[0] == q[0] == t[0] or p[1] == q[1] == t[1]) for x in found for p, q, t in zip([x[-2], *x], x, x[1:]))
        areas = [-shoelace(x) for x in found]  # y goes up
        assert areas[0] > 0 and all(x < 0 for x in areas[1:]) and sum(areas) == s["area"] == (owner == s["region"]).sum()
        assert len(found) == 1 + s["holes"] and s["zone"] == 1

        def within(row, col):  # rays to the right
            x, y = col + 0.5, -row - 0.5
            return sum(p[0] > x and min(p[1], q[1]) < y < max(p[1], q[1]) for ring in found for p, q in zip(ring, ring[1:])) % 2 == 1

        for row in range(14):
            for col in range(11):
                assert within(row, col) == (owner[row, col] == s["region"])


def test_outlines_of_nothing(spark):
    cells = spark.createDataFrame([], "row int, col int, region long")
    assert rings.polygons(cells, []).count() == 0


@pytest.mark.parametrize("size", [3, 11])
def test_smoothing(spark, monkeypatch, size):
    monkeypatch.setattr(focal, "STRIP", 2000)
    a = np.random.default_rng(5).normal(size=(23, 17))
    a[4, 4] = np.nan
    padded = np.pad(a, size // 2, mode="symmetric")
    views = np.lib.stride_tricks.sliding_window_view(padded, (size, size)).reshape(23, 17, -1)
    assert np.allclose(array(focal.median(grid(spark, a), "v", size, 23, 17), a.shape), np.nanmedian(views, axis=2))
    assert np.allclose(array(focal.uniform(grid(spark, a), "v", size, 23, 17), a.shape), np.nanmean(views, axis=2))
    kept = array(focal.smoothed(grid(spark, a), "v", "median", (size - 1) / 2, 23, 17), a.shape)
    assert np.allclose(kept, np.clip(np.nanmedian(views, axis=2), 0, 1))
    with pytest.raises(ValueError):
        focal.median(grid(spark, a), "v", 4, 23, 17)


def test_patterns(spark):
    flat = array(texture.binary_patterns(grid(spark, np.full((15, 15), 0.5)), "v", 15, 15), (15, 15), "code")
    assert (flat[3:-3, 3:-3] == 24).all()
    peak = np.full((15, 15), 0.2)
    peak[7, 7] = 0.9
    assert array(texture.binary_patterns(grid(spark, peak), "v", 15, 15), (15, 15), "code")[7, 7] == 0
    step = np.where(np.arange(15)[None] < 8, 0.2, 0.8) * np.ones((15, 1))
    codes = array(texture.binary_patterns(grid(spark, step), "v", 15, 15), (15, 15), "code")
    assert 8 <= codes[7, 8] <= 16 and codes[7, 7] == 24
    noisy = array(texture.binary_patterns(grid(spark, np.random.default_rng(6).uniform(size=(15, 15))), "v", 15, 15), (15, 15), "code")
    assert (noisy == 25).mean() > 0.5
    assert array(texture.pattern_variance(grid(spark, peak), "v", 15, 15), (15, 15), "variance").max() > 0
