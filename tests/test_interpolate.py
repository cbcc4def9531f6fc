"""Interpolators against dense solutions and brute force."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.operators import interpolate as ip


def scattered(n, seed=1, clustered=False):
    r = np.random.default_rng(seed)
    xy = r.uniform(0, 100, (n, 2))
    if clustered:
        xy = np.r_[xy[: n // 3], 70 + r.normal(0, 0.5, (n - n // 3, 2))]
    return np.column_stack([xy, np.sin(xy[:, 0] / 20) + np.cos(xy[:, 1] / 15)])


def frames(spark, points, nodes):
    p = spark.createDataFrame(pd.DataFrame(points, columns=["x", "y", "v"]))
    g = spark.createDataFrame(pd.DataFrame([(k // 7, k % 7, float(a), float(b)) for k, (a, b) in enumerate(nodes)], columns=["i", "j", "gx", "gy"]))
    return p, g


def lattice(lo=-10.0, hi=110.0, n=7):
    return [(a, b) for a in np.linspace(lo, hi, n) for b in np.linspace(lo, hi, n)]


def by_node(df, *columns):
    return {(r["i"], r["j"]): tuple(r[c] for c in columns) for r in df.collect()}


@pytest.mark.parametrize("clustered", [False, True])
@pytest.mark.parametrize("crowded", [10**6, 40])
def test_neighbours_are_complete(spark, monkeypatch, clustered, crowded):
    monkeypatch.setattr(ip, "TILE_POINTS", 30)
    monkeypatch.setattr(ip, "CROWDED", crowded)
    points, nodes = scattered(500, 2, clustered), [*lattice(), (500.0, -300.0), (70.0, 70.0)]
    p, g = frames(spark, points, nodes)
    got = by_node(ip.neighbours(g, ip.places(p, "v"), 9), "near")
    assert len(got) == len(nodes)
    for k, (x, y) in enumerate(nodes):
        want = sorted((math.sqrt((a - x) ** 2 + (b - y) ** 2), a, b) for a, b, _ in points)[:9]
        assert np.allclose([(n["d"], n["x"], n["y"]) for n in got[(k // 7, k % 7)][0]], want, rtol=1e-12)


def test_neighbours_of_few_and_awkward_points(spark):
    rows = [(1.0, 1.0, 2.0), (1.0, 1.0, 4.0), (None, 1.0, 1.0), (float("nan"), 0.0, 1.0), (5.0, float("inf"), 1.0), (3.0, 1.0, None)]
    p = spark.createDataFrame(rows, "x double, y double, v double")
    _, g = frames(spark, scattered(3), [(0.0, 0.0), (9.0, 9.0)])
    for near, known in by_node(ip.neighbours(g, ip.places(p, "v"), 4), "near", "known").values():
        assert [(n["x"], n["y"], n["v"]) for n in near] == [(1.0, 1.0, 3.0)] and known == math.inf
    none = p.limit(0)
    assert [r["value"] for f in (ip.kriging, ip.radial, ip.triangulated, ip.nearest) for r in f(g, none, "v").collect()] == [None] * 8
    assert [r["value"] for r in ip.radial(g, p, "v").collect()] == pytest.approx([3.0, 3.0])
    assert {r["value"] for r in ip.triangulated(g, p, "v").collect()} == {None}


def dense_kriging(points, nodes, length, noise):
    d2 = ((points[:, None, :2] - points[None, :, :2]) ** 2).sum(2)
    system = np.exp(-0.5 * d2 / length**2) + (noise + 1e-6) * np.eye(len(points))
    beside = np.exp(-0.5 * ((np.array(nodes)[:, None] - points[None, :, :2]) ** 2).sum(2) / length**2)
    return beside @ np.linalg.solve(system, points[:, 2]), 1 + noise - (beside * np.linalg.solve(system, beside.T).T).sum(1)


def test_kriging_is_the_dense_solution(spark):
    points, nodes = scattered(40, 3), lattice()
    p, g = frames(spark, points, nodes)
    mean, variance = dense_kriging(points, nodes, 12.0, 0.01)
    got = by_node(ip.kriging(g, p, "v", k=64, length=12.0), "value", "variance")
    for k in range(len(nodes)):
        assert got[(k // 7, k % 7)] == pytest.approx((mean[k], variance[k]), abs=1e-6)


def test_kriging_by_neighbourhoods(spark, monkeypatch):
    monkeypatch.setattr(ip, "TILE_POINTS", 50)
    points, nodes = scattered(600, 4), lattice(5.0, 95.0)
    p, g = frames(spark, points, nodes)
    mean, _ = dense_kriging(points, nodes, 4.0, 0.01)
    got = by_node(ip.kriging(g, p, "v", k=48, length=4.0), "value")
    assert max(abs(got[(k // 7, k % 7)][0] - mean[k]) for k in range(len(nodes))) < 0.02  # far points weigh little


def dense_radial(points, nodes, kernel, smoothing=0.0):
    phi, degree = ip.RADIAL[kernel]
    n, poly = len(points), ip.monomials(points[:, 0], points[:, 1], degree)
    system = np.zeros((n + poly.shape[1],) * 2)
    system[:n, :n] = phi(np.hypot(points[:, None, 0] - points[None, :, 0], points[:, None, 1] - points[None, :, 1])) + smoothing * np.eye(n)
    system[:n, n:], system[n:, :n] = poly, poly.T
    w = np.linalg.solve(system, np.r_[points[:, 2], np.zeros(poly.shape[1])])
    g = np.array(nodes)
    far = np.hypot(g[:, None, 0] - points[None, :, 0], g[:, None, 1] - points[None, :, 1])
    return phi(far) @ w[:n] + ip.monomials(g[:, 0], g[:, 1], degree) @ w[n:]


@pytest.mark.parametrize(("kernel", "smoothing"), [("thin_plate_spline", 0.0), ("thin_plate_spline", 50.0), ("cubic", 0.0), ("linear", 0.0), ("linear", 2.0)])
def test_radial_is_the_dense_solution(spark, kernel, smoothing):
    points, nodes = scattered(45, 5), lattice()
    p, g = frames(spark, points, nodes)
    want = dense_radial(points, nodes, kernel, smoothing)
    got = by_node(ip.radial(g, p, "v", kernel, smoothing, k=64), "value")
    assert [got[(k // 7, k % 7)][0] for k in range(len(nodes))] == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("clustered", [False, True])
def test_radial_patches_keep_points_and_planes(spark, clustered):
    points = scattered(400, 6, clustered)
    p, g = frames(spark, points, points[::9, :2])
    got = by_node(ip.radial(g, p, "v", k=32), "value")
    assert [got[(k // 7, k % 7)][0] for k in range(len(points[::9]))] == pytest.approx(points[::9, 2], abs=1e-6)
    p, g = frames(spark, np.column_stack([points[:, :2], 3 + 2 * points[:, 0] - points[:, 1]]), lattice())
    got = by_node(ip.radial(g, p, "v", k=32), "value")
    assert [got[(k // 7, k % 7)][0] for k in range(49)] == pytest.approx([3 + 2 * a - b for a, b in lattice()], abs=1e-5)


def brute_linear(points, x, y):
    """The value over the triangle whose circumcircle is empty; None outside."""
    for t in itertools.combinations(range(len(points)), 3):
        a, b, c = points[list(t), :2]
        base = np.array([[a[0], b[0], c[0]], [a[1], b[1], c[1]], [1, 1, 1]])
        if abs(np.linalg.det(base)) < 1e-9:
            continue
        w = np.linalg.solve(base, [x, y, 1])
        if (w < -1e-9).any():
            continue
        m = np.linalg.solve(2 * np.array([b - a, c - a]), [b @ b - a @ a, c @ c - a @ a])
        if (((points[:, :2] - m) ** 2).sum(1) >= ((a - m) ** 2).sum() * (1 - 1e-9)).all():
            return w @ points[list(t), 2]
    return None


def test_linear_is_barycentric(spark):
    points, nodes = scattered(28, 7), [*lattice(n=7), *[(float(x), float(y)) for x, y, _ in scattered(4, 7)]]
    p, g = frames(spark, points, nodes)
    want = [brute_linear(points, x, y) for x, y in nodes]
    assert sum(w is None for w in want) > 10 < sum(w is not None for w in want)
    for k in (6, 64):
        got = by_node(ip.triangulated(g, p, "v", k=k), "value")
        assert [got[(n // 7, n % 7)][0] for n in range(len(nodes))] == pytest.approx(want, abs=1e-6)


def test_linear_on_a_lattice_and_its_border(spark):
    points = np.array([(x, y, 2 * x + 3 * y) for x in range(9) for y in range(6)], float)
    nodes = [(x, y) for x in (0.0, 3.0, 4.5, 8.0) for y in (0.0, 2.5, 5.0)] + [(8.1, 3.0), (-0.1, 0.0)]
    p, g = frames(spark, points, nodes)
    for method in ("linear", "cubic"):
        got = by_node(ip.triangulated(g, p, "v", method, k=16), "value")
        values = [got[(n // 7, n % 7)][0] for n in range(len(nodes))]
        assert values == pytest.approx([2 * x + 3 * y for x, y in nodes[:-2]] + [None, None], abs=1e-6)


def test_cubic_keeps_quadratics_and_is_smooth(spark):
    points = scattered(300, 8)
    points[:, 2] = 1 + points[:, 0] * 0.5 + points[:, 1] ** 2 / 50 - points[:, 0] * points[:, 1] / 30
    nodes = lattice(20.0, 80.0)
    p, g = frames(spark, points, nodes)
    got = by_node(ip.triangulated(g, p, "v", "cubic"), "value")
    assert [got[(n // 7, n % 7)][0] for n in range(49)] == pytest.approx([1 + x * 0.5 + y * y / 50 - x * y / 30 for x, y in nodes], abs=1e-6)
    # Two triangles over one edge with slopes at their corners: the same value and slope on both sides.
    r = np.random.default_rng(1)
    corner, value, slope = np.array([[0, 0], [4, 1], [1, 3], [5, 5]], float), r.normal(size=4), r.normal(size=(4, 2))

    def at(t, x, y):
        base = np.vstack([corner[t].T, np.ones(3)])
        return ip.clough_tocher(corner[t], value[t], slope[t], np.linalg.solve(base, [x, y, 1]))

    for s in (0.2, 0.5, 0.9):
        x, y = corner[1] + s * (corner[2] - corner[1])
        assert at([0, 1, 2], x, y) == pytest.approx(at([3, 1, 2], x, y), abs=1e-9)
        e = 1e-6
        for dx, dy in ((e, 0), (0, e)):
            first, second = ((at(t, x + dx, y + dy) - at(t, x - dx, y - dy)) / (2 * e) for t in ([0, 1, 2], [3, 1, 2]))
            assert first == pytest.approx(second, abs=1e-4)


def test_hull(spark):
    points = scattered(500, 9)
    p, _ = frames(spark, points, [(0.0, 0.0)])
    hull = ip.hull_of(ip.places(p, "v").repartition(5))
    assert ip.inside(hull, points[:, 0], points[:, 1]).all() and len(hull) < 40
    assert not ip.inside(hull, np.array([-1.0, 101.0]), np.array([50.0, 50.0])).any()


def test_nearest(spark):
    points, nodes = scattered(200, 10), lattice()
    p, g = frames(spark, points, nodes)
    got = by_node(ip.nearest(g, p.withColumn("near", F.lit(1)), "v"), "value", "distance")
    for k, (x, y) in enumerate(nodes):
        d, v = min((math.hypot(a - x, b - y), v) for a, b, v in points)
        assert got[(k // 7, k % 7)] == pytest.approx((v, d))
