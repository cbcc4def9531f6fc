"""Grid queries do the whole job: each against a brute-force version over every pixel."""

import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.catalogue import QUERIES, scored
from gridloom.operators import hydrology, metrics, surface
from gridloom.sources.grid import pixel_grid

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pixels(spark):
    return np.array([(r["col"], r["row"], r["b08"]) for r in pixel_grid(spark, SF).select("col", "row", "b08").collect()], float)


def nodes(pixels):
    """(i, j) to (x, y) of 20 x 20 nodes over the bounds of all pixels and a tenth more."""
    (x0, y0), (x1, y1) = pixels[:, :2].min(0), pixels[:, :2].max(0)
    xs, ys = np.linspace(x0 - 0.1 * (x1 - x0), x1 + 0.1 * (x1 - x0), 20), np.linspace(y0 - 0.1 * (y1 - y0), y1 + 0.1 * (y1 - y0), 20)
    return {(i, j): (xs[j], ys[i]) for i in range(20) for j in range(20)}


def test_nodes_span_all_pixels(spark, pixels):
    got = {(r["i"], r["j"]): (r["gx"], r["gy"]) for r in QUERIES["grid_generate"](spark, SF).collect()}
    want = nodes(pixels)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-5) for k in want)


def test_every_point_weighs_and_every_node_has_a_nearest(spark, pixels):
    value = {(r["i"], r["j"]): r["value"] for r in QUERIES["idw_surface"](spark, SF).collect()}
    near = {(r["i"], r["j"]): r["distance"] for r in QUERIES["nearest_training_distance"](spark, SF).collect()}
    assert value.keys() == near.keys() == nodes(pixels).keys()
    for k, (x, y) in nodes(pixels).items():
        d = np.hypot(pixels[:, 0] - x, pixels[:, 1] - y)
        w = 1 / np.maximum(d, 1e-10) ** 2
        assert value[k] == pytest.approx((w * pixels[:, 2]).sum() / w.sum(), abs=2e-6)
        assert near[k] == pytest.approx(d.min(), abs=2e-6)


def test_far_nodes_count(spark):
    points = spark.createDataFrame([(0.0, 0.0, 1.0), (10.0, 0.0, 3.0)], "x double, y double, v double")
    far = spark.createDataFrame([(0, 0, 5.0, 400.0), (0, 1, 13.0, 4.0)], "i int, j int, gx double, gy double")
    assert {r["j"]: r["distance"] for r in surface.nearest_distance(far, points).collect()} == pytest.approx({0: np.hypot(5, 400), 1: 5.0})
    got = {r["j"]: r["value"] for r in surface.inverse_distance(far, points, "v", 2.0).collect()}
    a, b = 1 / (13**2 + 4**2), 1 / 25
    assert got == pytest.approx({0: 2.0, 1: (a + 3 * b) / (a + b)})
    none = surface.nearest_distance(far, points.limit(0)).collect()
    assert [r["distance"] for r in none] == [None, None]


def test_curves_take_every_score(spark):
    rows = [(r["y"], round(r["p"], 9)) for r in scored(spark, SF).select("y", "p").collect()]
    pairs = [(a, b) for y, a in rows if y for z, b in rows if not z]
    auc = sum(1.0 if a > b else 0.5 * (a == b) for a, b in pairs) / len(pairs)
    assert QUERIES["roc_auc"](spark, SF).first()["auc"] == pytest.approx(auc, abs=1e-6)
    positives = sum(y for y, _ in rows)
    above = {t: [y for y, p in rows if p >= t] for t in {p for _, p in rows}}
    want = sorted((t, sum(a) / len(a), sum(a) / positives) for t, a in above.items())
    got = sorted((r["threshold"], r["precision"], r["recall"]) for r in QUERIES["pr_curve"](spark, SF).collect())
    assert len(want) > 51 and len(got) == len(want)
    assert np.allclose(sorted(got, key=lambda x: (x[2], x[0])), sorted(want, key=lambda x: (round(x[2], 6), x[0])), atol=2e-6)


def test_running_sums_over_ranges(spark):
    rows = [(float(k * k % 997) / 7, k) for k in range(997)]
    per = spark.createDataFrame(rows, "s double, c long").groupBy("s").agg(F.sum("c").alias("c"))
    got = {r["s"]: r["upto_c"] for r in metrics.running(per, "s", ["c"]).collect()}
    for s, upto in got.items():
        assert upto == sum(c for x, c in rows if x <= s)
    assert len(got) == len({s for s, _ in rows})
    assert metrics.running(per.limit(0), "s", ["c"]).count() == 0
    assert metrics.roc_auc(spark.createDataFrame([(1, None), (0, 0.5)], "y int, s double"), "y", "s").first()["auc"] == 0


def test_flow_has_no_longest_path():
    assert list(inspect.signature(hydrology.flow_accumulation).parameters) == ["df", "value"]


@pytest.mark.parametrize("radius", [9, 15])
def test_wide_topographic_position(spark, radius):
    z = np.full((5, 51), np.nan)
    for r in pixel_grid(spark, SF).select("row", "col", "elevation").collect():
        z[r["row"], r["col"]] = r["elevation"]
    disk = [(a, b) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1) if a * a + b * b <= radius * radius]
    got = {(r["row"], r["col"]): r["tpi"] for r in QUERIES[f"tpi_r{radius}"](spark, SF).collect()}
    high, wide = max(r for r, _ in got), max(c for _, c in got)
    assert len(got) == np.isfinite(z).sum()
    for (r, c), v in got.items():
        around = [z[min(max(r + a, 0), high), min(max(c + b, 0), wide)] for a, b in disk]
        assert v == pytest.approx(z[r, c] - np.nanmean(around), abs=2e-6)
