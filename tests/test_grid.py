import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions.bandmath import band_math, compile_expression, spectral_index
from gridloom.operators import features, focal, hydrology, masks, metrics, models, spectral, surface, terrain, texture
from gridloom.sources.grid import fill_nodata, inventory, null_if, write_layers


def grid(spark, values):
    rows = [(r, c, None if v is None else float(v)) for r, line in enumerate(values) for c, v in enumerate(line)]
    return spark.createDataFrame(rows, "row int, col int, z double")


def cells(df, name):
    return {(r["row"], r["col"]): r[name] for r in df.select("row", "col", name).collect()}


def test_plane_has_constant_slope(spark):
    plane = grid(spark, [[2 * r + 3 * c for c in range(5)] for r in range(4)])
    out = terrain.slope_aspect(plane, "z").agg(F.min("slope").alias("a"), F.max("slope").alias("b")).first()
    assert out["a"] == pytest.approx(out["b"]) == pytest.approx(math.degrees(math.atan(math.sqrt(13))))


def test_gradient_is_numpys(spark):
    z = np.random.default_rng(1).normal(size=(6, 7))
    out = focal.gradient(grid(spark, z.tolist()), "z", "gx", "gy")
    gy, gx = np.gradient(z)
    assert all(v == pytest.approx(gx[k]) for k, v in cells(out, "gx").items())
    assert all(v == pytest.approx(gy[k]) for k, v in cells(out, "gy").items())


@pytest.mark.parametrize("nearest", [True, False])
def test_neighbours(spark, nearest):
    z = np.arange(12.0).reshape(3, 4)
    got = cells(focal.neighbours9(grid(spark, z.tolist()), "z", "v", nearest), "v")
    padded = np.pad(z, 1, mode="edge") if nearest else np.pad(z, 1, constant_values=np.nan)
    for (r, c), v in got.items():
        want = padded[r : r + 3, c : c + 3].ravel()
        assert [None if math.isnan(x) else x for x in want] == v


def test_pit_and_flat(spark):
    pit = terrain.flow_direction(grid(spark, [[5, 5, 5], [5, 1, 5], [5, 5, 5]]), "z")
    got = cells(pit, "direction")
    assert got[1, 1] == -1 and got[0, 1] == 6 and got[0, 0] == 7
    flat = terrain.curvatures(grid(spark, [[1] * 4] * 4), "z").agg(F.max(F.abs("plan")), F.max(F.abs("profile"))).first()
    assert tuple(flat) == (0.0, 0.0)


def test_erosion_within_mask_within_dilation(spark):
    m = grid(spark, [[(r + c) % 3 == 0 for c in range(6)] for r in range(5)])
    out = focal.morphology(focal.morphology(m, "z", "e", True), "z", "d", False)
    assert out.filter("e > z OR z > d").count() == 0


def test_expressions(spark):
    df = spark.createDataFrame([(1.0, 0.0), (4.0, 2.0)], "a double, b double")
    say = lambda text: [r[0] for r in df.select(compile_expression(text, {"a": "a", "b": "b"})).collect()]
    assert say("a / b") == [None, 2.0]
    assert say("0 < b < a") == [False, True]
    assert say("where(a > 2, sqrt(a), -a ** 2)") == [-1.0, 2.0]
    for bad in ("__import__('os')", "a.b", "c + 1", "a[0]", "'x'", "max(a, key=b)"):
        with pytest.raises((ValueError, SyntaxError)):
            compile_expression(bad, {"a": "a", "b": "b"})
    masked = band_math(df, {"v": "a / b"}, mask="a > 2", clip=(0.0, 1.0), scale=10.0).select("v").collect()
    assert [r[0] for r in masked] == [None, 10.0]


def test_nulls_pass_through(spark):
    df = spark.createDataFrame([(0.2, None), (float("nan"), 0.1), (-9999.0, 0.4)], "b04 double, b08 double")
    clean = null_if(df, ["b04", "b08"])
    assert [r[0] for r in clean.select(spectral_index("NDVI")).collect()] == [None, None, None]
    assert [r[0] for r in fill_nodata(clean, ["b04"]).select("b04").collect()] == [0.2, -9999.0, -9999.0]


def test_checkerboard_texture(spark):
    board = texture.quantise(grid(spark, [[(r + c) % 2 for c in range(6)] for r in range(6)]), "z", 2)
    near, far = (texture.texture_features(texture.co_occurrence(board, "level", 0, d)).first() for d in (1, 2))
    assert near["contrast"] == pytest.approx(1) and near["correlation"] == pytest.approx(-1)
    assert far["contrast"] == 0 and far["homogeneity"] == pytest.approx(1)


def test_resample_and_mosaic(spark):
    g = grid(spark, [[r * 4 + c for c in range(4)] for r in range(4)])
    assert cells(texture.downsample(g, "z", 2, "average"), "value") == {(0, 0): 2.5, (0, 1): 4.5, (1, 0): 10.5, (1, 1): 12.5}
    up = cells(texture.upsample_bilinear(g, "z", 2), "value")
    assert len(up) == 64 and up[0, 1] == 0.5 and up[1, 1] == 2.5
    other = g.withColumn("z", F.col("z") + 100)
    assert cells(texture.mosaic([g, other], "z", "last"), "value")[0, 0] == 100


def test_metrics_of_a_perfect_and_a_blind_model(spark):
    df = spark.createDataFrame([(k % 2, k % 2, 0.9 if k % 2 else 0.1, 0.5) for k in range(10)], "y int, z int, p double, q double")
    best = metrics.binary_metrics(df, "y", "z").first()
    assert best["accuracy"] == best["mcc"] == best["kappa"] == best["f1"] == 1
    assert metrics.roc_auc(df, "y", "p").first()[0] == 1 and metrics.roc_auc(df, "y", "q").first()[0] == 0.5


def test_scaling_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in features.scale(df, ["a", "b"], "standard").orderBy("a").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_interpolation_meets_its_points(spark):
    pts = spark.createDataFrame([(0.0, 0.0, 1.0), (10.0, 10.0, 3.0)], "x double, y double, v double")
    nodes = spark.createDataFrame([(0, 0, 0.0, 0.0), (0, 1, 5.0, 5.0), (1, 1, 99.0, 99.0)], "i int, j int, gx double, gy double")
    got = {(r["i"], r["j"]): r["value"] for r in surface.inverse_distance(nodes, pts, "v", 2.0, 8.0).collect()}
    assert got[0, 0] == pytest.approx(1.0) and got[0, 1] == pytest.approx(2.0) and got[1, 1] == 0.0


def test_continuum(spark):
    bands, waves = ["a", "b", "c", "d"], [1.0, 2.0, 3.0, 4.0]
    df = spark.createDataFrame([(0, 0, 1.0, 0.5, 1.0, 1.0), (0, 1, 1.0, 2.0, 3.0, 4.0)], "row int, col int, a double, b double, c double, d double")
    got = {r["col"]: r for r in spectral.continuum_removed(df, bands, waves).collect()}
    assert got[0]["depth"] == pytest.approx(0.5) and got[0]["position"] == 2.0
    assert got[1]["depth"] == pytest.approx(0.0)


def test_masks(spark):
    df = spark.createDataFrame([(k,) for k in range(12)], "scl int")
    kept = df.filter(~masks.scene_mask(F.col("scl"), conservative=True, keep_bright=False)).collect()
    assert [r[0] for r in kept] == [0, 2, 4, 5, 6, 7]
    assert masks.coverage(df, F.col("scl") == 8, F.col("scl") == 3).first()["rating"] == "fair"


def test_files(spark, tmp_path):
    g = grid(spark, [[1, None], [3, 4]])
    write_layers(g, ["z"], str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.agg(F.min("value")).first()[0] == -9999.0 and back.first()["layer"] == "z"
    (tmp_path / "a.tif").write_bytes(b"x" * 10)
    (tmp_path / "b.csv").write_text("x\n1\n")
    found = {r["name"]: r["file_type"] for r in inventory(spark, str(tmp_path), "[ab].*").collect()}
    assert found == {"a.tif": "spatial", "b.csv": "data"}


def test_elbow():
    assert models.elbow([(2, 100.0), (3, 40.0), (4, 35.0), (5, 31.0), (6, 28.0)]) == 3


def test_flow_reaches_the_outlet(spark):
    slope = grid(spark, [[10 - c + 0.1 * r for c in range(6)] for r in range(3)]).withColumnRenamed("z", "elevation")
    got = cells(hydrology.flow_accumulation(slope), "cells")
    assert got[0, 5] == 18 and got[2, 0] == 1


def test_pits_are_filled_and_constants_stay(spark):
    pit = hydrology.fill_pits(grid(spark, [[5] * 5, [5] * 5, [5, 5, 1, 5, 5], [5] * 5, [5] * 5]), "z", 1, 5, 5)
    assert set(cells(pit, "filled").values()) == {5.0}
    smooth = focal.gaussian(grid(spark, [[2] * 4] * 4), "z", 1.0, 4, 4)
    assert all(v == pytest.approx(2.0) for v in cells(smooth, "value").values())
