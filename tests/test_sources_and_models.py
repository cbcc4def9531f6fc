"""Point tables, file checks, saved models, curves, filter banks and words for clusters."""

import hashlib
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import interpretation, metrics, models, texture
from gridloom.sources import grid


def test_points_of_geojson_and_csv(spark, tmp_path):
    square = [[0, 0], [4, 0], [4, 2], [0, 2], [0, 0]]
    hole = [[0, 0], [0, 2], [2, 2], [2, 0], [0, 0]]
    shapes = [("Point", [3.5, -1.0]), ("Polygon", [square]), ("Polygon", [square, hole]), ("Polygon", [square[::-1]]), ("LineString", [[0, 0], [1, 1]])]
    features = [{"type": "Feature", "geometry": {"type": k, "coordinates": c}, "properties": {"id": n, "name": "é"}} for n, (k, c) in enumerate(shapes)]
    features.append({"type": "Feature", "geometry": None, "properties": None})
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    got = grid.read_points(spark, str(tmp_path / "a.geojson")).collect()
    assert [(r["x"], r["y"]) for r in got] == [(3.5, -1.0), (2.0, 1.0), (3.0, 1.0), (2.0, 1.0), (None, None), (None, None)]
    assert got[1]["properties"] == {"id": "1", "name": "é"} and got[5]["properties"] is None
    (tmp_path / "b.csv").write_text("x,y,v\n1,2.5,a\n")
    assert grid.read_points(spark, str(tmp_path / "b.csv")).first()["y"] == 2.5


def test_files_are_checked(spark, tmp_path):
    files = {
        "good.tif": b"II*\0rest", "big.tif": b"MM\0*", "bad.tif": b"text", "empty.tif": b"", "a.geojson": b' \n{"type": 1}', "b.geojson": b"<xml>", "t.csv": b"x", "p.parquet": b"PAR1xx", "x.hdf": b"\x89HDF\r\n\x1a\nx",
    }
    for name, body in files.items():
        (tmp_path / name).write_bytes(body)
    got = {r["name"]: r["validation_error"] for r in grid.validated(spark, str(tmp_path)).collect()}
    files.pop("empty.tif")
    assert got == {**dict.fromkeys(files), "bad.tif": "Invalid spatial file", "b.geojson": "Invalid vector file"}
    sums = {r["path"].rsplit("/", 1)[1]: (r["md5"], r["sha256"]) for r in grid.digests(spark, str(tmp_path)).collect()}
    assert sums == {n: (hashlib.md5(b).hexdigest(), hashlib.sha256(b).hexdigest()) for n, b in files.items()}


def test_forests_are_saved_and_weighed(spark, tmp_path):
    r = np.random.default_rng(1)
    rows = [(float(a), float(b), float(c), int(a + 0.2 * b > 0)) for a, b, c in r.normal(size=(300, 3))]
    df = spark.createDataFrame(rows, "a double, b double, c double, y int")
    found = models.forest_importances(df, ["a", "b", "c"], "y", trees=10, depth=4).orderBy("rank").collect()
    assert found[0]["feature"] == "a" and found[-1]["cumulative"] == pytest.approx(1) and [x["rank"] for x in found] == [1, 2, 3]
    models.save_forest(df, ["a", "b", "c"], "y", str(tmp_path / "m"), trees=10, depth=4)
    again = models.apply_saved(df, str(tmp_path / "m"))
    fitted = models.random_forest(df, ["a", "b", "c"], "y", trees=10, depth=4)
    key = lambda d: sorted((x["a"], x["predicted"], round(x["probability"], 9)) for x in d.collect())
    assert key(again) == key(fitted)
    with pytest.raises(Exception, match="c"):
        models.apply_saved(df.drop("c"), str(tmp_path / "m")).count()


def test_roc_curve(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1)], "y int, s double")
    got = [(r["threshold"], r["fpr"], r["tpr"]) for r in metrics.roc_curve(df, "y", "s").orderBy(F.desc("threshold")).collect()]
    assert got == [(math.inf, 0.0, 0.0), (0.9, 0.5, 0.5), (0.5, 0.5, 1.0), (0.1, 1.0, 1.0)]


def test_bank_is_its_filters(spark):
    a = np.random.default_rng(2).normal(size=(18, 15))
    df = spark.createDataFrame([(r, c, float(a[r, c])) for r in range(18) for c in range(15)], "row int, col int, v double")
    bank = {(r["row"], r["col"]): r for r in texture.gabor_bank(df, "v", [0.2, 0.4], 2, 18, 15).collect()}
    assert len(next(iter(bank.values()))) == 2 + 4
    for name, f, theta in (("f0_o0", 0.2, 0.0), ("f1_o1", 0.4, math.pi / 2)):
        for r in texture.gabor(df, "v", f, theta, 18, 15).collect():
            assert bank[(r["row"], r["col"])][name] == pytest.approx(r["response"], abs=1e-9)


def test_wavelengths():
    assert interpretation.wavelengths(3, centres=[1, 2, 3]) == [1, 2, 3]
    assert interpretation.wavelengths(2, {"wavelengths": "450, 900.5"}, "landsat8") == [450.0, 900.5]
    assert interpretation.wavelengths(7, {"wavelengths": "blue"}, "landsat8")[0] == 443.0
    assert interpretation.wavelengths(3) == [400.0, 1450.0, 2500.0] and interpretation.wavelengths(1) == [400.0]


def test_words_for_clusters(spark):
    features = ["Elevation", "slope", "ndvi", "cu_ppm", "clay", "fault_distance", "other"]
    # The first kind that fits: a fault has gold's letters in it.
    assert interpretation.kinds(features) == {"topographic": ["Elevation", "slope"], "spectral": ["ndvi"], "geochemical": ["cu_ppm", "fault_distance"], "alteration": ["clay"]}
    columns = ", ".join(f"{f}_{s} double" for f in features for s in ("mean", "std"))
    rows = [(1, *[1200.0, 1.0, 40.0, 1.0, 0.6, 0.1, 5.0, 1.0, 0.0, 0.0, 1.0, 1.0, 0.0, 0.0]), (2, *[700.0, 1.0, 2.0, 1.0, 0.0, 0.1, 0.5, 1.0, 0.0, 0.0, 1.0, 1.0, 0.0, 0.0])]
    got = {r["cluster"]: (r["signature"], r["targets"]) for r in interpretation.signatures(spark.createDataFrame(rows, f"c int, {columns}"), "c", features).collect()}
    assert got[1][0].startswith("high elevation; steep terrain; dense vegetation; elevated cu_ppm")
    assert got[2][0] == "moderate elevation; flat terrain; sparse vegetation/bare rock"
    none = interpretation.signatures(spark.createDataFrame([(1, 2.0, 1.0)], "c int, q_mean double, q_std double"), "c", ["q"]).first()
    assert (none["signature"], none["targets"]) == ("undefined signature", "background/host rock")
