"""Names, ground measures, predictions and validation on small fixtures."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridloom.functions import geo, naming
from gridloom.operators import features, focal, hydrology, predictions, texture, validation
from gridloom.operators.surface import haversine_km


def test_configuration_values():
    base = {"a": {"b": 1, "c": 2}, "d": 3}
    assert naming.merged(base, {"a": {"b": 9}, "e": 4}) == {"a": {"b": 9, "c": 2}, "d": 3, "e": 4} and base["a"]["b"] == 1
    assert naming.get_dotted(base, "a.c") == 2 and naming.get_dotted(base, "a.x.y", 7) == 7 and naming.get_dotted(base, "d.x") is None
    assert naming.set_dotted(base, "a.x.y", 5)["a"]["x"] == {"y": 5} and "x" not in base["a"]
    assert naming.with_environment("${HOME:x} ${GONE:y} ${GONE}", {"HOME": "h"}) == "h y ${GONE}"
    assert naming.load_config('{"a": 1}', "json") == {"a": 1} and naming.load_config("a = 1", "toml") == {"a": 1}
    with pytest.raises(ValueError):
        naming.load_config("", "ini")
    assert naming.chosen_bands(["red_4", "nir_8", "b11"], ["nir", 4, "11", "x"]) == ["nir_8", "red_4", "b11"]


def test_tails():
    assert validation.chi2_tail(9.487729, 4) == pytest.approx(0.05, abs=1e-6)
    assert validation.chi2_tail(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert validation.chi2_tail(80.0, 10) < 1e-10 and validation.chi2_tail(0, 3) == 1
    assert validation.t_quantile(0.975, 4) == pytest.approx(2.7764451, abs=1e-6)
    assert validation.t_quantile(0.975, 1) == pytest.approx(12.7062047, rel=1e-4)
    assert validation.t_tail(0, 7) == pytest.approx(0.5)
    even = validation.fold_interval([0.5, 0.5, 0.5])
    assert even["t"] == 0 and even["p_value"] == pytest.approx(1)
    assert validation.fold_interval([0.9, 0.9])["p_value"] == 0


def test_regions_touch_by_a_side(spark):
    lines = ["aabb", "caab", "ccca", "aaca"]
    cells = [(r, c, z) for r, line in enumerate(lines) for c, z in enumerate(line)]
    got = {(x["row"], x["col"]): x["region"] for x in predictions.regions(spark.createDataFrame(cells, "row int, col int, zone string"), "zone", 4).collect()}
    assert [[got[r, c] for c in range(4)] for r in range(4)] == [[0, 0, 2, 2], [4, 0, 0, 2], [4, 4, 4, 11], [12, 12, 4, 11]]


def test_layers_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(0, 0, [0.2, 0.5, 0.3]), (0, 1, [0.4, 0.4, 0.2])], "row int, col int, p array<double>")
    layers = predictions.class_layers(df, "p")
    assert [(r["class"], r["confidence"], r["probability_2"]) for r in layers.orderBy("col").collect()] == [(1, 0.5, 0.3), (0, 0.4, 0.2)]
    grid = spark.createDataFrame([(0, 0), (0, 2)], "row int, col int")
    assert [tuple(r) for r in predictions.on_grid(grid, layers, ["class"]).orderBy("col").collect()] == [(0, 0, 1.0), (0, 2, -9999.0)]
    predictions.write_mask(df.withColumn("m", F.when(F.col("col") == 1, True)), "m", str(tmp_path / "mask"))
    assert [r["m"] for r in spark.read.parquet(str(tmp_path / "mask")).orderBy("col").collect()] == [0, 1]
    predictions.write_dem(df.withColumn("z", F.col("col") * 2.0), ["z"], str(tmp_path / "dem"))
    assert spark.read.json(str(tmp_path / "dem/metadata")).first()["max"] == 2.0
    predictions.write_clusters(layers.select("row", "col", "class"), str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 2
    two = spark.createDataFrame([([0.3, 0.7], [1.0, 2.0, 4.0])], "p array<double>, s array<double>")
    row = two.select(predictions.probability(F.col("p"), "generic").alias("a"), predictions.probability(F.col("s"), "generic", decision=True).alias("b")).first()
    assert row["a"] == 0.7 and row["b"] == pytest.approx(math.e**2 / (1 + math.e**-1 + math.e**2), rel=1e-9)


def test_shuffled_keeps_the_values(spark):
    df = spark.createDataFrame([(k, float(k * k), -k) for k in range(200)], "id long, v double, w int")
    got = validation.shuffled(df, "v", "id", 3).collect()
    assert sorted(r["v"] for r in got) == [float(k * k) for k in range(200)] and all(r["w"] == -r["id"] for r in got)
    assert sum(r["v"] == r["id"] ** 2 for r in got) < 20


def test_tiles_meet(spark):
    df = spark.createDataFrame([(r, c, float((r * 7 + c * 13) % 11)) for r in range(9) for c in range(7) if (r, c) != (4, 4)], "row int, col int, v double")
    whole = {(x["row"], x["col"]): x for x in texture.statistical_texture(df, "v", 9, 7, 3).collect()}
    kernel = texture.statistics_kernel(3)
    for tile in (2, 3, 100):
        parts = focal.tiled(df, "v", 1, 9, 7, kernel, texture.STATISTICS, edge="symmetric", tile=tile).collect()
        assert len(parts) == 62 and all(tuple(p) == tuple(whole[p["row"], p["col"]]) for p in parts)


def test_constant_windows(spark):
    df = spark.createDataFrame([(r, c, 5.0) for r in range(3) for c in range(3)], "row int, col int, v double")
    for r in texture.statistical_texture(df, "v", 3, 3, 9).collect():
        assert (r["mean"], r["std"], r["skewness"], r["kurtosis"], r["entropy"]) == (5.0, 0.0, 0.0, 0.0, 0.0)


def test_ellipses():
    assert len(focal.ellipse(1)) == 1 and len(focal.ellipse(3)) == 5 and len(focal.ellipse(5)) == 17
    assert [sum(r == k for r, _ in focal.ellipse(5)) for k in range(-2, 3)] == [1, 5, 5, 5, 1]


def test_ground(spark):
    one = spark.range(1)
    area = one.select(geo.box_area_km2(F.lit(85.3), F.lit(27.6), F.lit(85.4), F.lit(27.7)).alias("a"), haversine_km(F.lit(27.6), F.lit(85.3), F.lit(27.7), F.lit(85.3)).alias("h"), geo.snapped(F.lit(7.3), 2.0).alias("s"), geo.snapped(F.lit(7.3), 2.0, up=True).alias("u"), geo.utm_epsg(F.lit(85.3), F.lit(-3.0)).alias("e")).first()
    assert area["a"] == pytest.approx(109.55, abs=0.1) and area["h"] == pytest.approx(11.12, abs=0.01) and (area["s"], area["u"], area["e"]) == (6.0, 8.0, 32745)


def test_missing_data_policies(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, 2.0), (None, 4.0)], "a double, b double")
    values = lambda policy: [tuple(r) for r in features.fill_missing(df, ["a", "b"], policy, 9.0).collect()]
    assert values("constant") == [(1.0, 9.0), (3.0, 2.0), (9.0, 4.0)] and values("mean") == values("median") == [(1.0, 3.0), (3.0, 2.0), (2.0, 4.0)]
    assert values("invalidate") == [(None, None), (3.0, 2.0), (None, None)]


def plain_regions(cells):
    """By a walk from each cell in turn, the smallest first."""
    zone, found = {(r, c): z for r, c, z in cells}, {}
    for start in sorted(zone):
        todo = [start] if start not in found else []
        while todo:
            at = todo.pop()
            if at in found:
                continue
            found[at] = start
            r, c = at
            todo += [n for n in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)) if zone[at] is not None and zone.get(n) == zone[at]]
    return found


@pytest.mark.parametrize("side", [3, 128])
def test_winding_regions_end(spark, monkeypatch, side):
    # Before, each round made the plan's estimated sizes twice as long, until the driver's memory was full.
    monkeypatch.setattr(predictions, "SIDE", side)
    r = random.Random(5)
    snake = [(a, b, "wall" if a % 4 in (1, 3) and b != (19 if a % 4 == 1 else 0) else "path") for a in range(20) for b in range(20)]
    spots = [(a, b, r.choice(["x", "x", "y", None])) for a in range(20, 40) for b in range(20) if r.random() < 0.9]
    got = predictions.regions(spark.createDataFrame(snake + spots, "row int, col int, zone string"), "zone", 20).collect()
    assert {(x["row"], x["col"]): divmod(x["region"], 20) for x in got} == plain_regions(snake + spots) and len(got) == len(snake + spots)


def test_flow_keeps_the_plans_small(spark):
    df = spark.createDataFrame([(0, c, float(300 - c)) for c in range(300)] + [(k, c, 1000.0) for k in (-1, 1) for c in range(300)], "row int, col int, elevation double")
    out = hydrology.flow_accumulation(df)
    assert out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1 << 40
    assert out.filter("row = 0").agg({"cells": "max"}).first()[0] > 250
