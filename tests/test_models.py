"""Models, folds and samples on a small separable table."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import models, spectral, validation


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(4)
    data = []
    for k in range(240):
        y = int(k % 3 == 0)
        data.append((k, r.gauss(2 * y, 0.6), r.gauss(0, 1), y))
    return spark.createDataFrame(data, "id long, a double, b double, y int").cache()


def test_folds_are_stratified(rows):
    got = models.stratified_folds(rows, "y", "id", 5).collect()
    assert len(got) == 240
    for y, n in ((0, 160), (1, 80)):
        sizes = [sum(r["y"] == y and r["fold"] == k for r in got) for k in range(5)]
        assert sizes == [n // 5] * 5
    again = {r["id"]: r["fold"] for r in models.stratified_folds(rows.repartition(7), "y", "id", 5).collect()}
    assert again == {r["id"]: r["fold"] for r in got}


def test_scores_and_curves(rows):
    cv = models.cross_validate(rows, ["a", "b"], "y", "id", 3).collect()
    assert [r["fold"] for r in cv] == [0, 1, 2] and all(r["test"] > 0.85 and r["gap"] == pytest.approx(r["train"] - r["test"]) for r in cv)
    curve = models.learning_curve(rows, ["a", "b"], "y", "id", [0.3, 1.0], 2).collect()
    assert curve[1]["test"] > 0.85 and curve[1]["test"] == pytest.approx(models.cross_validate(rows, ["a", "b"], "y", "id", 2).agg(F.avg("test")).first()[0])
    strong = models.validation_curve(rows, ["a", "b"], "y", "id", [1e-4, 10.0], 2).collect()
    assert strong[1]["test"] >= strong[0]["test"]
    one = models.permutation_refits(rows, ["a", "b"], "y", "id", permutations=3, folds=2).first()
    assert one["score"] > 0.85 and one["p_value"] == 0.25
    for bad in ({"trees": 0}, {"train_share": 0.0}, {"train_share": 1.5}):
        with pytest.raises(ValueError):
            models.checked_parameters(**bad)


def test_bootstrap_samples_agree_between_runs(rows):
    times = lambda df: {r["id"]: r["__times"] for r in models.resampled(df, "id", 3).collect()}
    first = times(rows)
    assert first == times(rows.repartition(5)) and 0.8 < sum(first.values()) / 240 < 1.2
    assert {r["__times"] for r in models.resampled(rows, "id", 4).collect()} >= {0.0, 1.0, 2.0}


def test_ensembles(rows):
    for found in (models.ensemble(rows, ["a", "b"], "y", "id", 3, 4, 3), models.bootstrap(rows, ["a", "b"], "y", "id", 3)):
        got = found.collect()
        assert len(got) == 240 and all(r["lower"] <= r["mean"] <= r["upper"] and r["variance"] == pytest.approx(r["std"] ** 2) for r in got)
        assert np.mean([(r["mean"] >= 0.5) == r["y"] for r in got]) > 0.85


def test_forests(rows):
    got = models.random_forest(rows, ["a", "b"], "y", 5, 4).collect()
    assert np.mean([r["predicted"] == r["y"] for r in got]) > 0.9
    fitted = models.random_forest_regression(rows.withColumn("t", F.col("a") * 2), ["a", "b"], "t", 8, 6).agg(F.corr("t", "predicted")).first()[0]
    assert fitted > 0.9
    with pytest.raises(Exception, match="gone"):
        models.random_forest(rows, ["gone"], "y")


def test_logistic_penalties(rows):
    size = {p: sum(abs(r["coefficient"]) for r in models.logistic_table(rows, ["a", "b"], "y", p, 0.05).collect()) for p in ("none", "l2", "l1", "elasticnet")}
    assert size["none"] > size["elasticnet"] and size["none"] > size["l2"] > 0 and size["none"] > size["l1"]


def test_components_hold_the_variance(rows):
    wide = rows.withColumn("c", F.col("a") * 3).withColumn("d", F.col("b") * 1e-3)
    out = models.pca(wide, ["a", "c", "d"], variance=0.95)
    assert "component_1" in out.columns and "component_2" not in out.columns
    assert "component_3" in models.pca(wide, ["a", "c", "d"], 3).columns


def test_clusters(spark):
    r = random.Random(1)
    df = spark.createDataFrame([(r.gauss(10 * (k % 3), 0.3), r.gauss(5 * (k % 3), 0.3)) for k in range(90)], "a double, b double")
    got = models.choose_k(df, ["a", "b"], range(2, 6)).collect()
    assert [x["k"] for x in got if x["chosen"]] == [3] and all(x["inertia"] > 0 for x in got)


def test_smoothing_keeps_parabolas():
    n = 9
    weights = np.array(spectral.smoothing(n))
    x = np.arange(n, dtype=float)
    assert np.allclose(weights @ (3 * x * x - x + 2), 3 * x * x - x + 2) and np.allclose(weights[4], [0, 0, *np.array([-3, 12, 17, 12, -3]) / 35, 0, 0])


def test_hull_is_the_upper_convex_one(spark):
    r = random.Random(3)
    waves = [400.0, 470.0, 610.0, 700.0, 900.0, 1000.0]
    data = [(0, k, *[r.uniform(0.2, 1) for _ in waves]) for k in range(40)] + [(0, 40, *[-1.0] * 6), (0, 41, None, *[1.0] * 5)]
    bands = [f"b{k}" for k in range(6)]
    df = spark.createDataFrame(data, "row int, col int, " + ", ".join(f"{b} double" for b in bands))
    got = {x["col"]: x for x in spectral.continuum_removed(df, bands, waves).collect()}
    weights = np.array(spectral.smoothing(6))
    assert 41 not in got and got[40]["mean"] is None
    for row in data[:40]:
        y = weights @ np.array(row[2:])
        hull = np.array([max(y[i], *[y[a] + (y[b] - y[a]) * (waves[i] - waves[a]) / (waves[b] - waves[a]) for a in range(i) for b in range(i + 1, 6)] or [y[i]]) for i in range(6)])
        ratio = y / hull
        assert got[row[1]]["depth"] == pytest.approx(1 - ratio.min()) and got[row[1]]["position"] == waves[int(ratio.argmin())] and got[row[1]]["mean"] == pytest.approx(ratio.mean())
    assert math.isfinite(got[0]["mean"])


def test_rows_are_made_once(spark, rows):
    # Before, each shuffle made its rows again from their source.
    seen = spark.sparkContext.accumulator(0)
    note = F.udf(lambda x: seen.add(1) or x, "double").asNondeterministic()
    noted = lambda: rows.withColumn("a", note("a"))
    found = validation.permutation_importance(noted(), ["a", "b"], "y", (F.col("a") > 1).cast("int"), "id", 2).collect()
    assert found[0]["importance_mean"] > 0.2 and found[1]["importance_mean"] == 0 and seen.value <= 2 * 240  # ranges are sampled
    seen.value = 0
    models.permutation_refits(noted(), ["a", "b"], "y", "id", permutations=2, folds=2)
    assert seen.value <= 2 * 240


def test_fits_share_their_passes(spark, rows):
    # Before, each of the fits counted and scored its rows in passes of its own.
    context = spark.sparkContext
    context.setJobGroup("curve", "")
    try:
        data = models.folded(rows, ["a", "b"], "y", "id", 2).cache()
        splits = [s for share in (0.3, 0.6, 1.0) for s in models.fold_splits(2, share)]
        together = models.scores_of(data, "y", splits)
        alone = [models.scores_of(data, "y", [s])[0] for s in splits]
    finally:
        context._jsc.clearJobGroup()
    assert together == [pytest.approx(x) for x in alone] and len(together) == 6
