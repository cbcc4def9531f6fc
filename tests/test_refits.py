"""Fits that share their passes: each dealt column is the label's own values, and each fit is that of Spark's own regression."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.catalogue import QUERIES
from gridloom.operators import models, refits
from gridloom.operators.validation import hash_number


def noisy(spark, n, labels, seed=5):
    r = random.Random(seed)
    data = []
    for k in range(n):
        y = r.randrange(labels)
        data.append((k, r.gauss(0.4 * y, 1), 300 + 100 * r.gauss(y == 1, 2), y))
    return spark.createDataFrame(data, "id long, a double, b double, y int").cache()


def unpacked(data):
    """(columns, rows) label codes in the order of folds."""
    kind = np.min_scalar_type(data.labels - 1)
    return np.concatenate([np.frombuffer(r["y"], kind).reshape(data.columns, -1) for r in data.blocks.orderBy("block").collect()], 1)


def test_the_query_refits_a_hundred_times(spark):
    # Before, it dealt the labels three times, so that no p-value was below a quarter.
    one = QUERIES["permutation_refits"](spark, "/root/testdata/sf0.001").first()
    assert one["score"] > 0.95 and one["p_value"] == pytest.approx(1 / 101, abs=1e-6)


@pytest.mark.parametrize("labels", [2, 3])
def test_fits_are_those_of_single_regressions(spark, monkeypatch, labels):
    for name, size in (("BLOCK", 64), ("BUCKET", 100), ("WIDE", 5)):
        monkeypatch.setattr(refits, name, size)
    df = noisy(spark, 500, labels)
    y = unpacked(refits.refits(df, ["a", "b"], "y", "id", 2, 2))
    ids = [r["id"] for r in df.orderBy(hash_number(F.lit(42), F.col("id").cast("string"))).select("id").collect()]
    own = {r["id"]: r["y"] for r in df.collect()}
    assert y.shape == (3, 500) and [own[k] for k in ids] == y[0].tolist()
    assert all(sorted(x) == sorted(y[0]) for x in y) and len({x.tobytes() for x in y}) == 3
    got = refits.refit_scores(df, ["a", "b"], "y", "id", 2, 2)
    for column, score in list(zip(y, got))[:2]:
        dealt = df.drop("y").join(spark.createDataFrame(list(zip(ids, column.tolist())), "id long, y int"), "id")
        alone = models.scores_of(models.folded(dealt, ["a", "b"], "y", "id", 2), "y", models.fold_splits(2))
        assert float(score) == pytest.approx(np.mean([test for _, test in alone]), abs=0.003)  # a row or so at the border


def test_coefficients_have_no_slope_left(spark):
    df = noisy(spark, 400, 2)
    data = refits.refits(df, ["a", "b"], "y", "id", 1, 2)
    w = refits.fitted(data)
    assert w.shape == (4, 1, 3)
    sums = refits.summed(data, refits.slopes(np.arange(4), w, 2), 4, 1 + 3 + 6)
    assert np.abs(sums[:, 1:4] + data.penalty * w[:, 0]).max() < 1e-5
    folded = models.folded(df, ["a", "b"], "y", "id", 2)
    for k in range(2):
        part = folded.filter(F.col("fold") != k)
        spark_fit = models.logistic("y", part.count(), tol=1e-10, maxIter=500).fit(part)
        rows = df.agg(*[f(c) for f in (F.avg, F.stddev_pop) for c in "ab"]).first()
        mine = w[k, 0, :2] / np.array(rows[2:])
        assert mine == pytest.approx(spark_fit.coefficients.toArray(), rel=1e-3)
        assert w[k, 0, 2] - (mine * np.array(rows[:2])).sum() == pytest.approx(spark_fit.intercept, rel=1e-3)


def test_odd_tables(spark):
    def of(rows, **more):
        return models.permutation_refits(spark.createDataFrame(rows, "id long, a double, b double, y int"), ["a", "b"], "y", "id", **more).collect()

    assert of([], permutations=2) == []
    assert [tuple(r) for r in of([(k, float(k), 1.0, 7) for k in range(9)], permutations=3)] == [(1.0, 1.0)]  # one label
    few = of([(0, 0.0, 1.0, 0), (1, 5.0, 1.0, 3)], permutations=3)[0]  # fewer rows than folds, a column of one value
    assert 0 <= few["score"] <= 1 and few["p_value"] in (0.25, 0.5, 0.75, 1.0)
    gaps = of([(k, None if k % 5 == 0 else float(k % 2) + k / 1000, math.nan if k == 1 else 2.0, -(k % 2)) for k in range(200)], permutations=19)[0]
    assert gaps["score"] == 1.0 and gaps["p_value"] == 0.05
    for bad in ({"folds": 1}, {"permutations": 0}):
        with pytest.raises(ValueError):
            of([(0, 0.0, 1.0, 0), (1, 5.0, 1.0, 1)], **bad)
    with pytest.raises(ValueError, match="finite"):
        of([(0, math.inf, 1.0, 0), (1, 5.0, 1.0, 1)])


def test_passes_do_not_grow_with_permutations(spark):
    # Before, each permutation dealt, wrote and fitted by jobs of its own.
    df, jobs = noisy(spark, 300, 2), []
    for permutations in (2, 40):
        group = f"refits-{permutations}"
        spark.sparkContext.setJobGroup(group, "")
        try:
            models.permutation_refits(df, ["a", "b"], "y", "id", permutations, 3)
        finally:
            spark.sparkContext._jsc.clearJobGroup()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    assert 0 < jobs[1] <= jobs[0] + 6


def test_equal_scores_count(spark):
    found = refits.refit_scores(noisy(spark, 60, 2), ["a"], "y", "id", 10, 4)
    assert len(found) == 11 and all(isinstance(x, Fraction) and 0 <= x <= 1 for x in found)
