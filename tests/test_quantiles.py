"""Exact quantiles, masks and splits against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import features, masks
from gridloom.plans import quantiles
from gridloom.plans.quantiles import exact_quantiles


@pytest.mark.parametrize(("bins", "few"), [(4096, 10_000), (4096, 0), (3, 5)])
def test_quantiles_are_numpys(spark, monkeypatch, bins, few):
    monkeypatch.setattr(quantiles, "BINS", bins)
    monkeypatch.setattr(quantiles, "FEW", few)
    g = np.random.default_rng(3)
    a = [*g.normal(size=300).tolist(), 1e300, -1e300, 5.0, 5.0, 5.0]
    b = [float(x) for x in g.integers(0, 4, size=len(a))]
    df = spark.createDataFrame([*zip(a, b), (None, float("nan"))], "a double, b double")
    wanted = {f"{c}{q}": (c, q) for c in "ab" for q in (0.0, 0.01, 0.37, 0.5, 0.95, 1.0)}
    got = exact_quantiles(df, wanted)
    for name, (c, q) in wanted.items():
        assert got[name] == pytest.approx(np.quantile(a if c == "a" else b, q), rel=1e-12)
    assert exact_quantiles(df.limit(0), {"m": ("a", 0.5)}) == {"m": None}
    assert exact_quantiles(df.limit(1), {"m": ("a", 0.5)})["m"] == a[0]


INF = float("inf")
AWKWARD = {
    "minus": [-INF, *range(10)],
    "both": [-INF, -INF, 1.0, 2.0, INF],
    "infinite": [INF, INF, -INF],
    "wide": [1e308, -1e308, 1.7e308, -1.7e308, 0.0, 3.0],
    "tiny": [5e-324, 1e-323, -5e-324, 0.0, -0.0, 1e-300],
    "tails": [10.0 ** (k % 600 - 300) * (-1) ** k for k in range(900)],
    "equal": [7.5] * 50,
    "close": [1 + k * 2.0**-52 for k in range(40)],
    "gaps": [1.0] * 40 + [1e18, 1e18 + 256],
}


def test_quantiles_end_on_every_input(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", 0)
    passes = []
    plain = quantiles.refined
    monkeypatch.setattr(quantiles, "refined", lambda data, spans: passes.append(1) or plain(data, spans))
    longest = max(map(len, AWKWARD.values()))
    rows = zip(*[[*map(float, v), *[None if k % 2 else float("nan")] * (longest - len(v))] for k, v in enumerate(AWKWARD.values())])
    df = spark.createDataFrame(list(rows), ", ".join(f"{c} double" for c in AWKWARD))
    got = exact_quantiles(df, {f"{c}:{q}": (c, q) for c in AWKWARD for q in (0.0, 0.25, 0.5, 0.9, 1.0)})
    assert 1 < len(passes) <= 7
    for c, values in AWKWARD.items():
        order = sorted(map(float, values))
        for q in (0.0, 0.25, 0.5, 0.9, 1.0):
            at = q * (len(order) - 1)
            low, high, part = order[int(at)], order[min(int(at) + 1, len(order) - 1)], at - int(at)
            want = low if low == high or not part else low * (1 - part) + high * part
            assert got[f"{c}:{q}"] == pytest.approx(want, rel=1e-12, nan_ok=True)


def grid(spark, rows):
    return spark.createDataFrame([(k, 0, *map(float, r)) for k, r in enumerate(rows)], "row int, col int, b02 double, b03 double, b04 double, b08 double, b11 double")


def test_masks_need_enough_valid_pixels(spark):
    rows = [[k + 1] * 5 for k in range(20)] + [[0, 5, 5, 5, 5]]
    df = grid(spark, rows)
    bands = ["b02", "b03", "b04", "b08"]
    none = masks.threshold_mask(df, *bands).collect()
    assert not any(r["cloud"] or r["shadow"] for r in none)
    got = masks.threshold_mask(df, *bands, cloud=0.9, least=10).collect()
    high, low = np.quantile(range(1, 21), 0.95), np.quantile(range(1, 21), 0.05)
    assert [r["cloud"] for r in got] == [k > high * 0.9 for k in range(1, 21)] + [False]
    assert [r["shadow"] for r in got] == [k < low * 1.05 for k in range(1, 21)] + [False]
    assert masks.spectral_mask(df, *bands, "b11", least=10).filter("cloud").count() > 0
    assert masks.kmeans_mask(df, bands).filter("cloud OR shadow").count() == 0


def test_dark_objects(spark):
    df = spark.createDataFrame([(float(k),) for k in range(1, 201)] + [(40000.0,)], "b double")
    dark = np.quantile(range(1, 201), 0.01)
    got = [r["b"] for r in masks.dark_object(df, ["b"]).collect()]
    assert got == [int(min(1, max(k - dark, 0) / 10000) * 10000) for k in [*range(1, 201), 40000]]
    assert [r["b"] for r in masks.dark_object(df, ["b"], least=500).collect()] == [*range(1, 201), 40000]
    assert [r["b"] for r in masks.sen2cor_like(df, ["b"]).limit(2).collect()] == [1, 2]


def test_split_takes_the_first_by_hash(spark):
    df = spark.createDataFrame([(k % 3 if k % 7 else None, str(k)) for k in range(500)], "y int, id string")
    got = features.stratified_split(df, "y", "id", 0.3).collect()
    assert len(got) == 500
    for y in (None, 0, 1, 2):
        mine = [r for r in got if r["y"] == y]
        assert sum(r["is_test"] for r in mine) == int(len(mine) * 0.3)
    order = {r["id"]: r["h"] for r in df.select("id", F.md5(F.concat_ws(":", F.lit(42), "id")).alias("h")).collect()}
    for y in (None, 0, 1, 2):
        assert max(order[r["id"]] for r in got if r["y"] == y and r["is_test"]) < min(order[r["id"]] for r in got if r["y"] == y and not r["is_test"])
