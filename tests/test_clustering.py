"""Clustering, components and silhouettes against plain versions."""

import math

import numpy as np
import pytest

from gridloom.operators import clustering, validation


def blobs(n=240, k=4, seed=1, dims=3):
    r = np.random.default_rng(seed)
    heads = r.uniform(-50, 50, (k, dims))
    at = r.integers(0, k, n)
    return heads[at] + r.normal(size=(n, dims)), at


def frame(spark, x, at):
    rows = [(k, int(c), *map(float, v)) for k, (c, v) in enumerate(zip(at, x))]
    rows += [(900, 1, None, 1.0, 1.0), (901, 1, math.nan, 1.0, 1.0), (902, None, 1.0, 2.0, 3.0)]
    return spark.createDataFrame(rows, "id long, own int, a double, b double, c double")


def test_starts_share_their_passes(spark, monkeypatch):
    x, at = blobs()
    df = frame(spark, x, at).filter("id < 900")
    rows = clustering.components(df, ["a", "b", "c"], None, scale=False).of(df).select("v")
    calls = []
    plain = clustering.lloyd_sums
    monkeypatch.setattr(clustering, "lloyd_sums", lambda rows, centres: calls.append(len(centres)) or plain(rows, centres))
    centres, inertia, passes = clustering.best_centres(rows, 4, starts=6)
    assert calls[0] == 6 and len(calls) == passes + 1 < 40
    z = x - x.mean(0)
    found = clustering.squared(z, centres).argmin(1)
    assert len({(a, b) for a, b in zip(found.tolist(), at.tolist())}) == 4  # the blobs themselves
    assert inertia == pytest.approx(clustering.squared(z, centres).min(1).sum(), rel=1e-9)


def test_kmeans_over_components(spark):
    x, at = blobs(seed=2)
    got = {r["id"]: r["cluster"] for r in clustering.kmeans(frame(spark, x, at), ["a", "b", "c"], 4, starts=4).collect()}
    assert len(got) == 241 and 900 not in got and 902 in got
    assert len({(got[k], int(c)) for k, c in enumerate(at)}) == 4
    few = clustering.kmeans(frame(spark, x[:2], at[:2]).filter("id < 900"), ["a", "b"], 5, starts=2)
    assert len({r["cluster"] for r in few.collect()}) == 2


def test_components_are_eigenvectors(spark):
    x, at = blobs(seed=3)
    x[:, 2] = x[:, 0] * 2 + 0.01 * x[:, 1]
    df = frame(spark, x, at).filter("id < 900")
    made = clustering.components(df, ["a", "b", "c"], 0.95)
    z = (x - x.mean(0)) / x.std(0)
    values = np.linalg.eigvalsh(z.T @ z / len(z))[::-1]
    assert np.allclose(made.explained, values / 3, atol=1e-9) and len(made.loadings) == 2
    scores = np.array([r["v"] for r in made.of(df).orderBy("id").collect()])
    assert np.allclose(scores, z @ made.loadings.T) and np.allclose(scores.var(0), values[:2])
    flat = clustering.components(df.selectExpr("id", "1.0D AS a", "b", "c"), ["a", "b"], 0.95)
    assert np.isfinite(flat.loadings).all() and np.isfinite(flat.mean).all()


def plain_silhouette(x, at):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = []
    for i, c in enumerate(at):
        mine = (at == c).sum() - 1
        others = [d[i, at == o].mean() for o in set(at.tolist()) if o != c]
        if not mine or not others:
            out.append(0.0)
            continue
        a, b = d[i, at == c].sum() / mine, min(others)
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.array(out)


@pytest.mark.parametrize("block", [4096, 37])
def test_silhouettes_are_whole(spark, monkeypatch, block):
    monkeypatch.setattr(clustering, "BLOCK", block)
    monkeypatch.setattr(clustering, "PAIRS", 500)
    x, at = blobs(200, 5, seed=4)
    at[0] = 77  # alone in its cluster
    x[5:9] = x[5]
    got = clustering.silhouettes(frame(spark, x, at), "own", ["a", "b", "c"]).collect()
    want = sorted(zip(at.tolist(), plain_silhouette(x, at).round(9)))
    assert np.allclose(sorted((r["cluster"], round(r["silhouette"], 9)) for r in got), want, atol=1e-8)
    per = {r["cluster"]: (r["n"], r["silhouette"]) for r in clustering.silhouette_by_cluster(frame(spark, x, at), "own", ["a", "b", "c"]).collect()}
    assert per[77] == (1, 0.0) and sum(n for n, _ in per.values()) == 200


def test_silhouettes_of_little(spark):
    x, at = blobs(9, 1, seed=5)
    df = frame(spark, x, at).filter("id < 900")
    assert {r["silhouette"] for r in clustering.silhouettes(df, "own", ["a", "b", "c"]).collect()} == {0.0}
    assert clustering.silhouettes(df.limit(0), "own", ["a", "b", "c"]).count() == 0


def test_scores_need_no_shuffle_of_rows(spark):
    x, at = blobs(60, 3, seed=6)
    df = frame(spark, x, at).filter("id < 900")
    one = validation.cluster_scores(df, "own", ["a", "b", "c"]).first()
    centres = np.stack([x[at == c].mean(0) for c in range(3)])
    assert one["inertia"] == pytest.approx(((x - centres[at]) ** 2).sum())


def test_equal_rows_meet_once(spark):
    # Before, half a million rows were a hundred thousand million pairs, however few their places.
    places = spark.range(500_000).selectExpr("cast(id % 7 as double) AS a", "cast(id % 11 as double) AS b", "cast(id % 3 as int) AS own")
    got = {r["cluster"]: (r["n"], r["silhouette"]) for r in clustering.silhouette_by_cluster(places, "own", ["a", "b"]).collect()}
    k = np.arange(500_000)
    cells, n = np.unique((k % 7) * 100 + (k % 11) * 3 + k % 3, return_counts=True)
    x = np.c_[cells // 100, cells % 100 // 3, cells % 100 % 3].astype(float)
    d = np.sqrt(((x[:, None, :2] - x[None, :, :2]) ** 2).sum(2))
    sums = np.stack([(d * n * (x[:, 2] == c)).sum(1) for c in range(3)], 1)
    sizes = np.array([n[x[:, 2] == c].sum() for c in range(3)])
    for c in range(3):
        mine = x[:, 2] == c
        a, b = sums[mine, c] / (sizes[c] - 1), np.delete(sums / sizes, c, 1)[mine].min(1)
        assert got[c] == (sizes[c], pytest.approx(np.average((b - a) / np.maximum(a, b), weights=n[mine])))
