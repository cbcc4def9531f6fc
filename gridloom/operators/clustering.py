"""Clustering with many starts in one pass, components, and the full silhouette.

k-means: all starts advance together. A pass sums rows by start and cluster in each task, partial
sums meet in one aggregate, and ``starts`` x ``k`` rows come back, so passes don't grow with the
starts. Starts are drawn by k-means++ from a bounded sample by hash order; centres are held by the
driver and the tasks.

Silhouette: every row against every other, in blocks of places. Rows with the same values are one
place with a count for each cluster, as their distances are the same. A block is packed into one row, and a task
streams the packed blocks past one of them, so it holds two blocks and a row of sums for each of
its places; no row is made for a pair. The work is quadratic in the places.

Rows with a missing value take no part.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.plans.lineage import dropped, stored

#: Rows of a block of the silhouette, the fewest if there are more tasks than blocks, distances at a time, rows that starts are drawn from.
BLOCK, FEWEST, PAIRS, SAMPLE = 8192, 1024, 1 << 16, 20_000


def complete(columns: list[str]) -> Column:
    bad = [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in columns]
    out = bad[0]
    for b in bad[1:]:
        out = out | b
    return ~out


class Components(NamedTuple):
    """Means and deviations of the columns, and loadings: a row for each component."""

    columns: list[str]
    mean: np.ndarray
    scale: np.ndarray
    loadings: np.ndarray
    explained: np.ndarray

    def of(self, df: DataFrame, out: str = "v") -> DataFrame:
        """Rows with their scores as an array."""
        z = [(F.col(c).cast("double") - float(m)) / float(s) for c, m, s in zip(self.columns, self.mean, self.scale)]
        scores = [sum((zi * float(w) for zi, w in zip(z[1:], row[1:])), z[0] * float(row[0])) for row in self.loadings]
        return df.filter(complete(self.columns)).withColumn(out, F.array(*scores))


def components(df: DataFrame, columns: list[str], variance: float | None = 0.95, scale: bool = True) -> Components:
    """Principal components of standardised columns, as many as explain that share of the variance; None: the columns
    themselves. From one aggregate of sums; a component's largest loading is positive."""
    v = [F.col(c).cast("double") for c in columns]
    kept = df.filter(complete(columns))
    first = kept.agg(F.count("*").alias("n"), *[F.avg(x).alias(f"m{i}") for i, x in enumerate(v)]).first()
    mean = np.array([first[f"m{i}"] or 0.0 for i in range(len(v))])
    n = max(first["n"], 1)
    pairs = [(i, j) for i in range(len(v)) for j in range(i, len(v))]
    sums = kept.agg(*[F.sum((v[i] - float(mean[i])) * (v[j] - float(mean[j]))).alias(f"s{i}_{j}") for i, j in pairs]).first()
    cov = np.zeros((len(v), len(v)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = (sums[f"s{i}_{j}"] or 0.0) / n
    spread = np.sqrt(np.diag(cov))
    by = np.where(spread > 0, spread, 1.0) if scale else np.ones(len(v))
    if variance is None:
        return Components(columns, mean, by, np.eye(len(v)), np.ones(len(v)) / len(v))
    values, vectors = np.linalg.eigh(cov / by[:, None] / by[None])
    order = np.argsort(-values, kind="stable")
    values, vectors = np.maximum(values[order], 0), vectors[:, order].T
    at = np.array([int(np.flatnonzero(np.abs(x) >= np.abs(x).max() - 1e-9)[0]) for x in vectors])
    vectors *= np.sign(vectors[np.arange(len(v)), at])[:, None]
    explained = values / (values.sum() or 1.0)
    keep = int(np.searchsorted(np.cumsum(explained), variance - 1e-12) + 1)
    return Components(columns, mean, by, vectors[: min(keep, len(v))], explained)


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1) - 2 * (x @ centres.T), 0.0)


def plus_plus(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k rows, each drawn by its squared distance to those before."""
    chosen = [x[rng.integers(len(x))]]
    near = squared(x, np.array(chosen))[:, 0]
    while len(chosen) < k:
        total = near.sum()
        at = int(np.searchsorted(np.cumsum(near), rng.uniform() * total)) if total > 0 else int(rng.integers(len(x)))
        chosen.append(x[min(at, len(x) - 1)])
        near = np.minimum(near, squared(x, chosen[-1][None])[:, 0])
    return np.array(chosen)


def lloyd_sums(rows: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """By start: how many rows each centre is nearest to (ties to the smaller number), their sums, and the inertia."""
    starts = sorted(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {s: np.zeros((len(centres[s]), centres[s].shape[1] + 2)) for s in starts}
        for batch in batches:
            x = np.asarray(batch.column(0).flatten()).reshape(batch.num_rows, -1)
            for s in starts if len(x) else ():
                d = squared(x, centres[s])
                at = d.argmin(1)
                held = np.c_[np.ones(len(x)), ((x - centres[s][at]) ** 2).sum(1), x]
                for c in range(held.shape[1]):
                    sums[s][:, c] += np.bincount(at, held[:, c], len(centres[s]))
        keys = [(s, c) for s in starts for c in range(len(centres[s]))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([sums[s][c].tolist() for s, c in keys], pa.list_(pa.float64()))],
            ["start", "cluster", "s"],
        )

    width = next(iter(centres.values())).shape[1] + 2
    parts = rows.select("v").mapInArrow(run, "start int, cluster int, s array<double>")
    out = {s: np.zeros((len(centres[s]), width)) for s in starts}
    for r in parts.groupBy("start", "cluster").agg(F.array(*[F.sum(F.col("s")[i]) for i in range(width)]).alias("s")).collect():
        out[r["start"]][r["cluster"]] = r["s"]
    return {s: (m[:, 0], m[:, 2:], float(m[:, 1].sum())) for s, m in out.items()}


def best_centres(rows: DataFrame, k: int, starts: int = 10, rounds: int = 300, tolerance: float = 1e-4, seed: int = 42) -> tuple[np.ndarray, float, int]:
    """Centres of the least inertia over all starts, that inertia, and the passes taken; rows have an array v."""
    digest = F.xxhash64("v", F.lit(seed))
    some = rows.select("v").distinct().orderBy(digest, "v").limit(SAMPLE).collect()
    x = np.array([r["v"] for r in some], float)
    if not len(x):
        raise ValueError("no rows to cluster")
    k = min(k, len(x))
    rng = np.random.default_rng(seed)
    centres = {s: plus_plus(x, k, rng) for s in range(starts)}
    still = tolerance * x.var(0).mean()
    found: dict[int, float] = {}
    active, passes = set(centres), 0
    while active and passes < rounds:
        passes += 1
        for s, (n, sums, inertia) in lloyd_sums(rows, {s: centres[s] for s in active}).items():
            after = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres[s])
            moved = float(((after - centres[s]) ** 2).sum())
            centres[s], found[s] = after, inertia
            if moved <= still:
                active.discard(s)
    for s, (_, _, inertia) in lloyd_sums(rows, centres).items():
        found[s] = inertia
    best = min(found, key=lambda s: (found[s], s))
    return centres[best], found[best], passes


def nearest_of(v: Column, centres: np.ndarray) -> Column:
    """The number of the nearest centre; ties to the smaller."""
    far = [sum(((v[i] - float(c)) * (v[i] - float(c)) for i, c in enumerate(row)), F.lit(0.0)) for row in centres]
    return F.array_position(F.array(*far), F.array_min(F.array(*far))).cast("int") - 1


def kmeans(df: DataFrame, columns: list[str], k: int, starts: int = 10, scale: bool = True, variance: float | None = 0.95, seed: int = 42) -> DataFrame:
    """Complete rows with ``cluster``: standardised, brought to components, and clustered from many starts."""
    made = components(df, columns, variance, scale).of(df, "__v")
    rows = stored(made.select(F.col("__v").alias("v")))
    centres, _, _ = best_centres(rows, k, starts, seed=seed)
    dropped(rows)
    return made.withColumn("cluster", nearest_of(F.col("__v"), centres)).drop("__v")


def lloyd_step(df: DataFrame, columns: list[str], centres: np.ndarray) -> DataFrame:
    """(cluster, n, means of the columns, inertia) after rows went to the nearest of given centres."""
    kept = df.filter(complete(columns)).withColumn("__v", F.array(*[F.col(c).cast("double") for c in columns]))
    own = kept.withColumn("cluster", nearest_of(F.col("__v"), centres))
    held = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in centres])[F.col("cluster")]
    far = F.aggregate(F.zip_with("__v", held, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x)
    return own.groupBy("cluster").agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in columns], F.sum(far).alias("inertia"))


def packed(rows: DataFrame, blocks: int, clusters: int) -> DataFrame:
    """(block, own) where own holds a block's places and how many rows of each cluster lie there, as bytes; of rows (v, c, n)."""

    def pack(block: pa.Table) -> pa.Table:
        x = np.asarray(block.column("v").combine_chunks().flatten()).reshape(block.num_rows, -1)
        places, at = np.unique(x, axis=0, return_inverse=True)
        counts = np.zeros((len(places), clusters), "<i8")
        np.add.at(counts, (at.ravel(), block.column("c").to_numpy()), block.column("n").to_numpy())
        held = zlib.compress(places.astype("<f8").tobytes() + counts.tobytes(), 1)
        return pa.table({"block": block.column("block").slice(0, 1), "own": pa.array([held], pa.binary())})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInArrow(pack, "block int, own binary")


def unpacked(held: bytes, dims: int, clusters: int) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(held)
    n = len(raw) // (8 * (dims + clusters))
    return np.frombuffer(raw, "<f8", n * dims).reshape(n, dims), np.frombuffer(raw, "<i8", n * clusters, 8 * n * dims).reshape(n, clusters)


def distance_sums(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of each x, the distances to all y summed by the columns of their weights."""
    out = np.empty((len(x), weights.shape[1]))
    step = max(1, PAIRS // len(y))
    far, gap = np.empty((2, step, len(y)))
    for start in range(0, len(x), step):
        n = min(step, len(x) - start)
        for d in range(x.shape[1]):
            into = gap if d else far
            np.subtract(x[start : start + n, d, None], y[None, :, d], out=into[:n])
            np.multiply(into[:n], into[:n], out=into[:n])
            if d:
                np.add(far[:n], gap[:n], out=far[:n])
        np.sqrt(far[:n], out=far[:n])
        np.matmul(far[:n], weights, out=out[start : start + n])
    return out


def weighted_silhouettes(df: DataFrame, cluster: str, columns: list[str]) -> DataFrame:
    """(cluster, silhouette, n) of the rows of a cluster at a place; 0 for the only row of a cluster, and where there is one
    cluster."""
    kept = df.filter(complete(columns) & F.col(cluster).isNotNull())
    number = F.array(*[F.col(c).cast("double") for c in columns])
    rows = stored(kept.groupBy(number.alias("v"), F.col(cluster).alias("of")).agg(F.count("*").alias("n")))
    sizes = {r[0]: r[1] for r in rows.groupBy("of").agg(F.sum("n")).orderBy("of").collect()}  # a row for each cluster
    names, dims = list(sizes), len(columns)
    counts = np.array([sizes[c] for c in names], float)
    numbered = F.create_map(*[F.lit(x) for k, c in enumerate(names) for x in (c, k)])[F.col("of")] if names else F.lit(0)
    several = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = rows.count()
    blocks = max(1, math.ceil(total / BLOCK), min(several, math.ceil(total / FEWEST)))
    held = stored(packed(rows.select("v", numbered.cast("int").alias("c"), "n"), blocks, len(names)))
    dropped(rows)
    # Each block meets all blocks, its own first.
    target = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("target")
    met = held.select(target, "block", "own").withColumn("other", (F.col("target") != F.col("block")).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, sums = None, None, None

        def finished() -> pa.RecordBatch:
            k, c = np.nonzero(own[1])
            a = sums[k, c] / np.maximum(counts[c] - 1, 1)
            means = sums / counts
            every = np.arange(len(means))
            near = means.argmin(1)
            least = means[every, near]
            means[every, near] = np.inf
            b = np.where(near[k] == c, means.min(1)[k], least[k])
            most = np.maximum(a, b)
            with np.errstate(invalid="ignore", divide="ignore"):
                score = np.where((counts[c] > 1) & np.isfinite(b) & (most > 0), (b - a) / most, 0.0)
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(score), pa.array(own[1][k, c])], ["c", "silhouette", "n"])

        for batch in batches:
            for k, other, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if k != at:
                    if own is not None:
                        yield finished()
                    at, own = k, None
                    if not other:  # a block without rows has none of its own
                        own = unpacked(raw.as_py(), dims, len(counts))
                        sums = np.zeros((len(own[0]), len(counts)))
                if own is None:
                    continue
                places, weights = unpacked(raw.as_py(), dims, len(counts))
                sums += distance_sums(own[0], places, weights.astype(float))
        if own is not None:
            yield finished()

    order = met.repartition(blocks, "target").sortWithinPartitions("target", "other").select("target", "other", "own")
    found = order.mapInArrow(run, "c int, silhouette double, n long")
    labels = F.array(*[F.lit(c) for c in names]) if names else F.array(F.lit(None).cast(kept.schema[cluster].dataType))
    return found.select(labels[F.col("c")].alias("cluster"), "silhouette", "n")


def silhouettes(df: DataFrame, cluster: str, columns: list[str]) -> DataFrame:
    """(cluster, silhouette) of every complete row."""
    found = weighted_silhouettes(df, cluster, columns)
    heaps = found.withColumn("heap", F.explode(F.expr("sequence(0L, (n - 1) div 1000)")))
    each = F.explode(F.sequence(F.lit(1), F.least(F.lit(1000), F.col("n") - F.col("heap") * 1000)))
    return heaps.withColumn("each", each).select("cluster", "silhouette")


def silhouette_by_cluster(df: DataFrame, cluster: str, columns: list[str]) -> DataFrame:
    """(cluster, n, silhouette): means of a cluster's rows; their mean weighted by n is the score of all."""
    n = F.sum("n")
    return weighted_silhouettes(df, cluster, columns).groupBy("cluster").agg(n.alias("n"), (F.sum(F.col("silhouette") * F.col("n")) / n).alias("silhouette"))
