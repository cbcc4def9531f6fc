"""Centroid clustering (Lloyd's rounds, exactly) with Yinyang's group bounds.

Components are whole numbers, so distances, sums and means are exact. The centroids are put
into groups once, before the first round. A vector's row carries its cluster, an upper bound of
the distance to its own centroid, and for each group a lower bound of the distance to the
group's other centroids. In a round:

1. Bounds move by how far centroids moved: the upper one by the own centroid's drift, a lower
   one by the largest drift in its group.
2. Global filter: a vector whose upper bound lies below all its lower bounds keeps its cluster;
   else the upper bound is made exact and tried again.
3. Group filter: only groups whose lower bound doesn't exceed the best distance so far are open.
4. The centroids of open groups are scanned exactly, and the group's bound is set anew.

Bounds are doubles with a slack far above their rounding, and only skip what is farther for
sure; ties go to the smaller number by exact distances. Vectors stay in their partitions: a
round is one map over the rows, written as a table in the shared folder, and one aggregate with
partial sums that returns a row for each centroid. The driver and each task hold the centroids,
which ``k`` bounds, and one batch of rows.

Defined results: vectors that are null, of another length, or hold null, NaN or infinite
components take no part; equal rows are as many vectors; a row without an id is clustered but
starts no centroid; of rows with one id that could start centroids the smaller vector comes
first; with fewer vectors than ``k`` each starts a centroid; a scaled component beyond
2^53 counts as 2^53; a distance or inertia beyond 64 bits is given as the largest long; an
empty table stays empty; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import dropped, release, stored
from gridloom.llm.exact_topk import usable

#: Added to bounds, as a share of them and as a length: far more than doubles lose over all rounds.
SLACK = 1e-9
#: Centroids of a group, rounds of the grouping, rows scanned at a time, the largest component.
GROUP, GROUPING, ROWS, LARGEST = 10, 5, 4096, 1 << 53
LONG = (1 << 63) - 1


def exact_kind(largest: int, dims: int) -> type:
    """Numbers in which squared distances of such components are exact."""
    most = 4 * dims * largest * largest
    return float if most < 1 << 53 else np.int64 if most < 1 << 63 else object


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centres."""
    return (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2 * (x @ centres.T)


def own_squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to the centre beside each."""
    gap = x - centres
    return (gap * gap).sum(1)


def root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(float))


def raised(bound: np.ndarray) -> np.ndarray:
    return bound * (1 + SLACK) + SLACK


def grouped(centres: np.ndarray) -> list[np.ndarray]:
    """The numbers of the centres of each group, by a few rounds of k-means over the centres from far-apart starts."""
    points = centres.astype(float)
    heads = [0]
    while len(heads) < max(1, len(points) // GROUP):
        heads.append(int(squared(points, points[heads]).min(1).argmax()))
    middles = points[heads]
    for _ in range(GROUPING):
        at = squared(points, middles).argmin(1)
        middles = np.stack([points[at == g].mean(0) if (at == g).any() else middles[g] for g in range(len(middles))])
    found = [np.flatnonzero(at == g) for g in range(len(middles))]
    return [g for g in found if len(g)]


class Round:
    """Assigns batches of rows to the nearest of some centres."""

    def __init__(self, centres: np.ndarray, groups: list[np.ndarray], drift: np.ndarray) -> None:
        self.centres, self.groups, self.drift = centres, groups, drift
        self.group_of = np.zeros(len(centres), int)
        for g, members in enumerate(groups):
            self.group_of[members] = g
        self.group_drift = np.array([drift[m].max() for m in groups])
        #: Distances computed.
        self.scanned = 0

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Without bounds yet: every group is open."""
        upper, lower = np.full(len(x), np.inf), np.zeros((len(x), len(self.groups)))
        return self.assign(x, np.zeros(len(x), int), upper, lower)

    def assign(self, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The clusters and bounds of rows from those of the round before."""
        cluster, upper, lower = cluster.copy(), upper + self.drift[cluster], lower - self.group_drift
        live = np.flatnonzero(raised(upper) >= lower.min(1))
        own = own_squared(x[live], self.centres[cluster[live]])
        self.scanned += len(live)
        upper[live] = root(own)
        open_ = raised(upper[live]) >= lower[live].min(1)
        live, own = live[open_], own[open_]
        best, least = cluster[live], own.copy()
        leads: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for g, members in enumerate(self.groups):
            some = np.flatnonzero(raised(root(least)) >= lower[live, g])
            if not len(some):
                continue
            found = squared(x[live[some]], self.centres[members])
            self.scanned += found.size
            at = found.argmin(1)  # of equals the first, which has the smallest number
            near, number = found[np.arange(len(some)), at], members[at]
            rest = root(found)
            rest[np.arange(len(some)), at] = np.inf
            leads.append((g, some, root(near), rest.min(1), number))
            better = (near < least[some]) | ((near == least[some]) & (number < best[some]))
            least[some[better]], best[some[better]] = near[better], number[better]
        # A cluster that is left counts for its group's bound; an open group's own bound, set below, includes it.
        left = np.flatnonzero(best != cluster[live])
        at = (live[left], self.group_of[cluster[live[left]]])
        lower[at] = np.minimum(lower[at], root(own[left]))
        for g, some, near, second, number in leads:
            lower[live[some], g] = np.where(number == best[some], second, near)
        cluster[live], upper[live] = best, root(least)
        return cluster, upper, lower


def assigned(state: DataFrame, make: Callable[[], Round], kind: type, dims: int, began: bool, ends: bool) -> DataFrame:
    """The rows of ``state`` after one round; the exact distance only when the rounds end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                x = np.asarray(batch.column("v").flatten()).reshape(-1, dims).astype(kind)
                if began:
                    bounds = np.asarray(batch.column("lower").flatten()).reshape(len(x), -1)
                    cluster, upper, lower = step.assign(x, np.asarray(batch.column("cluster")).astype(int), np.asarray(batch.column("upper")), bounds)
                else:
                    cluster, upper, lower = step.first(x)
                columns = {"id": batch.column("id"), "v": batch.column("v"), "cluster": pa.array(cluster, pa.int32())}
                if ends:
                    far = own_squared(x, step.centres[cluster])
                    columns = {"id": batch.column("id"), "cluster": columns["cluster"], "distance": pa.array([min(int(d), LONG) for d in far], pa.int64())}
                else:
                    offsets = pa.array(np.arange(len(x) + 1) * lower.shape[1], pa.int32())
                    columns |= {"upper": pa.array(upper), "lower": pa.ListArray.from_arrays(offsets, pa.array(lower.ravel()))}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
        release()

    made = "id long, cluster int, distance long" if ends else "id long, v array<long>, cluster int, upper double, lower array<double>"
    return state.mapInArrow(run, made)


def yinyang(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: float = 256.0, seed: str = "2:", id_col: str = "vec_id", vec_col: str = "embedding"
) -> tuple[DataFrame, DataFrame]:
    """Rows (id, cluster, distance) of the kept vectors, and a row for each centroid: cluster, size, inertia, centroid.

    Centroids start as the ``k`` vectors with the smallest SHA-256 of ``seed`` and the id, in that order.
    """
    spark, named = vectors.sparkSession, vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("raw"))
    whole = lambda x: F.least(F.greatest(F.floor(x.cast("double") * F.lit(scale)), F.lit(-LARGEST)), F.lit(LARGEST))
    kept = named.filter(usable(F.col("raw")) & (F.size("raw") == dims)).select("id", F.transform("raw", whole).alias("v"))
    state = stored(kept)
    starts = (
        state.filter(F.col("id").isNotNull()).withColumn("h", F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256))
        .orderBy("h", "v").limit(k).collect()
    )
    centres = [list(r["v"]) for r in starts]
    sizes = state.agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("v", F.abs))).alias("largest")).first()
    if not centres:
        nothing = spark.createDataFrame([], "cluster int, size long, inertia long, centroid array<long>")
        return state.limit(0).select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), nothing
    kind = exact_kind(sizes["largest"], dims)
    exact_sum = (lambda c: F.sum(c)) if sizes["largest"] * sizes["n"] < 1 << 62 else (lambda c: F.sum(c.cast("decimal(38,0)")))
    groups = grouped(np.array(centres, float))
    drift = np.zeros(len(centres))
    for r in range(rounds + 1):
        now, moved = np.array(centres, kind), drift
        after = stored(assigned(state, lambda now=now, moved=moved: Round(now, groups, moved), kind, dims, r > 0, r == rounds))
        dropped(state)
        state = after
        if r < rounds:
            sums = state.groupBy("cluster").agg(F.count("*").alias("n"), *[exact_sum(F.col("v")[i]).alias(f"s{i}") for i in range(dims)])
            before, centres = centres, list(centres)
            for row in sums.collect():
                centres[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dims)]
            drift = np.array([raised(float(sum((a - b) ** 2 for a, b in zip(old, new))) ** 0.5) for old, new in zip(before, centres)])
    totals = {r["cluster"]: r for r in state.groupBy("cluster").agg(F.count("*").alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(c, totals[c]["n"] if c in totals else 0, min(int(totals[c]["s"]), LONG) if c in totals else 0, v) for c, v in enumerate(centres)]
    return state, spark.createDataFrame(rows, "cluster int, size long, inertia long, centroid array<long>")


def cluster_digest(found: tuple[DataFrame, DataFrame], id_col: str = "vec_id") -> DataFrame:
    """Per vector: its cluster, distance, the inertia of the cluster and of all, and a digest of the centroid."""
    rows, centroids = found
    described = centroids.collect()  # k rows
    inertia = min(sum(r["inertia"] for r in described), LONG)
    digests = [(r["cluster"], r["inertia"], inertia, hashlib.sha256(",".join(map(str, r["centroid"])).encode()).hexdigest()) for r in described]
    beside = rows.sparkSession.createDataFrame(digests, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(beside), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
