"""Surfaces through scattered points: nearest neighbours, kriging, thin plates, triangulation.

All rest on ``neighbours``, an exact k-nearest join. Points are dealt to square tiles with a halo,
nodes to their own tile; what a node found is complete if the k-th distance does not reach
beyond the halo, and only nodes without that proof go on to larger tiles. A tile is bounded by
the points' density; one with too many points is dealt over parts, whose k nearest are merged.

- Kriging: the mean of a Gaussian process given a node's k nearest points, one small Cholesky
  factor a node. With k of all points or more it is the dense solution.
- Radial functions: overlapping patches around the nodes of a lattice, each a system over its k nearest
  points with a polynomial part, blended by weights that sum to one. A patch that does not reach
  over its part of the lattice would miss points there: its nodes go to a lattice half as wide.
- Triangulation: a node's Delaunay triangle is the optimal basis of a linear programme over points
  lifted to a paraboloid. It is right if its circumcircle lies within the known radius; else more
  neighbours are asked for. Nodes outside the points' convex hull have no value.

Defined results: points with a null, NaN or infinite part are left out; points of one place are
one, with their mean; without points kriging and radial functions give NULL as the others do.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.plans.lineage import dropped, stored

#: Points of a tile on average, halo as a share of its side, points of a tile before it is dealt over parts.
TILE_POINTS, HALO, CROWDED = 4096, 0.25, 65_536
#: Distances at a time.
PAIRS = 1 << 21
#: Hull points that the driver holds at most.
HULL = 1_000_000

NEAR = "array<struct<d:double,x:double,y:double,v:double>>"


def places(points: DataFrame, value: str) -> DataFrame:
    """Distinct places (x, y) with their mean value v."""
    usable = [~(F.isnan(c) | (F.abs(c) == F.lit(float("inf")))) for c in (F.col("x").cast("double"), F.col("y").cast("double"), F.col(value).cast("double"))]
    kept = points.filter(usable[0] & usable[1] & usable[2])
    return kept.groupBy(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).agg(F.avg(F.col(value).cast("double")).alias("v"))


def k_nearest(gx: np.ndarray, gy: np.ndarray, points: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each node the squared distances and positions of its k nearest points; ties go to the smaller x, then y."""
    order = np.lexsort((points[:, 1], points[:, 0]))
    points, out = points[order], []
    step = max(1, PAIRS // max(len(points), 1))
    for start in range(0, len(gx), step):
        dx, dy = points[None, :, 0] - gx[start : start + step, None], points[None, :, 1] - gy[start : start + step, None]
        d2 = dx * dx + dy * dy
        if len(points) > k:
            bar = np.partition(d2, k - 1, axis=1)[:, k - 1]
        else:
            bar = np.full(len(d2), np.inf)
        for row, most in zip(d2, bar):
            some = np.flatnonzero(row <= most)
            some = some[np.argsort(row[some], kind="stable")][:k]
            out.append((row[some], order[some]))
    return out


def near_array(found: list[tuple[np.ndarray, np.ndarray]], points: np.ndarray) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum([len(i) for _, i in found])].astype(np.int32)
    at = np.concatenate([i for _, i in found]) if found else np.zeros(0, int)
    d = np.sqrt(np.concatenate([d for d, _ in found])) if found else np.zeros(0)
    fields = [pa.array(d, pa.float64()), *(pa.array(points[at, c], pa.float64()) for c in range(3))]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["d", "x", "y", "v"]))


def one_round(nodes: DataFrame, held: DataFrame, k: int, side: float, x0: float, y0: float) -> DataFrame:
    """Nodes with their k nearest points among those of their tile and its halo."""
    halo = side * HALO
    tile = lambda c, lo, by=0.0: F.floor((F.col(c) - lo + by) / side).cast("long")
    own = nodes.withColumns({"tx": tile("gx", x0), "ty": tile("gy", y0)})
    dealt = (
        held.withColumn("tx", F.explode(F.sequence(tile("x", x0, -halo), tile("x", x0, halo))))
        .withColumn("ty", F.explode(F.sequence(tile("y", y0, -halo), tile("y", y0, halo))))
        .join(own.select("tx", "ty").distinct(), ["tx", "ty"], "left_semi")
    )
    # Crowded tiles are no more than 4 n / CROWDED.
    crowded = dealt.groupBy("tx", "ty").agg(F.count("*").alias("n")).filter(F.col("n") > CROWDED)
    crowded = stored(crowded.select("tx", "ty", F.ceil(F.col("n") / CROWDED).cast("int").alias("parts")))
    split = not crowded.isEmpty()
    if split:
        dealt = dealt.join(F.broadcast(crowded), ["tx", "ty"], "left").withColumn("part", F.pmod(F.xxhash64("x", "y"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
        own = own.join(F.broadcast(crowded), ["tx", "ty"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    else:
        dealt, own = dealt.withColumn("part", F.lit(0)), own.withColumn("part", F.lit(0))

    def search(asked: pa.Table, given: pa.Table) -> pa.Table:
        points = np.column_stack([given.column(c).to_numpy() for c in ("x", "y", "v")])
        found = k_nearest(asked.column("gx").to_numpy(), asked.column("gy").to_numpy(), points, k)
        return pa.table({**{c: asked.column(c) for c in ("i", "j", "gx", "gy", "tx", "ty")}, "near": near_array(found, points)})

    keys = ["tx", "ty", "part"]
    found = own.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(search, f"i long, j long, gx double, gy double, tx long, ty long, near {NEAR}")
    if split:
        found = found.groupBy("i", "j", "gx", "gy", "tx", "ty").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
    return found


def neighbours(nodes: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """Nodes (i, j, gx, gy) with ``near``, their k nearest of distinct places (x, y, v) in order, and ``known``, the radius
    within which no other place lies: the last one's distance, or infinite when all places are near."""
    nodes = nodes.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), F.col("gx").cast("double").alias("gx"), F.col("gy").cast("double").alias("gy"))
    b = points.agg(F.count("*").alias("n"), *[f(c).alias(f"{c}{e}") for c in "xy" for e, f in ((0, F.min), (1, F.max))]).first()
    if not b["n"]:
        return nodes.withColumns({"near": F.array().cast(NEAR), "known": F.lit(float("inf"))})
    wide, high = b["x1"] - b["x0"], b["y1"] - b["y0"]
    share = min(1.0, TILE_POINTS / b["n"])
    side = max(math.sqrt(wide * high * share), max(wide, high) * share)
    if share == 1.0 or side == 0:  # few points: one tile's halo reaches over all of them from every node
        at = nodes.agg(*[f(c).alias(f"{c[1]}{e}") for c in ("gx", "gy") for e, f in ((0, F.min), (1, F.max))]).first()
        ends = [[v for v in (b[f"{c}0"], b[f"{c}1"], at[f"{c}0"], at[f"{c}1"]) if v is not None] for c in "xy"]
        side = 8 * max(*(max(e) - min(e) for e in ends), 1e-9 * max(1.0, *map(abs, ends[0] + ends[1])))
    open_, done = nodes, []
    while True:
        found = one_round(open_, points, k, side, b["x0"], b["y0"])
        halo = side * HALO
        # How far the tile with its halo reaches; nothing lies beyond the points' own bounds.
        left, right = F.col("gx") - (b["x0"] + F.col("tx") * side - halo), b["x0"] + (F.col("tx") + 1) * side + halo - F.col("gx")
        down, up = F.col("gy") - (b["y0"] + F.col("ty") * side - halo), b["y0"] + (F.col("ty") + 1) * side + halo - F.col("gy")
        free = lambda reach, ends: F.when(ends, F.lit(float("inf"))).otherwise(reach)
        reach = F.least(
            free(left, F.col("gx") - left <= b["x0"]), free(right, F.col("gx") + right > b["x1"]), free(down, F.col("gy") - down <= b["y0"]), free(up, F.col("gy") + up > b["y1"])
        )
        last = F.when(F.size("near") >= k, F.element_at("near", -1)["d"])
        proven = stored(found.withColumn("known", F.coalesce(last, F.lit(float("inf")))).withColumn("proven", F.col("known") <= reach).drop("tx", "ty"))
        done.append(proven.filter("proven").drop("proven"))
        if proven.filter(~F.col("proven")).isEmpty():
            break
        open_ = proven.filter(~F.col("proven")).select("i", "j", "gx", "gy")
        side *= 4
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


Solver = Callable[[np.ndarray, np.ndarray, list[np.ndarray]], dict[str, list]]


def each_batch(asked: DataFrame, made: dict[str, pa.DataType], schema: str, solve: Solver) -> DataFrame:
    """(i, j) with columns made from each batch's nodes (gx, gy) and the arrays (d, x, y, v) of their neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = batch.column("near")
            offsets = near.offsets.to_numpy()
            flat = np.column_stack([near.values.field(c).to_numpy(zero_copy_only=False) for c in range(4)])
            lists = [flat[a:b] for a, b in zip(offsets, offsets[1:])]
            columns = solve(batch.column("gx").to_numpy(), batch.column("gy").to_numpy(), lists)
            arrays = [batch.column("i"), batch.column("j"), *(pa.array(columns[c], t) for c, t in made.items())]
            yield pa.RecordBatch.from_arrays(arrays, ["i", "j", *made])

    return asked.select("i", "j", "gx", "gy", "near").mapInArrow(run, f"i long, j long, {schema}")


def alike(lists: list[np.ndarray]) -> dict[int, np.ndarray]:
    """Positions of lists by their length."""
    sizes = np.array([len(x) for x in lists])
    return {int(n): np.flatnonzero(sizes == n) for n in np.unique(sizes)}


def kriging(nodes: DataFrame, points: DataFrame, value: str, k: int = 32, length: float = 1000.0, noise: float = 0.01, alpha: float = 1e-6) -> DataFrame:
    """(i, j, value, variance) of a zero-mean Gaussian process with a squared-exponential kernel and white noise."""

    def solve(gx: np.ndarray, gy: np.ndarray, lists: list[np.ndarray]) -> dict[str, list]:
        mean, variance = [None] * len(lists), [None] * len(lists)
        for n, some in alike(lists).items():
            for part in np.array_split(some, -(-len(some) * n * n * 8 // (1 << 26)) or 1) if n else ():
                x = np.stack([lists[s] for s in part])
                apart = (x[:, :, None, 1] - x[:, None, :, 1]) ** 2 + (x[:, :, None, 2] - x[:, None, :, 2]) ** 2
                system = np.exp(-0.5 * apart / length**2) + (noise + alpha) * np.eye(n)
                beside = np.exp(-0.5 * x[:, :, 0] ** 2 / length**2)
                factor = np.linalg.cholesky(system)
                both = np.linalg.solve(factor, np.stack([x[:, :, 3], beside], -1))
                for at, m, s in zip(part, (both[:, :, 0] * both[:, :, 1]).sum(1), 1 + noise - (both[:, :, 1] ** 2).sum(1)):
                    mean[at], variance[at] = float(m), float(max(s, 0.0))
        return {"value": mean, "variance": variance}

    held = stored(places(points, value))
    kinds = {"value": pa.float64(), "variance": pa.float64()}
    return each_batch(neighbours(nodes, held, k), kinds, "value double, variance double", solve)


# Radial functions of a distance, and the degree of the polynomial beside them.
RADIAL: dict[str, tuple[Callable[[np.ndarray], np.ndarray], int]] = {
    "thin_plate_spline": (lambda r: r * r * np.log(np.where(r > 0, r, 1.0)), 1),
    "cubic": (lambda r: r**3, 1),
    "linear": (lambda r: -r, 0),
}


def monomials(x: np.ndarray, y: np.ndarray, degree: int) -> np.ndarray:
    return np.stack([np.ones_like(x), x, y][: 1 + 2 * degree], -1)


def patch(points: np.ndarray, cx: float, cy: float, scale: float, kernel: str, smoothing: float) -> np.ndarray:
    """Weights of the points, then of the polynomial, in coordinates around the centre."""
    phi, degree = RADIAL[kernel]
    x, y = (points[:, 1] - cx) / scale, (points[:, 2] - cy) / scale
    poly = monomials(x, y, degree)
    n, m = poly.shape
    system = np.zeros((n + m, n + m))
    # Lengths are divided by the scale, which divides the kernel by its square (or the power that it has).
    power = {"thin_plate_spline": 2, "cubic": 3, "linear": 1}[kernel]
    system[:n, :n] = phi(np.hypot(x[:, None] - x, y[:, None] - y)) + smoothing / scale**power * np.eye(n)
    system[:n, n:], system[n:, :n] = poly, poly.T
    right = np.r_[points[:, 3], np.zeros(m)]
    if n >= m and np.linalg.matrix_rank(poly) == m:
        return np.linalg.solve(system, right)
    # Too few points, or all on one line: of all solutions the flattest around the points' middle.
    mx, my = (x.mean(), y.mean()) if degree else (0.0, 0.0)
    system[:n, n:] = monomials(x - mx, y - my, degree)
    system[n:, :n] = system[:n, n:].T
    found = np.linalg.lstsq(system, right, rcond=None)[0]
    if degree:
        found[n] -= found[n + 1] * mx + found[n + 2] * my
    return found


def radial(nodes: DataFrame, points: DataFrame, value: str, kernel: str = "thin_plate_spline", smoothing: float = 0.0, k: int = 64) -> DataFrame:
    """(i, j, value) of a radial-basis interpolant with its polynomial, by blended patches of k points."""
    phi, degree = RADIAL[kernel]
    held = stored(places(points, value))
    b = held.agg(F.count("*").alias("n"), *[f(c).alias(f"{c}{e}") for c in "xy" for e, f in ((0, F.min), (1, F.max))]).first()
    open_ = nodes.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), F.col("gx").cast("double").alias("gx"), F.col("gy").cast("double").alias("gy"))
    if not b["n"]:
        return open_.select("i", "j", F.lit(None).cast("double").alias("value"))
    wide, high = b["x1"] - b["x0"], b["y1"] - b["y0"]
    # A circle around a patch's part of the lattice holds three quarters of k points on average.
    step = max(math.sqrt(wide * high / b["n"] * k / 8), max(wide, high) / b["n"] * k / 8) or 1.0
    done = []
    while True:
        at = lambda c, lo: F.floor((F.col(c) - lo) / step).cast("long")  # noqa: B023,E731
        around = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(c).alias("c")) for a in (0, 1) for c in (0, 1)]))
        corners = open_.withColumn("o", around).select("*", (at("gx", b["x0"]) + F.col("o.a")).alias("ci"), (at("gy", b["y0"]) + F.col("o.c")).alias("cj")).drop("o")
        centres = corners.select(F.col("ci").alias("i"), F.col("cj").alias("j")).distinct()
        centres = centres.withColumns({"gx": b["x0"] + F.col("i") * step, "gy": b["y0"] + F.col("j") * step})

        def solve(gx: np.ndarray, gy: np.ndarray, lists: list[np.ndarray], step: float = step) -> dict[str, list]:
            whole = b["n"] <= k
            return {
                "px": [p[:, 1] for p in lists], "py": [p[:, 2] for p in lists],
                "w": [patch(p, cx, cy, step, kernel, smoothing) for p, cx, cy in zip(lists, gx, gy)],
                "reaches": [whole or p[-1, 0] >= math.sqrt(2) * step for p in lists],
            }

        numbers = pa.list_(pa.float64())
        solved = each_batch(
            neighbours(centres, held, k), {"px": numbers, "py": numbers, "w": numbers, "reaches": pa.bool_()}, "px array<double>, py array<double>, w array<double>, reaches boolean", solve
        ).withColumnsRenamed({"i": "ci", "j": "cj"})

        def evaluate(batches: Iterator[pa.RecordBatch], step: float = step) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                gx, gy, ci, cj = (batch.column(c).to_numpy() for c in ("gx", "gy", "ci", "cj"))
                x, y = (gx - b["x0"]) / step - ci, (gy - b["y0"]) / step - cj
                found = np.zeros(len(x))
                for r, (px, py, w) in enumerate(zip(*(batch.column(c) for c in ("px", "py", "w")))):
                    px, py, w = (np.asarray(z.values) for z in (px, py, w))
                    far = np.hypot(gx[r] - px, gy[r] - py) / step
                    found[r] = phi(far) @ w[: len(px)] + (monomials(x[r], y[r], degree) @ w[len(px) :])
                hat = lambda t: 1 - np.abs(t) ** 2 * (3 - 2 * np.abs(t))  # noqa: E731  smooth, and two neighbours sum to one
                yield pa.RecordBatch.from_arrays(
                    [batch.column("i"), batch.column("j"), batch.column("gx"), batch.column("gy"), batch.column("reaches"), pa.array(hat(x) * hat(y) * found)],
                    ["i", "j", "gx", "gy", "reaches", "part"],
                )

        parts = corners.join(solved, ["ci", "cj"]).mapInArrow(evaluate, "i long, j long, gx double, gy double, reaches boolean, part double")
        blended = stored(parts.groupBy("i", "j", "gx", "gy").agg(F.sum("part").alias("value"), F.min("reaches").alias("reaches")))
        done.append(blended.filter("reaches").select("i", "j", "value"))
        if blended.filter(~F.col("reaches")).isEmpty():
            break
        open_ = blended.filter(~F.col("reaches")).select("i", "j", "gx", "gy")
        step /= 2
    dropped(held)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


# Triangulation


def convex_hull(points: np.ndarray) -> np.ndarray:
    """The hull's corners in counter-clockwise order."""
    points = np.unique(points, axis=0)
    if len(points) < 3:
        return points

    def chain(some: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for p in some:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(chain(points) + chain(points[::-1]))


def hull_of(points: DataFrame) -> np.ndarray:
    """The hull of all points, from those of the partitions. Corners are few beside points; more than ``HULL`` are an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 2))
        for batch in batches:
            held = convex_hull(np.r_[held, np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])])
        yield pa.RecordBatch.from_arrays([pa.array(held[:, 0]), pa.array(held[:, 1])], ["x", "y"])

    corners = points.select("x", "y").mapInArrow(run, "x double, y double").limit(HULL + 1).toPandas().to_numpy()
    if len(corners) > HULL:
        raise ValueError(f"the convex hulls of the partitions have more than {HULL} corners")
    return convex_hull(corners.reshape(-1, 2))


def inside(hull: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether places are in the hull or on its border."""
    if len(hull) < 3:
        return np.zeros(len(x), bool)
    a, b = hull, np.roll(hull, -1, 0)
    out = np.ones(len(x), bool)
    for (ax, ay), (bx, by) in zip(a, b):
        size = abs(bx - ax) + abs(by - ay)
        out &= (bx - ax) * (y - ay) - (by - ay) * (x - ax) >= -1e-12 * size * (size + np.abs(y - ay) + np.abs(x - ax))
    return out


def delaunay_triangle(near: np.ndarray, gx: float, gy: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Positions of the corners of the Delaunay triangle around a node, their barycentric weights, and how far from the
    node its circumcircle reaches; None where the points don't surround the node.

    A linear programme: the least height, over the node, of a triangle of points lifted to a paraboloid. Corners are
    exchanged as long as some point lies below the plane through them, that is inside their circumcircle.
    """
    scale = near[:, 0].max() or 1.0
    x, y = (near[:, 1] - gx) / scale, (near[:, 2] - gy) / scale
    # Three far points hold the node at first; their height makes them leave if they can.
    far = 1e3 * np.array([[-1.0, -1.0], [3.0, -1.0], [-1.0, 3.0]])
    px, py = np.r_[x, far[:, 0]], np.r_[y, far[:, 1]]
    height = np.r_[x * x + y * y, np.full(3, 1e9)]
    n = len(x)
    corners = np.array([n, n + 1, n + 2])
    for _ in range(50 + 4 * n):
        base = np.stack([px[corners], py[corners], np.ones(3)])
        weights = np.linalg.solve(base, [0.0, 0.0, 1.0])
        plane = np.linalg.solve(base.T, height[corners])
        below = height[:n] - (plane[0] * px[:n] + plane[1] * py[:n] + plane[2])
        below[corners[corners < n]] = 0
        new = int(below.argmin())
        if below[new] >= -1e-11 * (1 + abs(plane[2])) or below[new] >= -1e-13:
            break
        # The corner whose weight falls to zero first leaves.
        change = np.linalg.solve(base, [px[new], py[new], 1.0])
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(change > 1e-12, np.maximum(weights, 0) / change, np.inf)
        corners[int(ratio.argmin())] = new
    if (corners >= n).any():
        return None
    middle = plane[:2] / 2
    radius = math.sqrt(max(float(plane[2] + middle @ middle), 0.0))
    return corners, np.clip(weights, 0, 1), (float(np.hypot(*middle)) + radius) * scale


def gradients(near: np.ndarray, gx: float, gy: float, corners: np.ndarray, count: int = 12) -> tuple[np.ndarray, float]:
    """The slope at each corner (a quadratic through it, fitted to the nearest others by least squares), and how far from
    the node the points reach that decide it."""
    out, reach = np.zeros((3, 2)), 0.0
    for at, c in enumerate(corners):
        dx, dy, dv = near[:, 1] - near[c, 1], near[:, 2] - near[c, 2], near[:, 3] - near[c, 3]
        order = np.argsort(dx * dx + dy * dy, kind="stable")[1 : count + 1]
        size = np.hypot(dx[order], dy[order]).max() if len(order) else 1.0
        reach = max(reach, size + math.hypot(near[c, 1] - gx, near[c, 2] - gy))
        dx, dy = dx[order] / size, dy[order] / size
        near_one = 1 / np.hypot(dx, dy)
        terms = np.stack([dx, dy, dx * dx, dx * dy, dy * dy][: 5 if len(order) >= 5 else 2], -1)
        out[at] = np.linalg.lstsq(terms * near_one[:, None], dv[order] * near_one, rcond=1e-9)[0][:2] / size
    return out, reach


def clough_tocher(corner: np.ndarray, value: np.ndarray, slope: np.ndarray, weights: np.ndarray) -> float:
    """The cubic of Clough and Tocher over a triangle, at barycentric weights: three cubics that meet smoothly at the
    middle; across an edge the slope along its normal is linear."""
    edge = lambda a, b: corner[b] - corner[a]
    # Bezier ordinates: corners, and a third of the way along each edge and towards the middle.
    middle = corner.mean(0)
    along = {(a, b): value[a] + slope[a] @ edge(a, b) / 3 for a in range(3) for b in range(3) if a != b}
    inward = [value[a] + slope[a] @ (middle - corner[a]) / 3 for a in range(3)]
    between = {}
    for c in range(3):
        a, b = [p for p in range(3) if p != c]
        e = edge(a, b)
        # The middle's direction as a share of the edge and what is left across it.
        t = ((middle - corner[a]) @ e) / (e @ e)
        across = middle - corner[a] - t * e
        # The slope across an edge is a quadratic of its ordinates; the inner one makes it linear.
        between[c] = (slope[a] + slope[b]) @ across / 6 + (1 - t) * along[(a, b)] + t * along[(b, a)]
    third = [(inward[a] + sum(between[c] for c in range(3) if c != a)) / 3 for a in range(3)]
    top = sum(third) / 3
    c = int(np.argmin(weights))
    a, b = [p for p in range(3) if p != c]
    u, v, w = weights[a] - weights[c], weights[b] - weights[c], 3 * weights[c]
    return float(
        value[a] * u**3 + value[b] * v**3 + top * w**3 + 3 * (along[(a, b)] * u * u * v + along[(b, a)] * u * v * v)
        + 3 * (inward[a] * u * u * w + third[a] * u * w * w + inward[b] * v * v * w + third[b] * v * w * w) + 6 * between[c] * u * v * w
    )


def triangulated(nodes: DataFrame, points: DataFrame, value: str, method: str = "linear", k: int = 32) -> DataFrame:
    """(i, j, value) over the Delaunay triangles of the points, linear or cubic; NULL outside their hull."""
    held = stored(places(points, value))
    hull = hull_of(held)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("gx").to_numpy(), batch.column("gy").to_numpy()
            within = inside(hull, x, y)
            if within.any():  # a node on the hull's border goes inwards by a billionth, where a triangle holds it
                x, y = (np.where(within, c + (m - c) * 1e-9, c) for c, m in zip((x, y), hull.mean(0)))
            yield pa.RecordBatch.from_arrays([batch.column("i"), batch.column("j"), pa.array(x), pa.array(y), pa.array(within)], ["i", "j", "gx", "gy", "within"])

    asked = nodes.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), F.col("gx").cast("double").alias("gx"), F.col("gy").cast("double").alias("gy"))
    asked = stored(asked.mapInArrow(keep, "i long, j long, gx double, gy double, within boolean"))
    done = [asked.filter(~F.col("within")).select("i", "j", F.lit(None).cast("double").alias("value"))]
    open_ = asked.filter("within").drop("within")
    while True:

        def solve(gx: np.ndarray, gy: np.ndarray, lists: list[np.ndarray], k: int = k) -> dict[str, list]:
            out: dict[str, list] = {"value": [], "proven": []}
            for x, y, near in zip(gx, gy, lists):
                whole = len(near) < k
                found = delaunay_triangle(near, x, y)
                proven = whole or (found is not None and found[2] <= near[-1, 0])
                result = None
                if found and proven:
                    corners, weights, _ = found
                    if method == "linear":
                        result = float(weights @ near[corners, 3])
                    else:
                        slopes, reach = gradients(near, x, y, corners)
                        proven = whole or reach <= near[-1, 0]
                        result = clough_tocher(near[corners, 1:3], near[corners, 3], slopes, weights) if proven else None
                out["value"].append(result)
                out["proven"].append(proven)
            return out

        near = neighbours(open_, held, k)
        kinds = {"value": pa.float64(), "proven": pa.bool_()}
        found = stored(each_batch(near, kinds, "value double, proven boolean", solve))
        done.append(found.filter("proven").select("i", "j", "value"))
        left = found.filter(~F.col("proven")).select("i", "j")
        if left.isEmpty():
            break
        open_ = stored(open_.join(left, ["i", "j"], "left_semi"))
        k *= 4
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def nearest(nodes: DataFrame, points: DataFrame, value: str) -> DataFrame:
    """(i, j, value, distance) of the nearest point; ties go to the smaller x, then y."""
    near = neighbours(nodes, stored(places(points, value)), 1)
    return near.select("i", "j", F.try_element_at("near", F.lit(1))["v"].alias("value"), F.try_element_at("near", F.lit(1))["d"].alias("distance"))
