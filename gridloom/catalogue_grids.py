"""Registered queries of interpolation, regridding, outlines and smoothing, each with SQL where SQL can express it."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from gridloom import catalogue_more
from gridloom.catalogue import NODES, PX, SCORED_SQL, points, query, scored, six, size_of
from gridloom.operators import clustering, focal, interpolate, interpretation, metrics, models, predictions, regrid, rings, surface, texture
from gridloom.operators.regrid import Grid
from gridloom.sources.grid import pixel_grid

QUERIES, ORACLE_SQL = catalogue_more.QUERIES, catalogue_more.ORACLE_SQL

EXT = 'ext AS (SELECT max("row") + 1 AS nr, max(col) + 1 AS nc FROM px)'


# Surfaces through all pixels


def shares(spark, d):
    return scored(spark, d).select(F.col("col").cast("double").alias("x"), F.col("row").cast("double").alias("y"), F.col("p").alias("v"))


def clipped(df):
    """A surface of shares, with the value that places outside have."""
    return df.select("i", "j", F.greatest(F.least(F.coalesce("value", F.lit(0.0)), F.lit(1.0)), F.lit(0.0)).alias("value"))


@query("kriging_surface")
def _(spark, d):
    p = shares(spark, d)
    return clipped(interpolate.kriging(surface.regular_grid(p, 20), p, "v", k=32, length=3.0, noise=0.01))


@query("rbf_surface")
def _(spark, d):
    p = shares(spark, d)
    return clipped(interpolate.radial(surface.regular_grid(p, 20), p, "v", "thin_plate_spline"))


@query("griddata_linear")
def _(spark, d):
    p = shares(spark, d)
    return clipped(interpolate.triangulated(surface.regular_grid(p, 20), p, "v", "linear"))


@query("griddata_cubic")
def _(spark, d):
    p = shares(spark, d)
    return clipped(interpolate.triangulated(surface.regular_grid(p, 20), p, "v", "cubic"))


@query("griddata_nearest", f"""WITH {NODES}, best AS (SELECT i, j, v, d, row_number() OVER (PARTITION BY i, j ORDER BY (gx - x) * (gx - x) + (gy - y) * (gy - y), x, y) AS k
  FROM (SELECT i, j, gx, gy, x, y, v, sqrt((gx - x) * (gx - x) + (gy - y) * (gy - y)) AS d FROM nodes, pts)) SELECT i::bigint AS i, j::bigint AS j, {six("v")} AS value, {six("d")} AS distance FROM best WHERE k = 1""")
def _(spark, d):
    p = points(spark, d)
    return interpolate.nearest(surface.regular_grid(p, 20), p, "v")


# Smoothing and texture

MIRRORED = f"""WITH {PX}, {EXT}, o AS (SELECT unnest(range(-5, 6)) AS k),
turn AS (SELECT "row", col, nr, nc, (("row" + a.k) % (2 * nr) + 2 * nr) % (2 * nr) AS r, ((col + b.k) % (2 * nc) + 2 * nc) % (2 * nc) AS c FROM px, ext, o a, o b),
spot AS (SELECT "row", col, least(r, 2 * nr - 1 - r) AS r, least(c, 2 * nc - 1 - c) AS c FROM turn),
v AS (SELECT spot."row", spot.col, px.b08 AS v FROM spot JOIN px ON px."row" = r AND px.col = c)"""


@query("smooth_median", f'{MIRRORED} SELECT "row", col, {six("quantile_cont(v, 0.5)")} AS value FROM v GROUP BY "row", col')
def _(spark, d):
    g = pixel_grid(spark, d)
    return focal.median(g, "b08", 11, *size_of(g))


@query("smooth_uniform", f'{MIRRORED} SELECT "row", col, {six("avg(v)")} AS value FROM v GROUP BY "row", col')
def _(spark, d):
    g = pixel_grid(spark, d)
    return focal.uniform(g, "b08", 11, *size_of(g))


LEVELS = 'level AS (SELECT "row", col, floor(greatest(0, least(1, b08)) * 255 + 0.5) AS v FROM px)'


@query("lbp_uniform", f"""WITH {PX}, {LEVELS}, place AS (SELECT k, round(-3 * sin(2 * pi() * k / 24), 5) AS r, round(3 * cos(2 * pi() * k / 24), 5) AS c FROM (SELECT unnest(range(24)) AS k)),
corner AS (SELECT k, floor(r)::int + a AS dr, floor(c)::int + b AS dc, abs(1 - a - (r - floor(r))) * abs(1 - b - (c - floor(c))) AS w FROM place, (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b)),
lit AS (SELECT l."row", l.col, k, coalesce(sum(w * n.v), 0) >= l.v - 1e-6 AS one FROM level l CROSS JOIN corner LEFT JOIN level n ON n."row" = l."row" + dr AND n.col = l.col + dc GROUP BY l."row", l.col, k, l.v),
ring AS (SELECT "row", col, list(one ORDER BY k) AS o FROM lit GROUP BY "row", col)
SELECT "row", col, CASE WHEN len([x for x, i in o if x <> o[CASE WHEN i = 1 THEN 24 ELSE i - 1 END]]) <= 2 THEN len([x for x in o if x]) ELSE 25 END::int AS code FROM ring""")
def _(spark, d):
    g = pixel_grid(spark, d)
    return texture.binary_patterns(g, "b08", *size_of(g))


# Grids of unlike resolution

KERNEL_SQL = {
    "cubic": (2, "CASE WHEN {x} < 1 THEN (1.5 * {x} - 2.5) * {x} * {x} + 1 ELSE ((-0.5 * {x} + 2.5) * {x} - 4) * {x} + 2 END"),
    "cubic_spline": (2, "CASE WHEN {x} < 1 THEN (3 * {x} - 6) * {x} * {x} + 4 ELSE (2 - {x}) * (2 - {x}) * (2 - {x}) END / 6"),
    "lanczos": (3, "CASE WHEN {x} < 1e-12 THEN 1 ELSE sin(pi() * {x}) / (pi() * {x}) * sin(pi() * {x} / 3) / (pi() * {x} / 3) END"),
}


def resampling_sql(kernel: str, ratio: float) -> str:
    radius, formula = KERNEL_SQL[kernel]
    wide = max(1.0, ratio)

    def axis(name: str, n: str) -> str:
        far = f"(abs((t + 0.5) * {ratio}::double - 0.5 - s) / {wide}::double)"
        return f"""{name} AS (SELECT t::int AS t, s::int AS s, {formula.format(x=far)} AS w FROM (SELECT unnest(range((SELECT ceil({n} / {ratio}::double)::bigint FROM ext))) AS t) a, (SELECT unnest(range((SELECT {n} FROM ext))) AS s) b
            WHERE {far} < {radius})"""

    return f"""WITH {PX}, {EXT}, {axis("wr", "nr")}, {axis("wc", "nc")},
        v AS (SELECT wr.t AS "row", wc.t AS col, sum(wr.w * wc.w * b08) AS s, sum(wr.w * wc.w) AS n FROM px JOIN wr ON wr.s = px."row" JOIN wc ON wc.s = px.col GROUP BY wr.t, wc.t)
        SELECT "row", col, {six("s / n")} AS value FROM v WHERE abs(n) > 1e-6"""


def unlike(g, step: float) -> tuple[Grid, Grid]:
    rows, cols = size_of(g)
    return Grid(0.0, float(rows), 1.0, rows, cols), Grid(0.0, float(rows), step, -int(-rows // step), -int(-cols // step))


for _kernel, _step in (("cubic", 2.5), ("cubic_spline", 0.75), ("lanczos", 1.5)):

    @query(f"resample_{_kernel}", resampling_sql(_kernel, _step))
    def _(spark, d, kernel=_kernel, step=_step):
        g = pixel_grid(spark, d)
        return regrid.resampled(g, "b08", *unlike(g, step), kernel)


OVERLAP = f"""WITH {PX}, {EXT}, m AS (SELECT t.r AS "row", t.c AS col, b08 AS v,
    (least((px."row" + 1) / 2.5::double, t.r + 1) - greatest(px."row" / 2.5::double, t.r)) * (least((px.col + 1) / 2.5::double, t.c + 1) - greatest(px.col / 2.5::double, t.c)) AS a
  FROM px, ext, (SELECT r::int AS r, c::int AS c FROM (SELECT unnest(range((SELECT ceil(nr / 2.5)::bigint FROM ext))) AS r) x, (SELECT unnest(range((SELECT ceil(nc / 2.5)::bigint FROM ext))) AS c) y) t
  WHERE t.r < px."row" / 2.5::double + 0.4 AND t.r + 1 > px."row" / 2.5::double AND t.c < px.col / 2.5::double + 0.4 AND t.c + 1 > px.col / 2.5::double)"""


@query("align_by_area", f'{OVERLAP} SELECT "row", col, {six("sum(v * a) / sum(a)")} AS value, {six("sum(a)")} AS covered FROM m WHERE a > 1e-12 GROUP BY "row", col')
def _(spark, d):
    g = pixel_grid(spark, d)
    return regrid.aligned_by_area(g, "b08", *unlike(g, 2.5))


@query("align_totals", f'{OVERLAP} SELECT "row", col, {six("sum(v * a * 6.25::double)")} AS value, {six("sum(a)")} AS covered FROM m WHERE a > 1e-12 GROUP BY "row", col')
def _(spark, d):
    g = pixel_grid(spark, d)
    return regrid.aligned_by_area(g, "b08", *unlike(g, 2.5), total=True)


# Reprojection: pixels of a thousandth of a degree, to 100 m of a zone of UTM

ZONE, LEFT, TOP, DEGREES, METRES = 45, 85.0, 28.0, 0.001, 100.0


def degrees(g) -> Grid:
    return Grid(LEFT, TOP, DEGREES, *size_of(g))


def utm_sql(lon: str, lat: str) -> tuple[str, str]:
    """Easting and northing by the same published series."""
    phi, away = f"radians({lat})", f"radians({lon} - {regrid.meridian(ZONE)}::double)"
    t = f"sinh(atanh(sin({phi})) - {regrid.ECCENTRIC!r}::double * atanh({regrid.ECCENTRIC!r}::double * sin({phi})))"
    xi, eta = f"atan2({t}, cos({away}))", f"atanh(sin({away}) / sqrt(1 + {t} * {t}))"
    north, east = ("".join(f" + {a!r}::double * {f}({2 * j} * {xi}) * {g}({2 * j} * {eta})" for j, a in enumerate(regrid.FORWARD, 1)) for f, g in (("sin", "cosh"), ("cos", "sinh")))
    size = regrid.SCALE * regrid.RADIUS
    return f"({regrid.EAST}::double + {size!r}::double * ({eta}{east}))", f"({size!r}::double * ({xi}{north}))"


def degrees_sql(x: str, y: str) -> tuple[str, str]:
    size = regrid.SCALE * regrid.RADIUS
    xi, eta = f"({y} / {size!r}::double)", f"(({x} - {regrid.EAST}::double) / {size!r}::double)"
    a, e = (f"({z}{''.join(f' - {b!r}::double * {f}({2 * j} * {xi}) * {g}({2 * j} * {eta})' for j, b in enumerate(regrid.INVERSE, 1))})" for z, f, g in ((xi, "sin", "cosh"), (eta, "cos", "sinh")))
    chi = f"asin(sin({a}) / cosh({e}))"
    lat = chi + "".join(f" + {c!r}::double * sin({2 * j} * {chi})" for j, c in enumerate(regrid.LATITUDE, 1))
    return f"({regrid.meridian(ZONE)}::double + degrees(atan2(sinh({e}), cos({a}))))", f"degrees({lat})"


_E, _N = utm_sql("lon", "lat")
_LON, _LAT = degrees_sql("x", "y")
GROUND = f"""WITH {PX}, {EXT}, corner AS (SELECT {LEFT}::double + (col + b) * {DEGREES}::double AS lon, {TOP}::double - ("row" + a) * {DEGREES}::double AS lat FROM px, (SELECT unnest([0, 1]) AS a) p, (SELECT unnest([0, 1]) AS b) q),
box AS (SELECT floor(min(e) / {METRES}) * {METRES} AS x0, ceil(max(e) / {METRES}) * {METRES} AS x1, floor(min(n) / {METRES}) * {METRES} AS y0, ceil(max(n) / {METRES}) * {METRES} AS y1 FROM (SELECT {_E} AS e, {_N} AS n FROM corner)),
target AS (SELECT r::int AS "row", c::int AS col, x0 + (c + 0.5) * {METRES} AS x, y1 - (r + 0.5) * {METRES} AS y FROM box, (SELECT unnest(range((SELECT round((y1 - y0) / {METRES})::bigint FROM box))) AS r) p, (SELECT unnest(range((SELECT round((x1 - x0) / {METRES})::bigint FROM box))) AS c) q),
spot AS (SELECT "row", col, ({TOP}::double - lat) / {DEGREES}::double AS r, (lon - {LEFT}::double) / {DEGREES}::double AS c FROM (SELECT "row", col, {_LON} AS lon, {_LAT} AS lat FROM target)),
there AS (SELECT spot.* FROM spot, ext WHERE r >= 0 AND r < nr AND c >= 0 AND c < nc)"""


@query("utm_round_trip", f"""WITH {PX}, p AS (SELECT "row", col, {LEFT}::double + (col + 0.5) * {DEGREES}::double AS lon, {TOP}::double - ("row" + 0.5) * {DEGREES}::double AS lat FROM px)
SELECT "row", col, {six(_E)} AS easting, {six(_N)} AS northing, TRUE AS returns FROM p""")
def _(spark, d):
    placed = pixel_grid(spark, d).select("row", "col", (LEFT + (F.col("col") + 0.5) * DEGREES).alias("lon"), (TOP - (F.col("row") + 0.5) * DEGREES).alias("lat"))
    there = regrid.utm_forward(placed, "lon", "lat", "easting", "northing", ZONE)
    back = regrid.utm_inverse(there, "easting", "northing", "lon2", "lat2", ZONE)
    near = F.greatest(F.abs(F.col("lon2") - F.col("lon")), F.abs(F.col("lat2") - F.col("lat"))) < 9e-12  # a micrometre
    return back.select("row", "col", "easting", "northing", near.alias("returns"))


for _method, _sql in (
    ("nearest", f'{GROUND} SELECT there."row", there.col, {six("b08")} AS value FROM there JOIN px ON px."row" = floor(r) AND px.col = floor(c)'),
    ("bilinear", f"""{GROUND}, w AS (SELECT there."row", there.col, b08 AS v, (1 - abs(r - 0.5 - px."row")) * (1 - abs(c - 0.5 - px.col)) AS w FROM there, (SELECT unnest([0, 1]) AS a) p, (SELECT unnest([0, 1]) AS b) q, px
        WHERE px."row" = floor(r - 0.5) + a AND px.col = floor(c - 0.5) + b) SELECT "row", col, {six("sum(w * v) / sum(w)")} AS value FROM w WHERE w > 1e-12 GROUP BY "row", col"""),
):

    @query(f"reproject_{_method}", _sql)
    def _(spark, d, method=_method):
        g = pixel_grid(spark, d)
        source = degrees(g)
        target = regrid.covering(g, source, partial(regrid.utm_forward, zone=ZONE), METRES)
        return regrid.reprojected(g, "b08", source, target, partial(regrid.utm_inverse, zone=ZONE), method)


# Outlines


@query("zone_polygons", f"""WITH RECURSIVE {SCORED_SQL}, z AS (SELECT "row", col, "row"::bigint * 50 + col AS cell, (p >= 0.2)::int + (p >= 0.4)::int + (p >= 0.6)::int + (p >= 0.8)::int AS zone FROM scored),
e AS (SELECT a.cell AS a, b.cell AS b FROM z a JOIN z b ON a.zone = b.zone AND ((a."row" = b."row" AND abs(a.col - b.col) = 1) OR (a.col = b.col AND abs(a."row" - b."row") = 1))),
walk AS (SELECT cell AS a, cell AS b FROM z UNION SELECT walk.a, e.b FROM walk JOIN e ON walk.b = e.a),
r AS (SELECT "row", col, cell, zone, min(b) AS region FROM z JOIN walk ON walk.a = z.cell GROUP BY "row", col, cell, zone),
touch AS (SELECT region, count(*) / 2 AS t FROM r JOIN e ON e.a = r.cell GROUP BY region),
square AS (SELECT a.region, count(*) AS s FROM r a JOIN r b ON b.region = a.region AND b."row" = a."row" AND b.col = a.col + 1 JOIN r c ON c.region = a.region AND c."row" = a."row" + 1 AND c.col = a.col
    JOIN r d ON d.region = a.region AND d."row" = a."row" + 1 AND d.col = a.col + 1 GROUP BY a.region)
SELECT region, any_value(zone) AS zone, count(*) AS area, (4 * count(*) - 2 * coalesce(any_value(t), 0))::bigint AS perimeter, (1 - count(*) + coalesce(any_value(t), 0) - coalesce(any_value(s), 0))::bigint AS holes
FROM r LEFT JOIN touch USING (region) LEFT JOIN square USING (region) GROUP BY region""")
def _(spark, d):
    s = scored(spark, d).withColumn("zone", sum(((F.col("p") >= t).cast("int") for t in (0.2, 0.4, 0.6, 0.8)), F.lit(0)))
    return rings.polygons(predictions.regions(s, "zone", 50), ["zone"]).drop("geometry")


# Clusters

LLOYD = f"""WITH {PX}, c AS (SELECT (row_number() OVER (ORDER BY "row", col) - 1)::int AS c, b04 AS c1, b08 AS c2 FROM px ORDER BY "row", col LIMIT 4),
d AS (SELECT "row", col, b04, b08, c, (b04 - c1) * (b04 - c1) + (b08 - c2) * (b08 - c2) AS d FROM px, c),
a AS (SELECT *, row_number() OVER (PARTITION BY "row", col ORDER BY d, c) AS k FROM d)"""


@query("kmeans_lloyd_step", f'{LLOYD} SELECT c AS cluster, count(*) AS n, {six("avg(b04)")} AS b04, {six("avg(b08)")} AS b08, {six("sum(d)")} AS inertia FROM a WHERE k = 1 GROUP BY c')
def _(spark, d):
    g = pixel_grid(spark, d)
    centres = [(r["b04"], r["b08"]) for r in g.orderBy("row", "col").limit(4).collect()]
    return clustering.lloyd_step(g, ["b04", "b08"], centres)


@query("kmeans_best_of_10")
def _(spark, d):
    return clustering.kmeans(pixel_grid(spark, d), ["b02", "b04", "b08", "b11"], 4).select("row", "col", "cluster")


@query("pca_scores", f"""WITH {PX}, m AS (SELECT avg(b04) AS m1, stddev_pop(b04) AS s1, avg(b08) AS m2, stddev_pop(b08) AS s2, corr(b04, b08) AS r FROM px),
z AS (SELECT "row", col, (b04 - m1) / s1 AS a, (b08 - m2) / s2 AS b, r FROM px, m)
SELECT "row", col, {six("CASE WHEN r >= 0 THEN (a + b) / sqrt(2) ELSE (a - b) / sqrt(2) END")} AS first, {six("CASE WHEN r >= 0 THEN (a - b) / sqrt(2) ELSE (a + b) / sqrt(2) END")} AS second FROM z""")
def _(spark, d):
    g = pixel_grid(spark, d)
    scores = clustering.components(g, ["b04", "b08"], 1.0).of(g)
    return scores.select("row", "col", F.col("v")[0].alias("first"), F.col("v")[1].alias("second"))


@query("full_silhouette", f"""WITH {PX}, p AS (SELECT row_number() OVER () AS n, scl AS c, b04, b08 FROM px), size AS (SELECT c, count(*) AS k FROM p GROUP BY c),
d AS (SELECT a.n, a.c AS own, b.c, sum(sqrt((a.b04 - b.b04) * (a.b04 - b.b04) + (a.b08 - b.b08) * (a.b08 - b.b08))) AS s FROM p a, p b GROUP BY a.n, a.c, b.c),
s AS (SELECT n, own, max(CASE WHEN c = own THEN s / greatest(k - 1, 1) END) AS a, min(CASE WHEN c <> own THEN s / k END) AS b, max(CASE WHEN c = own THEN k END) AS k FROM d JOIN size USING (c) GROUP BY n, own)
SELECT own AS cluster, count(*) AS n, {six("avg(CASE WHEN k > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END)")} AS silhouette FROM s GROUP BY own""")
def _(spark, d):
    return clustering.silhouette_by_cluster(pixel_grid(spark, d), "scl", ["b04", "b08"])


# Curves, importances, words for clusters


@query("roc_curve", f"""WITH {SCORED_SQL}, s AS (SELECT round(p, 9) AS s, sum(y) AS p, sum(1 - y) AS n FROM scored GROUP BY 1),
c AS (SELECT s, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM s WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING))
SELECT -1.0::double AS threshold, 0.0::double AS fpr, 0.0::double AS tpr UNION ALL SELECT {six("s")}, {six("fp / max(fp) OVER ()")}, {six("tp / max(tp) OVER ()")} FROM c""")
def _(spark, d):
    found = metrics.roc_curve(scored(spark, d).withColumn("s", F.round("p", 9)), "y", "s")
    return found.withColumn("threshold", F.when(F.col("threshold") < float("inf"), F.col("threshold")).otherwise(-1.0))  # infinite has no six places


@query("forest_importances")
def _(spark, d):
    return models.forest_importances(scored(spark, d), ["b02", "b03", "b04", "b08", "b11"], "y", trees=20, depth=5)


_WORDS = """CASE WHEN avg(elevation) > 1000 THEN 'high elevation' WHEN avg(elevation) < 500 THEN 'low elevation' ELSE 'moderate elevation' END || '; ' ||
CASE WHEN avg(ndvi) > 0.5 THEN 'dense vegetation' WHEN avg(ndvi) < 0.1 THEN 'sparse vegetation/bare rock' ELSE 'moderate vegetation' END ||
CASE WHEN avg(b11) > stddev_pop(b11) THEN '; elevated cu' ELSE '' END"""


@query("cluster_signatures", f"""WITH {PX}, v AS (SELECT scl, elevation, (b08 - b04) / (b08 + b04) AS ndvi, b11 FROM px)
SELECT scl AS cluster, {_WORDS} AS signature, 'background/host rock' AS targets FROM v GROUP BY scl""")
def _(spark, d):
    g = pixel_grid(spark, d).withColumns({"ndvi": (F.col("b08") - F.col("b04")) / (F.col("b08") + F.col("b04")), "cu": F.col("b11")})
    features = ["elevation", "ndvi", "cu"]
    return interpretation.signatures(models.cluster_profile(g, "scl", features), "scl", features)


@query("gabor_bank")
def _(spark, d):
    g = pixel_grid(spark, d)
    return texture.gabor_bank(g, "b04", [0.1, 0.3, 0.5], 4, *size_of(g))
