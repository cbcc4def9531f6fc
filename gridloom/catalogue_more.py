"""Registered queries on predictions, validation, names, ground measures and joins, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.catalogue import EXT_SQL, ORACLE_SQL, PX, QUERIES, SCORED_SQL, query, scored, six, size_of
from gridloom.functions import geo, naming
from gridloom.functions.bandmath import INDICES, SENSORS, band_math, spectral_index
from gridloom.operators import features, masks, models, predictions, spectral, texture, validation
from gridloom.plans import process, steps
from gridloom.sources.grid import BANDS, null_if, pixel_grid, table

__all__ = ["ORACLE_SQL", "QUERIES"]

# Predictions -------------------------------------------------------------------------

SCORES = "[b04 * 10, b08 * 5, b11 * 4]::double[]"
SOFT = f"""raw AS (SELECT *, {SCORES} AS s FROM px), ex AS (SELECT *, [exp(x - list_max(s)) for x in s] AS e FROM raw), soft AS (SELECT *, [x / list_sum(e) for x in e] AS p FROM ex)"""


def soft(spark, d):
    scores = F.array(F.col("b04") * 10, F.col("b08") * 5, F.col("b11") * 4)
    return pixel_grid(spark, d).withColumn("p", predictions.softmax(scores))


@query("probability_from_scores", f"""WITH {PX}, {SOFT} SELECT "row", col, {six("list_max(p)")} AS generic, {six("p[2] / 2 + p[3]")} AS ordered, {six("1 / (1 + exp(-(b08 * 5 - 2)))")} AS binary FROM soft""")
def _(spark, d):
    g = soft(spark, d)
    return g.select(
        "row", "col", predictions.probability(F.col("p"), "generic").alias("generic"), predictions.probability(F.col("p"), "mineral_targeting").alias("ordered"),
        predictions.sigmoid(F.col("b08") * 5 - 2).alias("binary"),
    )


@query("class_layers", f"""WITH {PX}, {SOFT}, found AS (SELECT "row", col, list_position(p, list_max(p)) - 1 AS class, list_max(p) AS confidence, p FROM soft WHERE scl NOT IN (8, 9, 10, 3))
SELECT px."row", px.col, coalesce(class, -9999)::double AS class, {six("coalesce(confidence, -9999)")} AS confidence, {", ".join(f"{six(f'coalesce(p[{k + 1}], -9999)')} AS probability_{k}" for k in range(3))} FROM px LEFT JOIN found f ON f."row" = px."row" AND f.col = px.col""")
def _(spark, d):
    g = soft(spark, d)
    found = predictions.class_layers(g.filter(~masks.scene_mask(F.col("scl"))), "p")
    return predictions.on_grid(g, found, ["class", "confidence", "probability_0", "probability_1", "probability_2"])


@query("prediction_geojson", f"""WITH {SCORED_SQL} SELECT "row", col, '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || col || ',' || "row" || ']}},"properties":{{"zone":' || z || '}}}}' AS feature FROM predicted WHERE greatest(p, 1 - p) >= 0.7::double""")
def _(spark, d):
    s = scored(spark, d).withColumn("zone", F.col("z")).withColumn("sure", F.greatest("p", 1 - F.col("p")))
    return predictions.geojson(s, F.col("col"), F.col("row"), ["zone"], "sure", 0.7)


@query("zone_regions", f"""WITH RECURSIVE {SCORED_SQL}, z AS (SELECT "row", col, "row"::bigint * 50 + col AS cell, (p >= 0.2)::int + (p >= 0.4)::int + (p >= 0.6)::int + (p >= 0.8)::int AS zone FROM scored),
e AS (SELECT a.cell AS a, b.cell AS b FROM z a JOIN z b ON a.zone = b.zone AND ((a."row" = b."row" AND abs(a.col - b.col) = 1) OR (a.col = b.col AND abs(a."row" - b."row") = 1))),
walk AS (SELECT cell AS a, cell AS b FROM z UNION SELECT walk.a, e.b FROM walk JOIN e ON walk.b = e.a)
SELECT "row", col, zone, min(b) AS region FROM z JOIN walk ON walk.a = z.cell GROUP BY "row", col, zone""")
def _(spark, d):
    s = scored(spark, d).withColumn("zone", sum(((F.col("p") >= t).cast("int") for t in (0.2, 0.4, 0.6, 0.8)), F.lit(0)))
    return predictions.regions(s, "zone", 50)


@query("uncertainty_stats", " UNION ALL ".join(f"""SELECT * FROM (WITH {PX}, q AS (SELECT quantile_cont({m}, 0.75) AS t FROM px) SELECT '{m}' AS map, {six(f"avg({m})")} AS mean, {six(f"stddev_pop({m})")} AS std, {six(f"min({m})")} AS min, {six(f"max({m})")} AS max,
{six(f"count(*) FILTER ({m} > t) * 100 / count(*)")} AS high_pct, {six(f"quantile_cont({m}, 0.25)")} AS q25, {six(f"quantile_cont({m}, 0.5)")} AS median, {six("any_value(t)")} AS q75 FROM px, q)""" for m in ("b11", "b12")))
def _(spark, d):
    return predictions.uncertainty_stats(pixel_grid(spark, d), ["b11", "b12"])


@query("combined_interval", f"""WITH {PX} SELECT "row", col, {six("b04 - 1.959964 * b11")} AS lower, {six("b04 + 1.959964 * b11")} AS upper FROM px""")
def _(spark, d):
    low, high = predictions.confidence_interval(F.col("b04"), F.col("b11"))
    return pixel_grid(spark, d).select("row", "col", low.alias("lower"), high.alias("upper"))


for _app, _names in (("landslide_susceptibility", naming.CLASS_LABELS["landslide_susceptibility"]), ("mineral_targeting", naming.CLASS_LABELS["mineral_targeting"]), ("generic", ("Class_0", "Class_1", "Class_2"))):

    @query(f"class_labels_{_app.split('_')[0]}", f"""WITH {PX} SELECT "row", col, {f"['{chr(39).join((',').join(_names).split(',')).replace(chr(39), chr(39) + ',' + chr(39))}'][scl % {len(_names)} + 1]"} AS label FROM px""")
    def _(spark, d, app=_app, n=len(_names)):
        return pixel_grid(spark, d).select("row", "col", naming.class_label(F.col("scl") % n, app, n).alias("label"))


# Validation --------------------------------------------------------------------------

#: The upper tail of chi-square with four degrees of freedom is exp(-x / 2) (1 + x / 2).
@query("logistic_diagnostics", f"""WITH {SCORED_SQL}, l AS (SELECT sum(y * ln(p) + (1 - y) * ln(1 - p)) AS ll, avg(y) AS s, count(*) AS n FROM scored),
m AS (SELECT *, n * (s * ln(s) + (1 - s) * ln(1 - s)) AS l0 FROM l), r AS (SELECT *, -2 * (l0 - ll) AS x FROM m)
SELECT {six("ll")} AS log_likelihood, {six("l0")} AS null_log_likelihood, {six("x")} AS ratio, {six("CASE WHEN x > 0 THEN exp(-x / 2) * (1 + x / 2) ELSE 1 END")} AS p_value, {six("1 - ll / l0")} AS mcfadden, {six("10 - 2 * ll")} AS aic, {six("ln(n) * 5 - 2 * ll")} AS bic FROM r""")
def _(spark, d):
    return validation.logistic_diagnostics(scored(spark, d), "y", "p", 4)


@query("fold_scores", f"""WITH {SCORED_SQL} SELECT (("row" * 50 + col) % 5)::int AS fold, {six("avg((y = z)::int)")} AS score, count(*) AS n FROM predicted GROUP BY 1""")
def _(spark, d):
    return validation.fold_scores(scored(spark, d), ((F.col("row") * 50 + F.col("col")) % 5).cast("int"), F.col("y") == F.col("z"))


#: Student's t with four degrees of freedom has a closed form.
@query("fold_interval", f"""WITH {SCORED_SQL}, f AS (SELECT avg((y = z)::int) AS s FROM predicted GROUP BY ("row" * 50 + col) % 5), m AS (SELECT avg(s) AS m, stddev_samp(s) AS d FROM f),
t AS (SELECT *, (m - 0.5) / (d / sqrt(5)) AS t FROM m), u AS (SELECT *, abs(t) / sqrt(1 + t * t / 4) AS u FROM t)
SELECT {six("m")} AS mean, {six("d")} AS std, {six("m - 2.7764451051977987 * d / sqrt(5)")} AS lower, {six("m + 2.7764451051977987 * d / sqrt(5)")} AS upper, {six("t")} AS t, {six("1 - 0.75 * u * (1 - u * u / 12)")} AS p_value FROM u""")
def _(spark, d):
    folds = validation.fold_scores(scored(spark, d), (F.col("row") * 50 + F.col("col")) % 5, F.col("y") == F.col("z"))
    found = validation.fold_interval([r["score"] for r in folds.orderBy("fold").collect()])
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{k} double" for k in found))


HASHED = "('0x' || substr(md5('{seed}:' || id), 1, 13))::bigint"
PREDICT = "(1 / (1 + exp(-(8 * (b08 - b04) / (b08 + b04) + elevation / 1000.0 - 8))) >= 0.5::double)::int"


def shuffled_sql(column: str, seed: int, predict: str, label: str) -> str:
    """The accuracy with a column dealt anew."""
    names = [c for c in ("b04", "b08", "elevation", "y") if c != column]
    return f"""(SELECT avg(({predict} = {label})::int) FROM (SELECT {", ".join(names)}, row_number() OVER (ORDER BY id) AS k FROM s) a JOIN (SELECT {column}, row_number() OVER (ORDER BY {HASHED.format(seed=seed)}) AS k FROM s) b USING (k))"""


def keyed(spark, d):
    return scored(spark, d).withColumn("id", (F.col("row") * 50 + F.col("col")).cast("long"))


def closed_form():
    logit = 8 * (F.col("b08") - F.col("b04")) / (F.col("b08") + F.col("b04")) + F.col("elevation") / 1000.0 - 8
    return (1 / (1 + F.exp(-logit)) >= 0.5).cast("int")


_KEYED = f'{SCORED_SQL}, s AS (SELECT *, "row"::bigint * 50 + col AS id FROM scored), base AS (SELECT avg(({PREDICT} = y)::int) AS a FROM s)'


@query("permutation_importance", f"""WITH {_KEYED}, r AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, a - {shuffled_sql(c, k, PREDICT, 'y')} AS f FROM base" for c in ("b04", "b08", "elevation") for k in range(3))})
SELECT feature, {six("avg(f)")} AS importance_mean, {six("stddev_pop(f)")} AS importance_std FROM r GROUP BY feature""")
def _(spark, d):
    s = keyed(spark, d).select("id", "b04", "b08", "elevation", "y")
    return validation.permutation_importance(s, ["b04", "b08", "elevation"], "y", closed_form(), "id").drop("p_value")


@query("permutation_test", f"""WITH {_KEYED}, r AS ({" UNION ALL ".join(f"SELECT {shuffled_sql('y', k, PREDICT, 'y')} AS x" for k in range(5))})
SELECT {six("any_value(a)")} AS score, {six("(count(*) FILTER (x >= a) + 1) / 6")} AS p_value FROM r, base""")
def _(spark, d):
    return validation.permutation_test(keyed(spark, d).select("id", "b04", "b08", "elevation", "y"), "y", closed_form(), "id")


@query("validation_summary", f"""WITH {SCORED_SQL}, f AS (SELECT scl, avg((y = z)::int) AS a, avg((y = z)::int) - avg((y = z)::int) FILTER (col % 2 = 0) AS g FROM predicted GROUP BY scl),
l AS (SELECT *, CASE WHEN a > 0.9::double THEN 'Excellent' WHEN a > 0.8::double THEN 'Good' WHEN a > 0.7::double THEN 'Fair' ELSE 'Poor' END AS level FROM f)
SELECT scl, {six("a")} AS accuracy, level, CASE WHEN abs(g) > 0.1::double THEN 'high' WHEN abs(g) > 0.05::double THEN 'moderate' ELSE 'low' END AS overfitting,
CASE WHEN level IN ('Excellent', 'Good') AND abs(g) < 0.1::double THEN 'strong' WHEN level IN ('Excellent', 'Good') THEN 'may be overfitting' WHEN level = 'Fair' THEN 'moderate' ELSE 'poor' END AS assessment FROM l""")
def _(spark, d):
    hit = (F.col("y") == F.col("z")).cast("double")
    f = scored(spark, d).groupBy("scl").agg(F.avg(hit).alias("accuracy"), (F.avg(hit) - F.avg(F.when(F.col("col") % 2 == 0, hit))).alias("gap"))
    found = validation.validation_summary(F.col("accuracy"), F.col("gap"))
    return f.select("scl", "accuracy", *[c.alias(n) for n, c in found.items()])


_D2 = "(b04 - m1) * (b04 - m1) + (b08 - m2) * (b08 - m2)"


@query("cluster_scores", f"""WITH {PX}, c AS (SELECT scl AS c, count(*) AS n, avg(b04) AS m1, avg(b08) AS m2 FROM px GROUP BY scl), g AS (SELECT avg(b04) AS g1, avg(b08) AS g2, count(*) AS n FROM px),
d AS (SELECT "row", col, scl, max(sqrt({_D2})) FILTER (c = scl) AS a, min(sqrt({_D2})) FILTER (c <> scl) AS b FROM px, c GROUP BY "row", col, scl),
s AS (SELECT scl AS c, avg(a) AS s FROM d GROUP BY scl), x AS (SELECT c.*, s FROM c JOIN s USING (c)),
r AS (SELECT a.c, max((a.s + b.s) / sqrt((a.m1 - b.m1) * (a.m1 - b.m1) + (a.m2 - b.m2) * (a.m2 - b.m2))) AS r FROM x a, x b WHERE a.c <> b.c GROUP BY a.c),
i AS (SELECT sum(a * a) AS i, avg((b - a) / greatest(a, b)) AS q FROM d), k AS (SELECT count(*) AS k, sum(c.n * ((m1 - g1) * (m1 - g1) + (m2 - g2) * (m2 - g2))) AS b FROM c, g)
SELECT {six("i")} AS inertia, {six("(b / (k - 1)) / (i / (g.n - k))")} AS calinski_harabasz, {six("(SELECT avg(r) FROM r)")} AS davies_bouldin, {six("q")} AS silhouette FROM i, k, g""")
def _(spark, d):
    return validation.cluster_scores(pixel_grid(spark, d), "scl", ["b04", "b08"])


# Joins and sets ----------------------------------------------------------------------


@query("mask_semi_join", f'WITH {PX} SELECT "row", col, {six("b04")} AS b04 FROM px WHERE EXISTS (SELECT 1 FROM px m WHERE m.scl IN (4, 5) AND m."row" = px."row" AND m.col = px.col)')
def _(spark, d):
    g = pixel_grid(spark, d)
    return g.join(g.filter("scl IN (4, 5)").select("row", "col"), ["row", "col"], "left_semi").select("row", "col", "b04")


@query("mask_anti_join", f'WITH {PX} SELECT "row", col, {six("b04")} AS b04 FROM px WHERE NOT EXISTS (SELECT 1 FROM px m WHERE m.scl IN (8, 9, 10, 3) AND m."row" = px."row" AND m.col = px.col)')
def _(spark, d):
    g = pixel_grid(spark, d)
    return g.join(g.filter(masks.scene_mask(F.col("scl"))).select("row", "col"), ["row", "col"], "left_anti").select("row", "col", "b04")


@query("grid_alignment", f"""WITH {PX}, coarse AS (SELECT "row" // 4 AS r, col // 4 AS c, avg(b11) AS v FROM px GROUP BY 1, 2) SELECT px."row", px.col, {six("b04")} AS red, {six("v")} AS swir FROM px JOIN coarse ON r = px."row" // 4 AND c = px.col // 4""")
def _(spark, d):
    g = pixel_grid(spark, d)
    red = g.select("row", "col", F.col("b04").alias("value"))
    return features.stack({"red": red, "swir": features.aligned(red, texture.downsample(g, "b11", 4, "average"), 4)})


_USERS = "SELECT DISTINCT event_type || ':' || (user_id % 7) AS name FROM events WHERE"
for _set, _join in (("intersect", "INTERSECT"), ("except", "EXCEPT")):

    @query(f"names_{_set}", f"{_USERS} day(ts) < 3 AND user_id % 3 <> 1 {_join} {_USERS} day(ts) >= 25 AND user_id % 7 < 4")
    def _(spark, d, kind=_set):
        name = F.concat_ws(":", "event_type", (F.col("user_id") % 7).cast("string")).alias("name")
        e = table(spark, d, "events")
        early, late = e.filter("day(ts) < 3 AND user_id % 3 <> 1").select(name), e.filter("day(ts) >= 25 AND user_id % 7 < 4").select(name)
        return early.intersect(late) if kind == "intersect" else early.subtract(late)


@query("last_snapshots", "SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 500")
def _(spark, d):
    return table(spark, d, "events").orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(500).select("event_id", "event_type")


@query("resource_summary", f"SELECT event_type AS metric, {six('min(value)')} AS min, {six('max(value)')} AS max, {six('avg(value)')} AS mean, count(value) AS n FROM events GROUP BY 1")
def _(spark, d):
    return table(spark, d, "events").groupBy(F.col("event_type").alias("metric")).agg(F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.count("value").alias("n"))


# Scans and features ------------------------------------------------------------------


@query("pixels_every_tenth", f'WITH {PX} SELECT "row", col, {six("b08")} AS b08 FROM px WHERE "row" % 10 = 0 AND col % 10 = 0')
def _(spark, d):
    # The systematic sample is the feature: every tenth row and column.
    return pixel_grid(spark, d).filter("row % 10 = 0 AND col % 10 = 0").select("row", "col", "b08")


@query("nodata_to_null", f'WITH {PX} SELECT "row", col, CASE WHEN scl <> 5 THEN {six("b04")} END AS b04 FROM px')
def _(spark, d):
    g = pixel_grid(spark, d).withColumn("b04", F.when(F.col("scl") == 5, F.lit(-9999.0)).otherwise(F.col("b04")))
    return null_if(g, ["b04"]).select("row", "col", "b04")


@query("dem_check", f"""WITH {PX} SELECT count(*) AS cells, count(elevation) AS valid, {six("count(elevation) * 100 / count(*)")} AS completeness, {six("min(elevation)")} AS min, {six("max(elevation)")} AS max,
concat_ws(';', CASE WHEN min(elevation) < -500 THEN 'low' END, CASE WHEN max(elevation) > 10000 THEN 'high' END) AS warnings FROM px""")
def _(spark, d):
    return features.dem_check(pixel_grid(spark, d), "elevation")


@query("k_best", f"""WITH {PX}, v AS ({" UNION ALL ".join(f"SELECT '{b}' AS feature, var_pop({b}) AS variance FROM px" for b in BANDS)}) SELECT feature, {six("variance")} AS variance FROM v ORDER BY v.variance DESC, feature LIMIT 4""")
def _(spark, d):
    return features.k_best(pixel_grid(spark, d), BANDS, 4)


@query("drop_missing_rows", f'WITH {PX} SELECT "row", col, {six("b04")} AS b04, {six("b08")} AS b08 FROM px WHERE scl NOT IN (5, 6)')
def _(spark, d):
    g = pixel_grid(spark, d).withColumns({"b04": F.when(F.col("scl") != 5, F.col("b04")), "b08": F.when(F.col("scl") != 6, F.col("b08"))})
    return features.complete_rows(g, ["b04", "b08"]).select("row", "col", "b04", "b08")


for _policy, _fill in {"constant": "coalesce(v, -1)", "mean": "coalesce(v, (SELECT avg(v) FROM h))", "invalidate": "CASE WHEN v IS NOT NULL AND w IS NOT NULL THEN v END"}.items():

    @query(f"missing_{_policy}", f"""WITH {PX}, h AS (SELECT "row", col, CASE WHEN scl <> 5 THEN b04 END AS v, CASE WHEN scl <> 6 THEN b08 END AS w FROM px) SELECT "row", col, {six(_fill)} AS b04 FROM h""")
    def _(spark, d, policy=_policy):
        g = pixel_grid(spark, d).withColumns({"b04": F.when(F.col("scl") != 5, F.col("b04")), "b08": F.when(F.col("scl") != 6, F.col("b08"))})
        return features.fill_missing(g, ["b04", "b08"], policy, -1.0).select("row", "col", "b04")


@query("elbow_differences", f"""WITH {PX}, c AS (SELECT scl AS k, sum((b04 - m) * (b04 - m)) AS inertia FROM (SELECT scl, b04, avg(b04) OVER (PARTITION BY scl) AS m FROM px) GROUP BY scl),
f AS (SELECT *, lag(inertia) OVER w - inertia AS fall FROM c WINDOW w AS (ORDER BY k)) SELECT k, {six("inertia")} AS inertia, {six("fall")} AS fall, {six("fall / nullif(lag(fall) OVER (ORDER BY k), 0)")} AS ratio FROM f""")
def _(spark, d):
    g = pixel_grid(spark, d).withColumn("m", F.avg("b04").over(Window.partitionBy("scl")))
    curve = g.groupBy(F.col("scl").alias("k")).agg(F.sum((F.col("b04") - F.col("m")) * (F.col("b04") - F.col("m"))).alias("inertia"))
    return models.elbow_differences(curve)


# Names, numbers, bands ---------------------------------------------------------------


@query("clean_names", r"SELECT page_id, regexp_replace(url, '[^A-Za-z0-9_\-]', '_', 'g') AS name FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", naming.clean_name(F.col("url")).alias("name"))


_FEATURES = ["band_4_glcm_contrast_d1_a0", "band_8_gabor_f1", "b3_lbp_24", "b3_stat_mean", "slope_scale_2", "iron_index", "moisture", "Elevation"]
_FEATURE_SQL = "[" + ", ".join(f"'{f}'" for f in _FEATURES) + f"][p_partkey % {len(_FEATURES)} + 1]"


@query("feature_names", f"""WITH n AS (SELECT p_partkey AS k, {_FEATURE_SQL} AS name FROM part) SELECT k, name,
CASE WHEN contains(name, 'glcm') THEN 'glcm' WHEN contains(name, 'gabor') THEN 'gabor' WHEN contains(name, 'lbp') THEN 'lbp' WHEN contains(name, 'stat') THEN 'statistical' ELSE 'unknown' END AS method,
CASE WHEN regexp_matches(lower(name), 'band|ndvi|ndwi|spectral|reflectance') THEN 'Spectral' WHEN regexp_matches(lower(name), 'elevation|slope|aspect|curvature|tpi') THEN 'Topographic'
  WHEN regexp_matches(lower(name), 'texture|glcm|contrast|homogeneity') THEN 'Texture' WHEN regexp_matches(lower(name), 'ratio|index|derived') THEN 'Derived' ELSE 'Other' END AS "group",
try_cast(nullif(regexp_extract(name, '([0-9]+)', 1), '') AS integer) AS number FROM n""")
def _(spark, d):
    name = F.array(*map(F.lit, _FEATURES))[(F.col("p_partkey") % len(_FEATURES)).cast("int")]
    n = table(spark, d, "part").select(F.col("p_partkey").alias("k"), name.alias("name"))
    at = F.col("name")
    return n.select("k", "name", naming.method_of(at).alias("method"), naming.group_of(at).alias("group"), naming.band_number(at).alias("number"))


@query("method_stats", f"""WITH n AS (SELECT {_FEATURE_SQL} AS name, p_size::double AS v FROM part), m AS (SELECT CASE WHEN contains(name, 'glcm') THEN 'glcm' WHEN contains(name, 'gabor') THEN 'gabor' WHEN contains(name, 'lbp') THEN 'lbp' WHEN contains(name, 'stat') THEN 'statistical' ELSE 'unknown' END AS method, v FROM n)
SELECT method, count(*) AS n, {six("avg(v)")} AS mean, {six("stddev_pop(v)")} AS std, {six("min(v)")} AS min, {six("max(v)")} AS max FROM m GROUP BY method""")
def _(spark, d):
    name = F.array(*map(F.lit, _FEATURES))[(F.col("p_partkey") % len(_FEATURES)).cast("int")]
    n = table(spark, d, "part").select(naming.method_of(name).alias("method"), F.col("p_size").cast("double").alias("v"))
    return n.groupBy("method").agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))


@query("score_grades", """SELECT k, CASE WHEN s >= 0.9::double THEN 'excellent' WHEN s >= 0.8::double THEN 'good' WHEN s >= 0.7::double THEN 'fair' WHEN s >= 0.6::double THEN 'poor' ELSE 'very poor' END AS grade,
CASE WHEN t BETWEEN 0 AND 1 THEN printf('%.3f', t) ELSE printf('%.2f', t) END AS text, printf('%.1f%%', s * 100) AS pct FROM (SELECT p_partkey AS k, p_size / 50 AS s, p_size / 16 AS t FROM part)""")
def _(spark, d):
    s, t = F.col("p_size") / 50, F.col("p_size") / 16
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), naming.grade(s).alias("grade"), naming.number_text(t).alias("text"), naming.percent_text(s * 100).alias("pct"))


@query("date_iso", """SELECT p_partkey AS k, try_cast(replace(replace(x, 'T', ' '), 'Z', '') AS timestamp) IS NOT NULL AS valid, epoch(try_cast(replace(replace(x, 'T', ' '), 'Z', '') AS timestamp))::bigint AS seconds
FROM (SELECT p_partkey, (2000 + p_size % 20) || '-' || lpad((p_size % 14)::varchar, 2, '0') || '-15T' || lpad((p_size % 24)::varchar, 2, '0') || ':30:00Z' AS x FROM part)""")
def _(spark, d):
    size = F.col("p_size")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    text = F.concat((2000 + size % 20).cast("string"), F.lit("-"), two(size % 14), F.lit("-15T"), two(size % 24), F.lit(":30:00Z"))
    at = masks.iso_time("x")
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), text.alias("x")).select("k", at.isNotNull().alias("valid"), F.unix_seconds(at).alias("seconds"))


@query("landsat_ndvi", f'WITH {PX} SELECT "row", col, {six("(b08 - b04) / nullif(b08 + b04, 0)")} AS value FROM px')
def _(spark, d):
    names = {SENSORS["sentinel2"][k]: v for k, v in SENSORS["landsat8"].items()}
    return pixel_grid(spark, d).withColumnsRenamed(names).select("row", "col", spectral_index("NDVI", "landsat8").alias("value"))


@query("generic_ndvi", f'WITH {PX} SELECT "row", col, {six("(b08 - b04) / nullif(b08 + b04, 0)")} AS value FROM px')
def _(spark, d):
    names = {SENSORS["sentinel2"][k]: v for k, v in SENSORS["generic"].items()}
    return pixel_grid(spark, d).withColumnsRenamed(names).select("row", "col", spectral_index("NDVI", "generic").alias("value"))


@query("expression_functions", f"""WITH {PX} SELECT "row", col, {six("sqrt(abs(b04 - b08)) + ln(b02 + 1) + log10(b03 + 10) + exp(-b04)")} AS a, {six("sin(b04) * cos(b08) + tan(b11 / 2)")} AS b, {six("asin(least(b04, 1)) + acos(least(b08, 1)) + atan(b12)")} AS c,
{six("CASE WHEN 0.1::double < b04 AND b04 < 0.25::double THEN greatest(b02, b03) ELSE least(b02, b03) END")} AS d, {six("pow(b08, 2) - (-b04) + greatest(least(b11, 0.3::double), 0.2::double)")} AS e FROM px""")
def _(spark, d):
    formulas = {
        "a": "sqrt(abs(b04 - b08)) + log(b02 + 1) + log10(b03 + 10) + exp(-b04)", "b": "sin(b04) * cos(b08) + tan(b11 / 2)", "c": "arcsin(min(b04, 1)) + arccos(min(b08, 1)) + arctan(b12)",
        "d": "where(0.1 < b04 < 0.25, max(b02, b03), min(b02, b03))", "e": "b08 ** 2 - (-b04) + clip(b11, 0.2, 0.3)",
    }
    return band_math(pixel_grid(spark, d), formulas).select("row", "col", *formulas)


@query("multi_file_bands", f'WITH {PX} SELECT a."row", a.col, {six("(a.b08 - b.b08) / nullif(a.b08 + b.b08, 0)")} AS change FROM px a JOIN px b ON b."row" = a."row" AND b.col = 49 - a.col')
def _(spark, d):
    g = pixel_grid(spark, d)
    files = [g.select("row", "col", "b08"), g.select("row", (49 - F.col("col")).alias("col"), "b08")]
    return band_math(features.prefixed(files), {"change": "(F0_b08 - F1_b08) / (F0_b08 + F1_b08)"}).select("row", "col", "change")


# Ground ------------------------------------------------------------------------------


@query("ground_measures", f"""WITH {PX}, g AS (SELECT "row", col, 27.6::double + "row" / 100 AS lat, 85.3::double + col / 100 AS lon FROM px),
h AS (SELECT *, 2 * 6371.0::double * asin(sqrt(cos(radians(lat)) * cos(radians(lat)) * pow(sin(radians(0.02::double) / 2), 2))) AS w, 2 * 6371.0::double * asin(sqrt(pow(sin(radians(0.01::double) / 2), 2))) AS t FROM g)
SELECT "row", col, {six("w * t")} AS area_km2, {six("sqrt(col * col + \"row\" * \"row\")")} AS distance, (CASE WHEN lat - 28 >= 0 THEN 32600 ELSE 32700 END + floor((lon + 180) / 6) + 1)::int AS epsg, {six("0.0001::double * 111320.0::double * (col + 1)")} AS pixel_m FROM h""")
def _(spark, d):
    lat, lon = F.lit(27.6) + F.col("row") / 100, F.lit(85.3) + F.col("col") / 100
    zero = F.lit(0.0)
    return pixel_grid(spark, d).select(
        "row", "col", geo.box_area_km2(lon, lat, lon + 0.02, lat + 0.01).alias("area_km2"), geo.euclidean(zero, zero, F.col("col"), F.col("row")).alias("distance"),
        geo.utm_epsg(lon, lat - 28).cast("int").alias("epsg"), (geo.pixel_metres(F.lit(0.0001)) * (F.col("col") + 1)).alias("pixel_m"),
    )


@query("point_buffer", f"""WITH {PX}, c AS (SELECT col::double AS cx, "row"::double AS cy FROM px WHERE scl = 9 AND b04 > 0.25::double) SELECT "row", col, count(*) AS centres FROM px JOIN c ON sqrt((col - cx) * (col - cx) + ("row" - cy) * ("row" - cy)) <= 2.5::double GROUP BY "row", col""")
def _(spark, d):
    g = pixel_grid(spark, d)
    points = g.select("row", "col", F.col("col").cast("double").alias("x"), F.col("row").cast("double").alias("y"))
    centres = g.filter((F.col("scl") == 9) & (F.col("b04") > 0.25)).select(F.col("col").cast("double").alias("cx"), F.col("row").cast("double").alias("cy"))
    return geo.within(points, centres, 2.5).groupBy("row", "col").agg(F.count("*").alias("centres"))


@query("scene_accuracy", f"""SELECT k, {six("sqrt(x * x + y * y)")} AS rmse, {six("sqrt(x * x + y * y) * 1.645::double")} AS ce90 FROM (SELECT l_partkey AS k, avg(l_discount) AS x, avg(l_tax) AS y FROM lineitem GROUP BY 1)""")
def _(spark, d):
    s = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("k")).agg(F.avg("l_discount").alias("x"), F.avg("l_tax").alias("y"))
    return s.select("k", *[c.alias(n) for n, c in geo.displacement(F.col("x"), F.col("y")).items()])


_SCENES = "SELECT p_partkey::varchar AS name, (10 + p_size)::double AS resolution, (100 + p_partkey % 37)::bigint AS width, (50 + p_partkey % 41)::bigint AS height FROM part"
for _rule, _key in {"auto": "abs(resolution - (SELECT avg(resolution) FROM s))", "highest": "resolution", "largest": "-width * height"}.items():

    @query(f"reference_scene_{_rule}", f"WITH s AS ({_SCENES}) SELECT name, resolution, width, height FROM s ORDER BY {_key}, name LIMIT 1")
    def _(spark, d, rule=_rule):
        k = F.col("p_partkey")
        scenes = table(spark, d, "part").select(k.cast("string").alias("name"), (10 + F.col("p_size")).cast("double").alias("resolution"), (100 + k % 37).cast("long").alias("width"), (50 + k % 41).cast("long").alias("height"))
        return geo.reference_scene(scenes, rule)


# Spectra -----------------------------------------------------------------------------

_WAVES = [490.0, 560.0, 665.0, 842.0, 1610.0, 2190.0]


@query("spectral_second_derivatives", f"""WITH {PX}, s AS (SELECT "row", col, [b02, b03, b04, b08, b11, b12] AS v, {_WAVES}::double[] AS w FROM px),
f AS (SELECT "row", col, w, list_concat(list_concat([0.0::double], [(v[i + 1] - v[i - 1]) / (w[i + 1] - w[i - 1]) for i in range(2, 6)]), [0.0::double]) AS f FROM s),
g AS (SELECT "row", col, [(f[i + 1] - f[i - 1]) / (w[i + 1] - w[i - 1]) for i in range(2, 6)] AS g FROM f) SELECT "row", col, {six("list_min(g) * 1000")} AS least, {six("list_max(g) * 1000")} AS most FROM g""")
def _(spark, d):
    g = spectral.second_derivative(F.array(*BANDS), _WAVES)
    return pixel_grid(spark, d).select("row", "col", (F.array_min(g) * 1000).alias("least"), (F.array_max(g) * 1000).alias("most"))


#: A made spectrum of 41 bands from 400 to 2400 nm out of a pixel's own bands.
_FINE = [400.0 + 10 * k for k in range(201)]


@query("mineral_maps", f"""WITH {PX}, s AS (SELECT "row", col, [b04 + b08 * sin(i * b11) / 4 + 1 for i in range(0, 201)] AS v FROM px)
SELECT "row", col, {", ".join(f"{six(spectral.mineral_sql(m, _FINE, 'v'))} AS {m}" for m in spectral.MINERALS)} FROM s""")
def _(spark, d):
    bands = F.transform(F.sequence(F.lit(0), F.lit(200)), lambda i: F.col("b04") + F.col("b08") * F.sin(i * F.col("b11")) / 4 + 1)
    s = pixel_grid(spark, d).withColumn("v", bands)
    return s.select("row", "col", *[spectral.mineral(m, F.col("v"), _FINE).alias(m) for m in spectral.MINERALS])


# Processes ---------------------------------------------------------------------------

_U = "(('0x' || substr(md5('42:' || {key}), 1, 13))::bigint::double / 4503599627370496::double)"
_AREA = """cells AS (SELECT (k // {cols})::int AS "row", (k % {cols})::int AS col FROM (SELECT unnest(range({rows} * {cols})) AS k) t)"""
_DEM_SQL = f"""WITH {_AREA.format(rows=55, cols=111)} SELECT "row", col, {six(f'''1000 + 500 * sin(col * 10.0::double / 110 * 0.5) * cos("row" * 10.0::double / 54 * 0.3) + 200 * sin(col * 10.0::double / 110 * 1.2) + 300 * cos("row" * 10.0::double / 54 * 0.8) + 100 * {_U.format(key="row || ':' || col").replace("row ||", '"row" ||')}''')} AS elevation FROM cells"""


@query("mock_dem", _DEM_SQL)
def _(spark, d):
    return steps.mock_dem(spark, [85.0, 27.0, 85.1, 27.05], 100)


def _band_sql(k: int) -> str:
    u, v = (_U.format(key=f"\"row\" || ':' || col || ':{k}{side}'") for side in "ab")
    return f"""trunc(greatest(least((sin(col * 5.0::double / 110) * cos("row" * 5.0::double / 54) * 0.3::double + 0.5::double + sqrt(-2 * ln(greatest({u}, 1e-12))) * cos({v} * 6.283185307179586::double) * 0.1::double) * ({0.8 + k * 0.1}::double) * 4000, 4000.0::double), 0.0::double))::int"""


@query("mock_imagery", f"""WITH {_AREA.format(rows=55, cols=111)} SELECT "row", col, {", ".join(f"{_band_sql(k)} AS {b}" for k, b in enumerate(("b02", "b03", "b04", "b08")))} FROM cells""")
def _(spark, d):
    return steps.mock_imagery(spark, [85.0, 27.0, 85.1, 27.05], 100)


@query("band_selection", f'WITH {PX} SELECT "row", col, {six("b08")} AS b08, {six("b04")} AS b04 FROM px')
def _(spark, d):
    return steps.selected(pixel_grid(spark, d), ["b08", "4"])


#: Zone statistics of clear pixels as a declared process.
ZONAL_PROCESS = {
    "process_info": {"name": "zonal statistics"},
    "global_config": {"default_values": {"thresholds": [0.2, 0.3, 0.4], "with_report": False}},
    "steps": [
        {"id": "statistics", "type": "zone_statistics", "inputs": {"scores": {"source": "index", "key": "ndvi"}}, "hyperparameters": {"score": "ndvi", "thresholds": "{thresholds}"}},
        {"id": "index", "type": "spectral_indices", "inputs": {"imagery": "clear"}, "hyperparameters": {"indices": ["NDVI"]}},
        {"id": "clear", "type": "filter", "inputs": {"scene": "scene"}, "hyperparameters": {"condition": "where(abs(scl - 9) > 1.5, abs(scl - 3) > 0.5, 1 < 0)"}},
        {"id": "scene", "type": "pixel_grid", "hyperparameters": {"path": "{path}"}},
        {"id": "report", "type": "inventory_generation", "inputs": {"all": {"sources": ["scene", "clear"], "aggregate": True}}, "condition": "with_report == true"},
    ],
}


@query("process_run", ORACLE_SQL["ndvi_zonal_stats"])
def _(spark, d):
    known = steps.register_steps(process.Registry())
    context = process.execute(process.load(ZONAL_PROCESS, {"path": d}), spark, {"with_report": False}, known)
    return context.results["statistics"]
