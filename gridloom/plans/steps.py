"""The engine's operators as steps of a declared process.

A step gets the session, its input frames by name (a list where several steps feed one input)
and its hyperparameters; those it doesn't know are ignored. Remote imagery and elevation
services are not part of the engine: their steps make the imagery and elevation of an area.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.bandmath import INDICES, SENSORS, band_math, spectral_index
from gridloom.functions.naming import chosen_bands
from gridloom.operators import features, masks, models, predictions, surface, terrain, texture
from gridloom.operators.validation import hash_number
from gridloom.plans.process import Registry, registry
from gridloom.sources import grid

# Metres of a degree in made imagery and elevation, and sides of made areas in cells.
IMAGERY_DEGREE, DEM_DEGREE, IMAGERY_SIDES, DEM_SIDE = 111_319, 111_320, (50, 500), 512


def cells(spark: SparkSession, rows: int, cols: int) -> DataFrame:
    k = F.col("id")
    return spark.range(rows * cols).select(F.floor(k / cols).cast("int").alias("row"), (k % cols).cast("int").alias("col"))


def uniform(seed: int, *parts: Column | str) -> Column:
    """Between 0 and 1, the same in every run and on every engine."""
    return hash_number(F.lit(seed), *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts]) / float(1 << 52)


def mock_dem(spark: SparkSession, bbox: list[float], resolution: float = 30, seed: int = 42) -> DataFrame:
    """(row, col, elevation): hills, waves and some noise, at most 512 cells a side."""
    west, south, east, north = bbox
    cols, rows = (min(DEM_SIDE, max(1, int((b - a) * DEM_DEGREE / resolution))) for a, b in ((west, east), (south, north)))
    x, y = F.col("col") * 10.0 / max(1, cols - 1), F.col("row") * 10.0 / max(1, rows - 1)
    # Amplitudes and frequencies of the made surface.
    height = 1000 + 500 * F.sin(x * 0.5) * F.cos(y * 0.3) + 200 * F.sin(x * 1.2) + 300 * F.cos(y * 0.8) + 100 * uniform(seed, "row", "col")
    return cells(spark, rows, cols).withColumn("elevation", height)


def mock_imagery(spark: SparkSession, bbox: list[float], resolution: float = 10, bands: list[str] | None = None, seed: int = 42) -> DataFrame:
    """(row, col, bands): a pattern with normal noise and a gain for each band, whole numbers from 0 to 4000."""
    west, south, east, north = bbox
    low, high = IMAGERY_SIDES
    cols, rows = (max(low, min(high, int((b - a) * IMAGERY_DEGREE / resolution))) for a, b in ((west, east), (south, north)))
    # Pattern, gains and range of the made bands.
    base = F.sin(F.col("col") * 5.0 / (cols - 1)) * F.cos(F.col("row") * 5.0 / (rows - 1)) * 0.3 + 0.5
    out = {}
    for k, band in enumerate(bands or ["B02", "B03", "B04", "B08"]):
        u, v = (F.greatest(uniform(seed, "row", "col", F.lit(f"{k}{side}")), F.lit(1e-12)) for side in "ab")
        noise = F.sqrt(-2 * F.ln(u)) * F.cos(v * 6.283185307179586) * 0.1
        gain = 0.8 + k * 0.1 if k < 4 else 1.2 + k * 0.05
        out[band.lower()] = F.greatest(F.least((base + noise) * gain * 4000, F.lit(4000.0)), F.lit(0.0)).cast("int")
    return cells(spark, rows, cols).withColumns(out)


# Sensors of collections of imagery; others are the second level of Sentinel-2.
COLLECTIONS = {"SENTINEL-2-L2A": "sentinel2", "SENTINEL-2-L1C": "sentinel2", "LANDSAT-8": "landsat8", "LANDSAT-8-L1": "landsat8"}


def collection(name: str) -> str:
    return COLLECTIONS.get(name.upper().replace("_", "-"), "sentinel2")


def selected(df: DataFrame, bands: list[str]) -> DataFrame:
    """The cells with the bands asked for, in their order."""
    return df.select("row", "col", *chosen_bands([c for c in df.columns if c not in ("row", "col")], bands))


def only_known(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The function without the hyperparameters it doesn't take."""
    taken = inspect.signature(f).parameters
    if any(p.kind is p.VAR_KEYWORD for p in taken.values()):
        return f
    return lambda spark, **given: f(spark, **{k: v for k, v in given.items() if k in taken})


def frames_of(given: dict[str, Any]) -> dict[str, DataFrame]:
    """The data frames among the arguments, lists numbered."""
    out: dict[str, DataFrame] = {}
    for name, value in given.items():
        if isinstance(value, DataFrame):
            out[name] = value
        elif isinstance(value, list) and value and all(isinstance(x, DataFrame) for x in value):
            out |= {f"{name}_{k}": x for k, x in enumerate(value)}
    return out


def the_frame(given: dict[str, Any]) -> DataFrame:
    frames = list(frames_of(given).values())
    if len(frames) != 1:
        raise ValueError(f"the step takes one input, not {len(frames)}")
    return frames[0]


def with_indices(spark: SparkSession, indices: list[str] = ("NDVI",), sensor: str = "sentinel2", **given: Any) -> DataFrame:
    df = the_frame(given)
    has = set(df.columns)
    fit = [i for i in indices if i in INDICES and {b for k, b in SENSORS[sensor].items() if k in INDICES[i]} <= has]
    return df.select("row", "col", *[spectral_index(i, sensor).alias(i.lower()) for i in fit])


def harmonised(spark: SparkSession, **given: Any) -> DataFrame:
    """All grids among the inputs on the cells that they share, columns named by input."""
    grids = {n: f for n, f in frames_of(given).items() if {"row", "col"} <= set(f.columns)}
    named = [f.select("row", "col", *[F.col(c).alias(f"{n}_{c}") for c in f.columns if c not in ("row", "col")]) for n, f in grids.items()]
    return reduce(lambda a, b: a.join(b, ["row", "col"]), named)


def checked(spark: SparkSession, min_valid: float = 70.0, **given: Any) -> DataFrame:
    """Per input its rows, the share of values that are there in percent, and whether that is enough."""
    parts = []
    for name, df in sorted(frames_of(given).items()):
        there = sum((F.col(c).isNotNull().cast("int") for c in df.columns), F.lit(0))
        share = F.coalesce(F.avg(there / max(1, len(df.columns))) * 100, F.lit(0.0))
        parts.append(df.agg(F.lit(name).alias("input"), F.count("*").alias("rows"), share.alias("valid_pct")).withColumn("passed", F.col("valid_pct") >= min_valid))
    return reduce(DataFrame.unionByName, parts)


def listed(spark: SparkSession, **given: Any) -> DataFrame:
    """Per input its rows and columns."""
    parts = [df.agg(F.lit(n).alias("input"), F.count("*").alias("rows"), F.lit(",".join(df.columns)).alias("columns")) for n, df in sorted(frames_of(given).items())]
    return reduce(DataFrame.unionByName, parts)


def found_files(spark: SparkSession, search_paths: list[str] = (), base_path: str | None = None, file_patterns: list[str] = ("*",), max_files: int | None = None) -> DataFrame:
    """Files below the folders that there are, each once."""
    folders = [*search_paths, *([base_path] if base_path else [])]
    parts = []
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            parts += [grid.inventory(spark, folder, pattern) for pattern in file_patterns]
    if not parts:
        return spark.createDataFrame([], "path string, name string, extension string, size_bytes long, size_mb double, modified_time timestamp, file_type string")
    found = reduce(DataFrame.unionByName, parts).dropDuplicates(["path"])
    return found.orderBy("path").limit(max_files) if max_files else found


def cloud_mask(spark: SparkSession, method: str = "spectral_indices", **given: Any) -> DataFrame:
    df, s = the_frame(given), SENSORS["sentinel2"]
    if method == "scl":
        scl = F.col("scl")
        return df.withColumns({"cloud": scl.isin(*masks.CLOUD), "shadow": scl.isin(*masks.SHADOW)})
    four = [s["blue"], s["green"], s["red"], s["nir"]]
    if method == "threshold":
        return masks.threshold_mask(df, *four)
    if method == "ml_clustering":
        return masks.kmeans_mask(df, four)
    return masks.spectral_mask(df, *four, s["swir1"])  # also in place of fmask


def derivatives(spark: SparkSession, derivatives: list[str] = ("slope", "aspect"), **given: Any) -> DataFrame:
    df = the_frame(given)
    out = terrain.slope_aspect(df).drop("gx", "gy")
    if {"curvature", "plan", "profile"} & set(derivatives):
        out = terrain.curvatures(out).drop("gx", "gy")
    return out


def textures(spark: SparkSession, band: str = "b04", window_size: int = 9, **given: Any) -> DataFrame:
    df = the_frame(given)
    size = df.agg(F.max("row").alias("r"), F.max("col").alias("c")).first()
    return texture.statistical_texture(df, band, size["r"] + 1, size["c"] + 1, window_size)


def forest(spark: SparkSession, feature_columns: list[str], target: str, n_estimators: int = 100, max_depth: int = 5, random_state: int = 42, **given: Any) -> DataFrame:
    return models.random_forest(the_frame(given), feature_columns, target, n_estimators, max_depth, random_state)


def classes(spark: SparkSession, threshold: float = 0.5, score: str = "probability", **given: Any) -> DataFrame:
    df = the_frame(given).withColumn("__p", F.array(1 - F.col(score), F.col(score)))
    return predictions.class_layers(df, "__p")


def zones(spark: SparkSession, score: str = "probability", application_type: str = "landslide", **given: Any) -> DataFrame:
    df = the_frame(given)
    return df.withColumn("zone", surface.zone(F.col(score), surface.ZONES.get(application_type.split("_")[0], surface.ZONES["generic"])))


def uncertainty(spark: SparkSession, feature_columns: list[str], target: str, key: str, n_models: int = 10, n_estimators: int = 50, **given: Any) -> DataFrame:
    return models.ensemble(the_frame(given), feature_columns, target, key, n_models, n_estimators)


def register_steps(into: Registry = registry) -> Registry:
    """All steps, by category; steps that are there already stay."""
    steps: list[tuple[str, str, Callable[..., DataFrame], tuple[str, ...]]] = [
        ("sentinel_hub_acquisition", "data_acquisition", mock_imagery, ()),
        ("dem_acquisition", "data_acquisition", mock_dem, ()),
        ("local_files_discovery", "data_acquisition", found_files, ()),
        ("pixel_grid", "data_acquisition", lambda spark, path, **_: grid.pixel_grid(spark, path), ()),
        ("feature_file", "data_acquisition", lambda spark, path, **_: grid.read_features(spark, path), ()),
        ("atmospheric_correction", "preprocessing", lambda spark, bands, method="simple", **given: masks.CORRECTIONS[method](the_frame(given), bands), ()),
        ("cloud_masking", "preprocessing", cloud_mask, ()),
        ("apply_mask", "preprocessing", lambda spark, bands, mask="cloud", **given: masks.apply_mask(the_frame(given), F.col(mask), bands), ()),
        ("filter", "preprocessing", lambda spark, condition, **given: band_math(the_frame(given), {"__keep": f"where({condition}, 1, 0)"}).filter("__keep = 1").drop("__keep"), ()),
        ("spatial_resampling", "preprocessing", lambda spark, value, factor=2, method="average", **given: texture.downsample(the_frame(given), value, factor, method), ()),
        ("band_math", "preprocessing", lambda spark, operations, **given: band_math(the_frame(given), operations), ()),
        ("data_harmonization", "preprocessing", harmonised, ("feature_integration",)),
        ("spectral_indices_extraction", "feature_extraction", with_indices, ("spectral_indices_calculation", "spectral_indices")),
        ("topographic_derivatives", "feature_extraction", derivatives, ()),
        ("texture_analysis", "feature_extraction", textures, ()),
        ("scaling", "feature_extraction", lambda spark, columns, method="standard", **given: features.scale(the_frame(given), columns, method), ()),
        ("random_forest", "modeling", forest, ()),
        ("logistic_regression", "modeling", lambda spark, feature_columns, target, **given: models.logistic_table(the_frame(given), feature_columns, target), ()),
        ("kmeans_clustering", "modeling", lambda spark, feature_columns, n_clusters=5, random_state=42, **given: models.kmeans(the_frame(given), feature_columns, n_clusters, random_state), ()),
        ("model_validation", "modeling", lambda spark, feature_columns, target, key, cv_folds=5, **given: models.cross_validate(the_frame(given), feature_columns, target, key, cv_folds), ()),
        ("classification_prediction", "prediction", classes, ("multi_class_prediction", "susceptibility_prediction", "prospectivity_prediction")),
        ("probability_mapping", "prediction", zones, ("risk_mapping", "susceptibility_mapping", "prospectivity_mapping")),
        ("uncertainty_quantification", "prediction", uncertainty, ("confidence_analysis", "prediction_uncertainty")),
        ("zone_statistics", "prediction", lambda spark, score, thresholds, **given: surface.zone_stats(the_frame(given), score, thresholds), ()),
        ("data_validation", "report", checked, ()),
        ("inventory_generation", "report", listed, ()),
    ]
    for kind, category, f, aliases in steps:
        if kind not in into.operators:
            into.register(kind, category, aliases)(only_known(f))
    return into
