"""What bands and clusters stand for: wavelengths of bands, and words for clusters by their means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The middles of sensors' bands in nm, and the keywords of kinds of features, the first kind that fits.
BAND_CENTRES = {
    "sentinel2": [443, 490, 560, 665, 705, 740, 783, 842, 865, 945, 1375, 1610, 2190],
    "landsat8": [443, 482, 561, 655, 865, 1609, 2201],
}
INDICATORS = {
    "spectral": ["ndvi", "ndwi", "savi", "evi", "band", "reflectance"],
    "topographic": ["elevation", "slope", "aspect", "curvature", "tpi", "tri"],
    "geophysical": ["magnetic", "gravity", "radiometric", "conductivity"],
    "geochemical": ["au", "cu", "pb", "zn", "ag", "fe", "al", "si", "k", "ca"],
    "structural": ["lineament", "fault", "fracture", "distance"],
    "alteration": ["clay", "iron", "carbonate", "sericite", "chlorite"],
}


def wavelengths(bands: int, tags: dict[str, str] | None = None, sensor: str = "generic", centres: list[float] | None = None) -> list[float]:
    """Those that are given, else those in the file's tags, else the sensor's, else even steps from 400 to 2500 nm."""
    if centres is not None:
        return list(centres)
    try:
        if tags and "wavelengths" in tags:
            return [float(w) for w in tags["wavelengths"].split(",")]
    except ValueError:
        pass  # a tag that isn't numbers says nothing
    if sensor in BAND_CENTRES:
        return [float(w) for w in BAND_CENTRES[sensor]]
    return [400.0] if bands == 1 else [400 + 2100 * k / (bands - 1) for k in range(bands)]


def kinds(features: list[str]) -> dict[str, list[str]]:
    """Features by the first kind one of whose keywords they contain."""
    out: dict[str, list[str]] = {}
    for f in features:
        kind = next((k for k, words in INDICATORS.items() if any(w in f.lower() for w in words)), None)
        if kind:
            out.setdefault(kind, []).append(f)
    return out


def graded(value: Column, high: float, low: float, words: tuple[str, str, str]) -> Column:
    """One of three words: above, between, below."""
    return F.when(value > high, words[0]).when(value < low, words[2]).when(value.isNotNull(), words[1])


def signatures(profile: DataFrame, cluster: str, features: list[str]) -> DataFrame:
    """(cluster, signature, targets) from a row for each cluster with ``<feature>_mean`` and ``<feature>_std``."""
    by = kinds(features)
    mean = lambda f: F.col(f"{f}_mean")
    parts: list[Column] = []
    topographic = by.get("topographic", [])
    for name, high, low, words in (
        ("elevation", 1000, 500, ("high elevation", "moderate elevation", "low elevation")), ("slope", 30, 5, ("steep terrain", "moderate slopes", "flat terrain")),
    ):
        if name in [f.lower() for f in topographic]:
            parts.append(graded(mean(next(f for f in topographic if name in f.lower())), high, low, words))
    green = [f for f in by.get("spectral", []) if "ndvi" in f.lower()]
    if green:
        parts.append(graded(mean(green[0]), 0.5, 0.1, ("dense vegetation", "moderate vegetation", "sparse vegetation/bare rock")))
    if by.get("geochemical"):
        raised = F.filter(F.array(*[F.when(mean(f) > F.col(f"{f}_std"), f) for f in by["geochemical"]]), lambda x: x.isNotNull())
        parts.append(F.when(F.size(raised) > 0, F.concat(F.lit("elevated "), F.array_join(F.slice(raised, 1, 3), ", "))))
    said = F.array_compact(F.array(*parts)) if parts else F.array().cast("array<string>")
    targets = [t for t, has in (("hydrothermal alteration zone", "geochemical" in by and "alteration" in by), ("structural control zone", "structural" in by)) if has]
    return profile.select(
        F.col(cluster).alias("cluster"), F.when(F.size(said) > 0, F.array_join(said, "; ")).otherwise("undefined signature").alias("signature"),
        F.lit(", ".join(targets or ["background/host rock"])).alias("targets"),
    )
