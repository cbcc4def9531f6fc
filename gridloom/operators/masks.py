"""Masks, coverage and radiometric correction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.models import kmeans
from gridloom.plans.quantiles import exact_quantiles

# Scene classes by their part in a mask.
CLOUD, SHADOW, SATURATED, SNOW = (8, 9, 10), (3,), (1,), (11,)


def scene_mask(scl: Column, conservative: bool = False, keep_bright: bool = True) -> Column:
    """Cloud and shadow; a conservative mask adds saturated pixels, and snow unless bright surfaces are kept."""
    classes = CLOUD + SHADOW + ((SATURATED + (() if keep_bright else SNOW)) if conservative else ())
    return scl.isin(*classes)


def with_stats(df: DataFrame, **stats: Column) -> DataFrame:
    """Every row beside one row of global statistics."""
    return df.crossJoin(F.broadcast(df.agg(*[c.alias(n) for n, c in stats.items()])))


def valid_pixels(bands: list[str]) -> Column:
    """Pixels whose bands are all positive."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.col(b) > 0, F.lit(False)) for b in bands])


def over_valid(df: DataFrame, valid: Column, least: int, wanted: dict[str, tuple[str, float]]) -> dict[str, Column] | None:
    """Exact quantiles over the valid pixels; None unless there are more than ``least`` of them."""
    pixels = df.filter(valid)
    if pixels.count() <= least:
        return None
    return {name: F.lit(value) for name, value in exact_quantiles(pixels, wanted).items()}


def marked(df: DataFrame, valid: Column, cloud: Column | None, shadow: Column | None) -> DataFrame:
    return df.withColumns({n: F.lit(False) if c is None else valid & F.coalesce(c, F.lit(False)) for n, c in (("cloud", cloud), ("shadow", shadow))})


def threshold_mask(df: DataFrame, blue: str, green: str, red: str, nir: str, cloud: float = 0.1, shadow: float = 0.05, least: int = 1000) -> DataFrame:
    """Cloud above a part of the brightness' 95th percentile, shadow below a bit more than its 5th, over valid pixels;
    nothing is marked where they are ``least`` or fewer. Brightness is the mean of the four bands."""
    bands = [blue, green, red, nir]
    d = df.withColumn("brightness", sum((F.col(b) for b in bands), F.lit(0.0)) / 4)
    valid = valid_pixels(bands)
    q = over_valid(d, valid, least, {"high": ("brightness", 0.95), "low": ("brightness", 0.05)})
    bright = F.col("brightness")
    return marked(d, valid, q and bright > q["high"] * cloud, q and bright < q["low"] * (1 + shadow)).drop("brightness")


def spectral_mask(df: DataFrame, blue: str, green: str, red: str, nir: str, swir: str, least: int = 1000) -> DataFrame:
    """Cloud by snow index, brightness of four bands or blue; shadow where visible and near infrared are dark, over
    valid pixels; nothing is marked where they are ``least`` or fewer."""
    bands = [blue, green, red, nir]
    d = df.withColumn("brightness", sum((F.col(b) for b in bands), F.lit(0.0)) / 4)
    d = d.withColumn("visible", sum((F.col(b) for b in bands[:3]), F.lit(0.0)) / 3)
    valid = valid_pixels(bands)
    q = over_valid(d, valid, least, {"bright": ("brightness", 0.95), "blue": (blue, 0.9), "dark": ("visible", 0.1), "nir": (nir, 0.2)})
    snow = F.coalesce(F.try_divide(F.col(green) - F.col(swir), F.col(green) + F.col(swir)), F.lit(0.0))
    cloud = q and (snow > 0.4) | (F.col("brightness") > q["bright"] * 0.8) | (F.col(blue) > q["blue"])
    return marked(d, valid, cloud, q and (F.col("visible") < q["dark"]) & (F.col(nir) < q["nir"])).drop("brightness", "visible")


def cluster_mask(df: DataFrame, cluster: str, bands: list[str], smallest: int = 100) -> DataFrame:
    """Of the clusters of more than ``smallest`` pixels, the two brightest are cloud where they are a fifth brighter
    than the clusters' mean, and the two darkest shadow where they are a fifth darker."""
    bright = sum((F.avg(b) for b in bands), F.lit(0.0)) / len(bands)
    every = Window.partitionBy()
    stats = df.groupBy(cluster).agg(F.count("*").alias("__n"), bright.alias("__b")).filter(F.col("__n") > smallest)
    ranked = stats.withColumns({
        "__up": F.row_number().over(Window.orderBy(F.col("__b").desc(), F.col(cluster).desc())),
        "__down": F.row_number().over(Window.orderBy("__b", cluster)),
        "__mean": F.avg("__b").over(every),
    })
    kinds = ranked.select(
        cluster, ((F.col("__up") <= 2) & (F.col("__b") > F.col("__mean") * 1.2)).alias("cloud"), ((F.col("__down") <= 2) & (F.col("__b") < F.col("__mean") * 0.8)).alias("shadow")
    )
    joined = df.join(F.broadcast(kinds), cluster, "left")  # a row for each cluster
    return joined.withColumns({n: F.coalesce(n, F.lit(False)) for n in ("cloud", "shadow")})


def kmeans_mask(df: DataFrame, bands: list[str], clusters: int = 8, seed: int = 42, least: int = 1000) -> DataFrame:
    """Clusters of the valid pixels by brightness; as many as there are hundreds of pixels, ``clusters`` at most."""
    valid = valid_pixels(bands)
    pixels = df.filter(valid)
    n = pixels.count()
    if n <= least:
        return marked(df, valid, None, None)
    found = cluster_mask(kmeans(pixels, bands, min(clusters, n // 100), seed), "cluster", bands).select("row", "col", "cloud", "shadow")
    joined = df.join(found, ["row", "col"], "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("cloud", "shadow")})


def apply_mask(df: DataFrame, mask: Column, bands: list[str]) -> DataFrame:
    return df.withColumns({b: F.when(~mask, F.col(b)) for b in bands})


def coverage(df: DataFrame, cloud: Column, shadow: Column) -> DataFrame:
    """Shares in percent and a rating of the scene."""
    share = lambda c: F.avg(c.cast("int")) * 100
    out = df.agg(share(cloud).alias("cloud_pct"), share(shadow).alias("shadow_pct"), share(cloud | shadow).alias("masked_pct"))
    m = F.col("masked_pct")
    rating = F.when(m < 5, "excellent").when(m < 15, "good").when(m < 30, "fair").otherwise("poor")
    return out.withColumn("usable_pct", 100 - m).withColumn("rating", rating)


def dark_object(
    df: DataFrame, bands: list[str], percent: float = 0.01, valid: tuple[float, float] = (0.0, 32767.0), least: int = 100,
    factor: float = 1.0, divisor: float = 10000.0, scale: float = 10000.0, untouched: bool = True,
) -> DataFrame:
    """Each band less its dark percentile over valid values, as reflectance between 0 and 1, times scale, as whole
    numbers. A band with ``least`` valid values or fewer stays as it is, or (not untouched) only loses no dark value."""
    inside = {b: (F.col(b) > valid[0]) & (F.col(b) < valid[1]) for b in bands}
    counts = df.agg(*[F.count_if(inside[b]).alias(b) for b in bands]).first()
    enough = [b for b in bands if counts[b] > least]
    d = df.withColumns({f"__{b}": F.when(inside[b], F.col(b) * factor) for b in enough})
    dark = exact_quantiles(d, {b: (f"__{b}", percent) for b in enough}) if enough else {}
    fixed = {}
    for b in bands:
        value = F.col(b) * factor
        if b in enough:
            value = F.greatest(value - dark[b], F.lit(0.0))
        elif untouched:
            fixed[b] = F.col(b).cast("int")
            continue
        fixed[b] = (F.greatest(F.least(value / divisor, F.lit(1.0)), F.lit(0.0)) * scale).cast("int")
    return df.withColumns(fixed)


def sen2cor_like(df: DataFrame, bands: list[str], scale: float = 10000.0) -> DataFrame:
    """Digital numbers to reflectance, dark object subtraction where more than 1000 values are valid, and back."""
    return dark_object(df, bands, 0.01, (0.0, 10000.0), 1000, 0.0001, 1.0, scale, untouched=False)


#: Corrections by name; those that need outside programs are the simple one.
CORRECTIONS = {"sen2cor": sen2cor_like, "dos": dark_object, "simple": dark_object, "flaash": dark_object, "6s": dark_object, "atcor": dark_object}


def clip_box(df: DataFrame, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    return df.filter(F.col("row").between(*rows) & F.col("col").between(*cols))


def box_errors(west: str, south: str, east: str, north: str) -> Column:
    """What is wrong with a bounding box in degrees, joined by semicolons; empty if nothing is."""
    w, s, e, n = (F.col(c) for c in (west, south, east, north))
    return F.concat_ws(
        ";", F.when((w < -180) | (e > 180), "longitude"), F.when((s < -90) | (n > 90), "latitude"), F.when((w >= e) | (s >= n), "order")
    )


def valid_date(text: str) -> Column:
    """Whether a text is a date as yyyy-mm-dd from 1970 on."""
    parsed = F.try_to_timestamp(F.col(text), F.lit("yyyy-MM-dd"))
    return parsed.isNotNull() & (F.coalesce(F.year(parsed), F.lit(0)) >= 1970)


def iso_time(text: str) -> Column:
    """The time of a text as yyyy-mm-ddThh:mm:ss, with or without a Z, in UTC; NULL if it is none."""
    return F.try_to_timestamp(F.regexp_replace(F.col(text), "Z$", ""), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
