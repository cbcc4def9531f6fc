"""Grid sources: pixel tables keyed by (row, col), with missing values as NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BANDS = ["b02", "b03", "b04", "b08", "b11", "b12"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def null_if(df: DataFrame, columns: list[str], nodata: float = -9999.0) -> DataFrame:
    """NaN and the file's nodata value become NULL at the scan."""
    return df.withColumns({c: F.when(~F.isnan(c) & (F.col(c) != nodata), F.col(c)) for c in columns})


def fill_nodata(df: DataFrame, columns: list[str], nodata: float = -9999.0) -> DataFrame:
    """The opposite, at the sink."""
    return df.withColumns({c: F.coalesce(c, F.lit(nodata)) for c in columns})


def write_layers(df: DataFrame, columns: list[str], path: str) -> None:
    """One partition folder per layer, nodata filled."""
    named = ", ".join(f"'{c}', `{c}`" for c in columns)
    long = fill_nodata(df, columns).select("row", "col", F.expr(f"stack({len(columns)}, {named}) AS (layer, value)"))
    long.write.mode("overwrite").partitionBy("layer").parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """CSV, Parquet or JSON by suffix."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind == "csv":
        return spark.read.csv(path, header=True, inferSchema=True)
    if kind in ("parquet", "json"):
        return getattr(spark.read, kind)(path)
    raise ValueError(f"no reader for .{kind}")


def inventory(spark: SparkSession, folder: str, pattern: str = "*", most: int | None = None) -> DataFrame:
    """A record for each file below a folder; each file once. Contents aren't read."""
    files = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    found = files.select(
        "path", name.alias("name"), F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1)).alias("extension"),
        F.col("length").alias("size_bytes"), F.round(F.col("length") / 1048576, 2).alias("size_mb"), F.col("modificationTime").alias("modified_time"),
    ).withColumn("file_type", file_type(F.col("extension")))
    return found.orderBy("path").limit(most) if most else found


#: How files of some types begin: fixed values of their formats.
MAGIC = {
    ".tif": ["49492A00", "4D4D002A", "49492B00", "4D4D002B"], ".tiff": ["49492A00", "4D4D002A", "49492B00", "4D4D002B"], ".jp2": ["0000000C6A502020", "FF4FFF51"],
    ".hdf": ["0E031301", "894844460D0A1A0A"], ".nc": ["434446", "894844460D0A1A0A"], ".gpkg": ["53514C69746520666F726D6174203300"], ".parquet": ["50415231"],
}


def validated(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """The inventory with ``validation_error``: null, or that a file doesn't begin as files of its type do. Empty files
    are never taken: Spark's reader doesn't list them."""
    files = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(folder)
    head = files.select("path", F.hex(F.substring("content", 1, 16)).alias("__head"))
    right = reduce(lambda a, b: a | b, [(F.col("extension") == e) & F.col("__head").startswith(m) for e, begins in MAGIC.items() for m in begins])
    vector = (F.col("extension") == ".geojson") & F.col("__head").rlike("^(EFBBBF)?(20|09|0A|0D)*7B")
    known = F.col("extension").isin(*MAGIC, ".geojson")
    error = F.when(known & ~(right | vector), F.concat(F.lit("Invalid "), "file_type", F.lit(" file")))
    return inventory(spark, folder, pattern).join(head, "path", "left").withColumn("validation_error", error).drop("__head")


def digests(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, md5, sha256) of each file below a folder; a file is one row, so it is bounded by an executor's memory."""
    files = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(folder)
    return files.select("path", F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"))


def ring_moments(ring: Column) -> Column:
    """Twice the signed area of a closed ring of [x, y] corners, and six times its moments."""
    steps = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda p, q: F.struct(p[0].alias("a"), p[1].alias("b"), q[0].alias("c"), q[1].alias("d")))
    start = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    cross = lambda s: s["a"] * s["d"] - s["c"] * s["b"]
    add = lambda t, s: F.struct((t["w"] + cross(s)).alias("w"), (t["x"] + (s["a"] + s["c"]) * cross(s)).alias("x"), (t["y"] + (s["b"] + s["d"]) * cross(s)).alias("y"))
    return F.aggregate(steps, start, add)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """A table with x and y: of a CSV with such columns, or of GeoJSON, where polygons stand for their centroids (with
    holes) and properties are columns. Rows without a place have null x and y."""
    if path.lower().endswith(".csv"):
        return spark.read.csv(path, header=True, inferSchema=True)
    fields = "type string, geometry struct<type: string, coordinates: string>, properties map<string, string>"
    whole = spark.read.schema(f"type string, features array<struct<{fields}>>").json(path, multiLine=True)
    one = whole.select(F.explode("features").alias("f")).select("f.properties", F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("raw"))
    point, rings = F.from_json("raw", "array<double>"), F.from_json("raw", "array<array<array<double>>>")
    moments = F.aggregate(
        F.transform(F.when(F.col("kind") == "Polygon", rings), ring_moments), F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y")),
        lambda t, s: F.struct((t["w"] + s["w"]).alias("w"), (t["x"] + s["x"]).alias("x"), (t["y"] + s["y"]).alias("y")),
    )
    placed = one.withColumn("__m", moments).withColumn("__p", F.when(F.col("kind") == "Point", point))
    at = lambda k, c: F.coalesce(F.try_element_at("__p", F.lit(k)), F.try_divide(F.col("__m")[c], 3 * F.col("__m.w"))).alias(c)
    return placed.select(at(1, "x"), at(2, "y"), "properties")


def file_type(extension: Column) -> Column:
    return (
        F.when(extension.isin(".tif", ".tiff", ".img", ".jp2", ".hdf", ".nc"), "spatial")
        .when(extension.isin(".shp", ".geojson", ".gpkg", ".kml"), "vector")
        .when(extension.isin(".csv", ".json", ".parquet", ".xlsx", ".txt"), "data")
        .otherwise("other")
    )


def pixel_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid view: one pixel a part, 50 columns, bands from its line items.

    Sums are over whole numbers, so every engine and every order gives the same bands.
    """
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("k"),
        F.round("l_quantity").cast("long").alias("q"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("e"),
        F.round(F.col("l_tax") * 100).cast("long").alias("t"),
        F.round(F.col("l_discount") * 100).cast("long").alias("d"),
    )
    sums = items.groupBy("k").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(c) for c in "qetd"],
        F.sum(F.col("q") * F.col("q")).alias("q2"), F.sum(F.col("e") * F.col("e")).alias("e2"),
    )
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_size")
    return sums.join(parts, "k").selectExpr(
        "cast(floor(k / 50.0) as int) AS row", "cast(k % 50 as int) AS col",
        "q / n / 50 AS b02", "e / n / 100 / 100000 AS b03", "t / n / 100 * 5 + 0.05D AS b04", "d / n / 100 * 5 + 0.2D AS b08",
        "sqrt(n * q2 - q * q) / n / 50 AS b11", "sqrt(n * e2 - e * e) / n / 100 / 100000 AS b12",
        "e / n / 100 / 10 AS elevation", "cast(p_size % 12 as int) AS scl",
    )
