"""Predictions as layers: probabilities from scores, classes on the full grid, regions, GeoJSON rows, sinks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.plans.lineage import dropped, stored
from gridloom.plans.quantiles import exact_quantiles


#: Rows and columns of a tile that names its own pieces of regions.
SIDE = 128


def sigmoid(score: Column) -> Column:
    return 1 / (1 + F.exp(-score))


def softmax(scores: Column) -> Column:
    """An array of scores as probabilities."""
    raised = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def weighted_probability(probabilities: Column) -> Column:
    """Of ordered classes: each class' probability times its place between 0 and 1."""
    last = F.size(probabilities) - 1
    return F.aggregate(F.transform(probabilities, lambda p, k: p * k / last), F.lit(0.0), lambda a, x: a + x)


def probability(scores: Column, application: str, decision: bool = False) -> Column:
    """One probability from an array of class probabilities, or of decision scores: of two classes the second, of
    ordered risk classes the weighted one, else the largest."""
    p = softmax(scores) if decision else scores
    many = weighted_probability(p) if application in ("landslide_susceptibility", "mineral_targeting") and not decision else F.array_max(p)
    return F.when(F.size(scores) == 2, F.element_at(p, 2)).otherwise(many)


def on_grid(grid: DataFrame, found: DataFrame, layers: list[str], nodata: float = -9999.0) -> DataFrame:
    """Layers of some cells on the whole grid, others as nodata: a left join on the cell."""
    joined = grid.select("row", "col").join(found.select("row", "col", *layers), ["row", "col"], "left")
    return joined.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(nodata)) for c in layers})


def class_layers(df: DataFrame, probabilities: str) -> DataFrame:
    """(row, col, class, confidence, probability_k): the most likely class, of equals the first, and how sure it is."""
    p = F.col(probabilities)
    n = df.select(F.size(p).alias("n")).first()
    out = df.select("row", "col", (F.array_position(p, F.array_max(p)) - 1).cast("int").alias("class"), F.array_max(p).alias("confidence"), p.alias("__p"))
    return out.withColumns({f"probability_{k}": F.col("__p")[k] for k in range(n["n"] if n else 0)}).drop("__p")


def geojson(df: DataFrame, x: Column, y: Column, properties: list[str], confidence: str, least: float) -> DataFrame:
    """(row, col, feature): one GeoJSON feature for each sure enough prediction."""
    point = F.struct(F.lit("Point").alias("type"), F.array(x, y).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(*properties).alias("properties"))
    return df.filter(F.col(confidence) >= least).select("row", "col", F.to_json(feature).alias("feature"))


def tile_labels(tile: pa.Table) -> pa.Table:
    """A tile's cells with ``root``, the smallest cell of those that they touch inside the tile."""
    row, col, cell = (tile.column(c).to_numpy().astype(np.int64) for c in ("row", "col", "cell"))
    zones = tile.column("zone").combine_chunks()
    kind = pc.fill_null(zones.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
    order = np.argsort(cell, kind="stable")
    at = np.full((int(np.ptp(row)) + 2, int(np.ptp(col)) + 2), -1)  # the last row and column stay empty
    at[row[order] - row.min(), col[order] - col.min()] = np.arange(len(order))
    kind = kind[order]
    sides = [(at[:, :-1], at[:, 1:]), (at[:-1], at[1:])]
    a, b = (np.concatenate([s[k].ravel() for s in sides]) for k in (0, 1))
    linked = (a >= 0) & (b >= 0)
    linked[linked] = (kind[a[linked]] == kind[b[linked]]) & (kind[a[linked]] >= 0)  # a missing zone touches none
    a, b = a[linked], b[linked]
    root = np.arange(len(order))
    while True:
        low = np.minimum(root[a], root[b])
        if (root[a] == low).all() and (root[b] == low).all():
            break
        for ends in (a, b):
            np.minimum.at(root, root[ends], low)
        while (root[root] != root).any():
            root = root[root]
    named = np.empty(len(order), np.int64)
    named[order] = cell[order][root]
    return tile.select(["row", "col", "zone", "cell"]).append_column("root", pa.array(named))


def regions(df: DataFrame, zone: str, width: int) -> DataFrame:
    """(row, col, zone, region): cells of one zone that touch by a side are a region, named by its smallest cell
    ``row * width + col``.

    Square tiles name their own pieces first; pieces that touch across tiles are links. In a round each piece points
    at the smallest it is linked with, pointers are followed to their ends by doubling, and the links between these
    ends go on. All of it is over pieces at tiles' borders, and each step is a written table: a checkpoint's
    plan would keep the sizes estimated for its joins, numbers that get twice as long in each round.
    """
    cells = df.select("row", "col", F.col(zone).alias("zone"), (F.col("row").cast("long") * width + F.col("col")).alias("cell"))
    tiles = cells.groupBy(F.floor(F.col("row") / SIDE).alias("__i"), F.floor(F.col("col") / SIDE).alias("__j"))
    types = T.StructType([*cells.schema.fields, T.StructField("root", T.LongType())])
    named = stored(tiles.applyInArrow(tile_labels, types))
    last, first = (lambda c, k=k: F.pmod(c, F.lit(SIDE)) == k for k in (SIDE - 1, 0))
    held = named.filter(first("row") | first("col")).select("row", "col", F.col("zone").alias("z"), F.col("root").alias("b"))
    asked = [named.filter(last(c)).withColumn(c, F.col(c) + 1).select("row", "col", "zone", F.col("root").alias("a")) for c in ("row", "col")]
    links = stored(asked[0].unionByName(asked[1]).join(held, ["row", "col"]).filter("zone = z").select("a", "b").distinct())
    roots = stored(links.select(F.col("a").alias("piece")).union(links.select("b")).distinct().withColumn("root", F.col("piece")))
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        ends = stored(both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("end"), F.lit(True).alias("moved")))
        while not ends.filter("moved").isEmpty():
            far = ends.select(F.col("a").alias("end"), F.col("end").alias("end2"))
            after = stored(ends.join(far, "end").select("a", F.col("end2").alias("end"), (F.col("end2") != F.col("end")).alias("moved")))
            dropped(ends)
            ends = after
        to = lambda c: ends.select(F.col("a").alias(c), F.col("end").alias(f"{c}2"))  # noqa: E731, B023
        linked = stored(links.join(to("a"), "a").join(to("b"), "b").filter("a2 <> b2").select(F.col("a2").alias("a"), F.col("b2").alias("b")).distinct())
        moved = stored(roots.join(to("root"), "root", "left").select("piece", F.coalesce("root2", "root").alias("root")))
        dropped(links, roots, ends)
        links, roots = linked, moved
    return named.join(roots.select(F.col("piece").alias("root"), F.col("root").alias("least")), "root", "left").select("row", "col", "zone", F.coalesce("least", "root").alias("region"))


def uncertainty_stats(df: DataFrame, maps: list[str]) -> DataFrame:
    """Per map its mean, deviation, range and quartiles, and the share of values above the third quartile in percent."""
    q = exact_quantiles(df, {f"{m}:{p}": (m, p) for m in maps for p in (0.25, 0.5, 0.75)})
    one = df.agg(*[x for m in maps for x in (
        F.avg(m).alias(f"{m}:mean"), F.stddev_pop(m).alias(f"{m}:std"), F.min(m).alias(f"{m}:min"), F.max(m).alias(f"{m}:max"),
        (F.count_if(F.col(m) > F.lit(q[f"{m}:0.75"])) * 100 / F.count(m)).alias(f"{m}:high_pct"),
    )])
    row = lambda m: F.struct(
        F.lit(m).alias("map"), *[F.col(f"`{m}:{n}`").alias(n) for n in ("mean", "std", "min", "max", "high_pct")],
        *[F.lit(q[f"{m}:{p}"]).cast("double").alias(n) for p, n in ((0.25, "q25"), (0.5, "median"), (0.75, "q75"))],
    )
    return one.select(F.explode(F.array(*map(row, maps))).alias("x")).select("x.*")


def confidence_interval(mean: Column, std: Column, z: float = 1.959964) -> tuple[Column, Column]:
    return mean - z * std, mean + z * std


def write_mask(df: DataFrame, mask: str, path: str) -> None:
    """1 where masked, and nodata, which is 0, elsewhere."""
    df.select("row", "col", F.coalesce(F.col(mask).cast("int"), F.lit(0)).cast("byte").alias(mask)).write.mode("overwrite").parquet(path)


def write_clusters(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_dem(df: DataFrame, layers: list[str], path: str) -> None:
    """A folder for each layer, and one JSON row of their statistics."""
    named = ", ".join(f"'{c}', `{c}`" for c in layers)
    long = df.select("row", "col", F.expr(f"stack({len(layers)}, {named}) AS (layer, value)"))
    long.write.mode("overwrite").partitionBy("layer").parquet(f"{path}/layers")
    stats = long.groupBy("layer").agg(F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("n"))
    stats.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
