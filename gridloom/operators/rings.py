"""Outlines of regions as polygons.

Each side of a cell that its region ends at is a directed edge with the region on its right
(rows go down); at a corner an edge is followed by the one that goes on from there, of the same cell where
two do, so that regions that touch themselves at a corner keep simple rings. Rings are put in
order by pointer doubling, whose rounds follow the logarithm of the longest ring; each is one
join and a written table. Outer rings have a positive area, holes a negative one, so a region's
rings sum to its cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.plans.lineage import dropped, stored

#: By side (top, right, bottom, left): the step to the neighbour, where the edge begins and where it ends.
SIDES = [((-1, 0), (0, 0), (0, 1)), ((0, 1), (0, 1), (1, 1)), ((1, 0), (1, 1), (1, 0)), ((0, -1), (1, 0), (0, 0))]


def boundary(regions: DataFrame) -> DataFrame:
    """(edge, region, cell, r0, c0, r1, c1): the sides at which regions (row, col, region) end."""
    cell = F.struct("row", "col")
    sides = F.explode(F.array(*[
        F.struct(F.lit(k).alias("side"), (F.col("row") + F.lit(n[0])).alias("nr"), (F.col("col") + F.lit(n[1])).alias("nc"),
                 (F.col("row") + a[0]).alias("r0"), (F.col("col") + a[1]).alias("c0"), (F.col("row") + b[0]).alias("r1"), (F.col("col") + b[1]).alias("c1"))
        for k, (n, a, b) in enumerate(SIDES)
    ]))
    asked = regions.select("region", cell.alias("cell"), sides.alias("s")).select("region", "cell", "s.*")
    held = regions.select(F.col("row").alias("nr"), F.col("col").alias("nc"), F.col("region").alias("other"))
    ends = asked.join(held, ["nr", "nc"], "left").filter(~F.col("other").eqNullSafe(F.col("region")))
    return ends.select(F.struct(F.col("cell.row"), F.col("cell.col"), "side").alias("edge"), "region", "cell", "r0", "c0", "r1", "c1")


def ordered(edges: DataFrame) -> DataFrame:
    """Edges with ``ring``, the smallest edge of their ring, and ``left``, how many edges follow until the ring closes there."""
    ahead = edges.select("region", F.col("r0").alias("r1"), F.col("c0").alias("c1"), F.col("edge").alias("next"), F.col("cell").alias("owner"))
    own = F.when(F.col("owner") == F.col("cell"), 0).otherwise(1)
    follows = edges.join(ahead, ["region", "r1", "c1"]).groupBy("edge").agg(F.min_by("next", F.struct(own, "next")).alias("next"))
    # The smallest edge within 1, 2, 4, ... steps; when a round changes none, each ring knows its smallest.
    now = stored(follows.select("edge", "next", F.least("edge", "next").alias("ring")))
    begun = now
    while True:
        far = now.select(F.col("edge").alias("next"), F.col("next").alias("next2"), F.col("ring").alias("ring2"))
        after = stored(now.join(far, "next").select("edge", F.col("next2").alias("next"), F.least("ring", "ring2").alias("ring"), (F.col("ring2") < F.col("ring")).alias("moved")))
        if now is not begun:
            dropped(now)
        now = after
        if now.filter("moved").isEmpty():
            break
    rings = now.select("edge", "ring")
    # Steps to the last edge before the smallest one: the distance doubles as pointers do.
    chain = begun.select("edge", "next").join(rings, "edge").select("edge", "ring", F.when(F.col("next") != F.col("ring"), F.col("next")).alias("next"))
    steps = stored(chain.withColumn("left", F.col("next").isNotNull().cast("long")))
    dropped(begun, now)
    while not steps.filter(F.col("next").isNotNull()).isEmpty():
        far = steps.select(F.col("edge").alias("next"), F.col("next").alias("next2"), F.col("left").alias("left2"))
        after = stored(steps.join(far, "next", "left").select("edge", "ring", F.col("next2").alias("next"), (F.col("left") + F.coalesce("left2", F.lit(0))).alias("left")))
        dropped(steps)
        steps = after
    return edges.join(steps.drop("next"), "edge")


def rings(regions: DataFrame) -> DataFrame:
    """(region, ring, area, edges, corners): signed area in cells, edges, and the corners (row, col) where it turns, in order
    from its smallest edge and closed."""
    placed = ordered(stored(boundary(regions)))
    line = Window.partitionBy("ring").orderBy(F.col("left").desc())
    heading = F.struct(F.col("r1") - F.col("r0"), F.col("c1") - F.col("c0"))
    closing = F.max(F.when(F.col("left") == 0, heading)).over(Window.partitionBy("ring"))  # what goes before the first edge
    turned = placed.withColumn("turn", F.coalesce(F.lag(heading).over(line), closing) != heading)
    cross = (F.col("c0") * F.col("r1") - F.col("c1") * F.col("r0")) / 2
    corner = F.when(F.col("turn"), F.struct((-F.col("left")).alias("at"), F.col("r0").alias("row"), F.col("c0").alias("col")))
    found = turned.groupBy("region", "ring").agg(F.sum(cross).alias("area"), F.count("*").alias("edges"), F.array_sort(F.collect_list(corner)).alias("c"))
    corners = F.transform("c", lambda x: F.struct(x["row"].alias("row"), x["col"].alias("col")))
    return found.select("region", "ring", "area", "edges", F.concat(corners, F.slice(corners, 1, 1)).alias("corners"))


def polygons(regions: DataFrame, keep: list[str], left: float = 0.0, top: float = 0.0, step: float = 1.0) -> DataFrame:
    """A row for each region, with columns of its cells that are the same in all: ``area`` and ``perimeter`` in cells,
    ``holes``, and ``geometry``, a GeoJSON polygon whose first ring is the outer one."""
    regions = stored(regions.select("row", "col", "region", *keep))
    found = stored(rings(regions.select("row", "col", "region")))
    place = lambda p: F.concat(F.lit("["), F.format_string("%s,%s", left + p["col"] * step, top - p["row"] * step), F.lit("]"))
    text = F.concat(F.lit("["), F.array_join(F.transform("corners", place), ","), F.lit("]"))
    ordered_rings = F.array_sort(F.collect_list(F.struct((F.col("area") < 0).alias("hole"), "ring", text.alias("text"))))
    shapes = found.groupBy("region").agg(
        F.sum("area").cast("long").alias("area"), F.sum("edges").alias("perimeter"), F.count_if(F.col("area") < 0).alias("holes"), ordered_rings.alias("r")
    )
    body = F.array_join(F.transform("r", lambda x: x["text"]), ",")
    shapes = shapes.withColumn("geometry", F.concat(F.lit('{"type":"Polygon","coordinates":['), body, F.lit("]}"))).drop("r")
    return shapes.join(regions.select("region", *keep).distinct(), "region") if keep else shapes
